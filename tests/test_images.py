"""Pixel kernels against loops over single pixels, and the job over files and tables."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import pixels
from millrace.operators.images import augment, grey_map, pixel_values
from millrace.sources import files


def plain_resize(image, height, width):
    h, w = image.shape
    out = np.zeros((height, width), int)
    for y in range(height):
        for x in range(width):
            v = min(max(Fraction(2 * y + 1, 2) * h / height - Fraction(1, 2), 0), h - 1)
            u = min(max(Fraction(2 * x + 1, 2) * w / width - Fraction(1, 2), 0), w - 1)
            y0, x0 = int(v), int(u)
            y1, x1, b, a = min(y0 + 1, h - 1), min(x0 + 1, w - 1), v - int(v), u - int(u)
            top = int(image[y0, x0]) * (1 - a) + int(image[y0, x1]) * a
            low = int(image[y1, x0]) * (1 - a) + int(image[y1, x1]) * a
            out[y, x] = int(top * (1 - b) + low * b + Fraction(1, 2))
    return out


@pytest.mark.parametrize("shape, wanted", [((8, 8), (12, 12)), ((5, 9), (3, 4)), ((1, 1), (4, 2)), ((7, 3), (7, 3)), ((6, 1), (2, 5))])
def test_resize_equals_a_loop(shape, wanted):
    stack = np.random.default_rng(3).integers(0, 256, (4, *shape)).astype(np.uint8)
    got = pixels.resize(stack, *wanted)
    assert [g.tolist() for g in got] == [plain_resize(s, *wanted).tolist() for s in stack]


def test_decode_takes_only_whole_images():
    image = np.arange(6, dtype=np.uint8).reshape(2, 3)
    assert pixels.decode(pixels.encode(image)).tolist() == image.tolist()
    assert pixels.decode(b"P5 # a note\n3 2 255 " + bytes(range(6))).tolist() == image.tolist()
    for bad in (None, b"", b"P6\n1 1\n255\nabc", b"P5\n3 2\n255\n12345", b"P5\n0 2\n255\n", b"P5\n1 1\n999\nx", "é".encode()):
        assert pixels.decode(bad) is None


def test_augment_over_files(spark, tmp_path):
    rng = np.random.default_rng(8)
    kept = {}
    for i in range(12):
        image = rng.integers(0, 256, (4 + i % 3, 9 - i % 2)).astype(np.uint8)
        folder = tmp_path / ("odd" if i % 2 else "even")
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.pgm").write_bytes(pixels.encode(image))
        kept[f"{i}.pgm"] = image
    (tmp_path / "odd" / "broken.pgm").write_bytes(b"P5\n9 9\n255\nshort")
    rows = files.image_rows(spark, str(tmp_path), "*.pgm").withColumn("name", F.element_at(F.split("path", "/"), -1))
    out = augment(rows, "content", (5, 6), (4, 4), F.col("label") == "odd")
    got = {r["name"]: (r["label"], r["content"]) for r in out.collect()}
    assert got.pop("broken.pgm") == ("odd", None) and len(got) == 12
    for name, (label, content) in got.items():
        image = kept[name]
        top, left = (image.shape[0] - 4) // 2, (image.shape[1] - 4) // 2
        want = plain_resize(image[top:top + 4, left:left + 4], 5, 6)
        assert pixels.decode(bytes(content)).tolist() == (want[:, ::-1] if label == "odd" else want).tolist()


def test_grey_maps_of_rows(spark):
    df = spark.createDataFrame([(1, [0, 7, 255, 16]), (2, [1, 2, 3]), (3, [1, None, 3, 4]), (4, None)], "id long, v array<int>")
    made = {r["id"]: r["m"] for r in df.withColumn("m", grey_map(F.col("v"), 2, 2)).collect()}
    assert pixels.decode(bytes(made[1])).tolist() == [[0, 7], [255, 16]] and made[2] is made[3] is made[4] is None
    back = df.where("id = 1").select(pixel_values(grey_map(F.col("v"), 2, 2), 2, 2).alias("p")).first()["p"]
    assert back == [0, 7, 255, 16]
    assert augment(df.where("id > 9").withColumn("m", grey_map(F.col("v"), 2, 2)), "m", (2, 2), (2, 2), F.lit(False)).isEmpty()
