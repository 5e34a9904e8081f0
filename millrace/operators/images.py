"""Augmenting tables of images: crop, resize and mirror in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import pixels


def augment(images: DataFrame, content: str, size: tuple[int, int], crop: tuple[int, int], mirrored: Column) -> DataFrame:
    """Replace ``content`` (8-bit grey maps of any shapes) by its centre ``crop``, resized to ``size`` (height, width).

    Rows where ``mirrored`` is true are turned left to right. Content that is null or no such image becomes null;
    every row and all other columns stay. Only the content and the flag travel to Python, a batch at a time.
    """

    @F.pandas_udf("binary")
    def change(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for raw, flags in batches:
            flip = flags.fillna(False).to_numpy(bool)

            def kernel(stack, places):
                return pixels.mirror(pixels.resize(pixels.centre_crop(stack, *crop), *size), flip[places])

            made = pixels.by_shape([pixels.decode(c) for c in raw], kernel)
            yield pd.Series([None if m is None else pixels.encode(m) for m in made], index=raw.index, dtype=object)

    return images.withColumn(content, change(F.col(content), mirrored))


def grey_map(values: Column, height: int, width: int) -> Column:
    """Numbers 0 to 255 in rows of ``width`` as a binary grey map; null unless there are ``height * width`` of them, none null."""
    body = F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    fits = (F.size(values) == height * width) & ~F.exists(values, lambda v: v.isNull())
    return F.when(fits, F.concat(F.encode(F.lit(f"P5\n{width} {height}\n255\n"), "US-ASCII"), body))


def pixel_values(content: Column, height: int, width: int) -> Column:
    """The last ``height * width`` bytes of an image as numbers."""
    body = F.hex(F.substring(content, -height * width, height * width))
    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: F.conv(F.substr(body, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
