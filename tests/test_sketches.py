"""Merged profiles against plain sorting and counting."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import sketches

START = datetime.datetime(2024, 1, 29)
SHAPE = "at timestamp, kind string, x double, u string"
GRAINS, MARKS = ("day", "week", "month"), (0.1, 0.5, 0.9)


def window(at, grain):
    start = at.replace(hour=0, minute=0, second=0)
    return {"day": start, "week": start - datetime.timedelta(days=at.weekday()), "month": start.replace(day=1)}[grain]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(6000):
        hot = i % 3 == 0  # one day holds a third of all rows
        at = START + datetime.timedelta(days=0 if hot else rng.randrange(10), seconds=rng.randrange(86400))
        out.append((at, rng.choice(["a", "b", None]), None if i % 17 == 0 else round(rng.gauss(0, 5), 1), f"u{rng.randrange(800)}"))
    return out


def test_merged_windows_hold_their_bounds(spark, rows):
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    half = df.where("u < 'u5'"), df.where("u >= 'u5'")
    parts = [sketches.fine_profile(h, "at", ["x"], ["u"], {"kind": "kind"}) for h in half]
    made = sketches.merged_profile(parts[0].unionByName(parts[1]), ["x"], ["u"], ["kind"], GRAINS, MARKS).collect()
    wanted = {}
    for at, kind, x, u in rows:
        for g in GRAINS:
            for s in ((None, None), ("kind", kind)):
                wanted.setdefault((g, window(at, g), *s), []).append((x, u))
    assert {(r.grain, r.win, r.slice_key, r.slice_value) for r in made} == set(wanted)
    assert len(made) == 2 * len(wanted)
    for r in made:
        group = wanted[r.grain, r.win, r.slice_key, r.slice_value]
        xs, users = sorted(x for x, _ in group if x is not None), {u for _, u in group}
        assert r.rows == len(group)
        if r.column_name == "u":
            assert r.quantiles is None and r.min is None and r.nulls == 0
            assert abs(r.distinct_about - len(users)) <= 0.05 * len(users) + 1
            continue
        assert (r.nulls, r.min, r.max) == (len(group) - len(xs), xs[0], xs[-1]) and abs(r.mean - sum(xs) / len(xs)) < 1e-9
        for m, q in zip(MARKS, r.quantiles):
            assert sum(x < q for x in xs) <= (m + 0.01) * len(xs) + 1 and sum(x <= q for x in xs) >= (m - 0.01) * len(xs) - 1


def test_rank_check_refuses_a_wrong_guess(spark):
    rows = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("x"))
    for guess, fits in ((500.0, True), (505.0, True), (530.0, False), (460.0, False)):
        guesses = spark.createDataFrame([("k", [guess])], "k string, quantiles array<double>")
        assert sketches.ranks_near(rows, ["k"], "x", guesses, [0.5], 0.01).first().near is fits


def test_empty_null_and_stray_grains(spark):
    none = spark.createDataFrame([], SHAPE)
    assert sketches.merged_profile(sketches.fine_profile(none, "at", ["x"]), ["x"]).count() == 0
    blank = spark.createDataFrame([(None, None, None, None), (START, None, None, None)], SHAPE)
    made = sketches.merged_profile(sketches.fine_profile(blank, "at", ["x"], ["u"]), ["x"], ["u"], grains=["day"]).collect()
    assert {(r.win, r.column_name, r.rows, r.nulls, r.mean, r.distinct_about) for r in made} == {(w, c, 1, 1, None, 0) for w in (None, START) for c in ("x", "u")}
    assert all(r.quantiles is None for r in made)
    with pytest.raises(ValueError, match="month"):
        sketches.merged_profile(sketches.fine_profile(none, "at", ["x"], finest="week"), ["x"], grains=["month"], finest="week")
