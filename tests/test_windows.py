"""Window totals by ranks, and trailing distinct counts by intervals, against plain loops."""

import datetime as dt
import random

import pytest

from millrace.operators.windows import window_totals

START = dt.datetime(2024, 1, 1)


def plain(windows, points):
    made = []
    for w, s, e in windows:
        inside = [p for p in points if s is not None and e is not None and p[0] is not None and s <= p[0] <= e]
        if inside:
            labels = [p[3] for p in inside if p[3] is not None]
            made.append((w, len(inside), round(sum(p[1] or 0 for p in inside), 6), len({p[2] for p in inside} - {None}), min(labels, default=None)))
    return sorted(made, key=str)


@pytest.mark.parametrize("hot, split", [(False, False), (True, False), (True, True)])
def test_window_totals(spark, request, hot, split):
    if split:
        request.getfixturevalue("split_all")
    rng = random.Random(7 + hot)
    moment = lambda: START + dt.timedelta(seconds=rng.randint(0, 400))  # noqa: E731  (many ties)
    points = [(moment(), rng.choice([None, 1.5, -2.25, 10.0]), 1 if hot and i % 3 else rng.choice([None, *range(12)]), i) for i in range(500)] + [(None, 1.0, 1, 9), (START, 2.0, 3, None)]
    windows = [(i, s, s + dt.timedelta(seconds=rng.choice([-5, 0, 1, 17, 90, 500]))) for i, s in enumerate(moment() for _ in range(120))]
    windows += [(5, START, START + dt.timedelta(days=1)), (900, None, START), (901, START, None), (902, START - dt.timedelta(days=9), START - dt.timedelta(days=8))]
    made = window_totals(spark.createDataFrame(windows, "w int, s timestamp, e timestamp"), "w", ("s", "e"),
                         spark.createDataFrame(points, "t timestamp, x double, item int, label int"), "t", "x", "item", "label").collect()
    assert sorted(((r.w, r.n, round(float(r.total), 6), r["items"], r.least) for r in made), key=str) == plain(windows, points)


def test_no_windows_or_points(spark):
    windows = spark.createDataFrame([(1, START, START)], "w int, s timestamp, e timestamp")
    points = spark.createDataFrame([(START, 1.0, 1, 1)], "t timestamp, x double, item int, label int")
    total = lambda w, p: window_totals(w, "w", ("s", "e"), p, "t", "x", "item", "label").count()
    assert (total(windows, points), total(windows.where("false"), points), total(windows, points.where("false"))) == (1, 0, 0)


VIEW = """
source: t
dimensions: [{name: Day, expr: d}, {name: Kind, expr: k}]
measures:
  - {name: Items, expr: count(DISTINCT x), window: [{order: Day, range: trailing 3 day, semiadditive: last}]}
"""


@pytest.mark.parametrize("dims", [["Day"], ["Kind", "Day"]])
@pytest.mark.parametrize("split", [False, True])
def test_trailing_distinct(spark, request, dims, split):
    from millrace.plans.metric_view import MetricView

    if split:
        request.getfixturevalue("split_all")
    rng = random.Random(3)
    rows = [(START + dt.timedelta(days=rng.choice([0, 1, 2, 4, 5, 9, 10, 30])), rng.choice(["a", "b", None]), rng.choice([None, None, *range(6)])) for _ in range(60)] + [(None, "a", 1)]
    table = spark.createDataFrame(rows, "d timestamp_ntz, k string, x int")
    view = MetricView.from_yaml(VIEW)
    made = sorted((tuple(r) for r in view.query(lambda _: table, dims, ["Items"]).collect()), key=str)
    part = lambda r: r[1] if len(dims) == 2 else 0
    want = []
    for day, kind in {(r[0], part(r)) for r in rows}:
        inside = [r for r in rows if day and r[0] and part(r) == kind and day - dt.timedelta(days=3) <= r[0] < day]
        want.append((*([kind] if len(dims) == 2 else []), day, len({r[2] for r in inside} - {None}) if inside else None))
    assert made == sorted(want, key=str)
    plan = view.query(lambda _: table, dims, ["Items"])._jdf.queryExecution().toString()
    assert "collect_set" not in plan
