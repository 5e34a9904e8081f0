"""Chunked ordered groups equal plain windows, also when one key holds most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import exact_percentiles, ranks
from millrace.operators.features import rolling
from millrace.operators.intervals import number_sessions, pack_intervals
from millrace.operators.joins import asof_join, interval_join, overlap_join
from millrace.operators.ordered import OrderedGroups, global_numbers, heavy_keys


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows; key 1 holds over half, with ties in time, nulls and a null key."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = 1 if rng.random() < 0.55 else rng.choice([None, 2, 3, *range(10, 60)])
        rows.append((i, key, rng.randrange(0, 40_000), None if rng.random() < 0.2 else rng.randrange(100)))
    df = spark.createDataFrame(rows, "id long, k long, t long, v long").withColumn("ts", F.timestamp_seconds("t"))
    return df.repartition(4)


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=lambda r: [(x is not None, x) for x in r])


def test_heavy_keys_and_cuts(spark, hot):
    heavy = heavy_keys(hot, ["k"], 0.2)
    assert [r["k"] for r in heavy.collect()] == [1]
    groups = OrderedGroups(hot, [], ["t", "id"], chunks=16)
    spans = groups.df.groupBy("__chunk").agg(F.count("*").alias("n"), F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b")).orderBy("__chunk").collect()
    assert len(spans) == 16 and max(r["n"] for r in spans) < 3000 / 16 * 1.6 and sum(r["n"] for r in spans) == 3000
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def chunk_sizes(groups, key):
    return sorted(r["count"] for r in groups.df.where(key).groupBy("__chunk").count().collect())


def test_each_heavy_key_has_cuts_of_its_own(spark):
    """One key lives in a short span of time, one ties on its first column, one has long texts of one beginning."""
    rows = [("wide", 1000 * i, "x", i) for i in range(2000)] + [("brief", 700_000 + i // 100, "x", i) for i in range(2000)]
    rows += [("tied", 5, "x", i) for i in range(2000)] + [(None, 9, f"the same beginning {i:05d}", 0) for i in range(2000)] + [("light", 1, None, i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, t long, s string, id long").repartition(3)
    g = OrderedGroups(df, ["k"], ["t", "s", "id"], chunks=40, share=0.1, always=True)
    assert g.split and g.df.count() == len(rows)
    for key in ("k = 'wide'", "k = 'brief'", "k = 'tied'", "k IS NULL"):
        sizes = chunk_sizes(g, key)
        assert len(sizes) in (10, 11) and sizes[-1] < 2000 / 10 * 2
    assert chunk_sizes(g, "k = 'light'") == [20]
    w = Window.partitionBy("k").orderBy("t", "s", "id")
    got = g.row_number("n").lag({"b": "id"}).result()
    want = df.select("*", F.row_number().over(w).alias("n"), F.lag("id").over(w).alias("b"))
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == len(rows)


def test_cut_along_any_type_ties_and_empty(spark, split_all):
    df = spark.sql("SELECT id % 2 AS k, named_struct('a', array(id % 7), 'b', cast(id AS decimal(30, 3))) AS o, id FROM range(400)")
    got = OrderedGroups(df, ["k"], ["o"], chunks=8, share=0.1).row_number("n")
    want = df.select("id", F.row_number().over(Window.partitionBy("k").orderBy("o")).alias("n"))
    assert got.split and rows_of(got.result(), "id", "n") == rows_of(want, "id", "n")
    ties = OrderedGroups(spark.sql("SELECT 1 AS k, 3 AS t, id FROM range(300)"), ["k"], ["t"], chunks=8, share=0.1)
    assert sorted(r["n"] for r in ties.row_number("n").result().collect()) == list(range(1, 301))
    for keys in (["k"], []):
        assert OrderedGroups(df.where("id < 0"), keys, ["id"]).row_number("n").result().isEmpty()


def test_window_functions_with_carry(split_all, hot):
    g = OrderedGroups(hot, ["k"], ["t", "id"], chunks=12, share=0.05)
    assert g.split
    got = (
        g.lag({"lag_v": "v"}).lead({"lead_id": "id"}).running({"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))})
        .last_value({"seen": F.col("v")}).row_number("rn").running_before({"before": ("max", F.col("v"))}).result())
    w = Window.partitionBy("k").orderBy("t", "id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select("*", F.lag("v").over(w).alias("lag_v"), F.lead("id").over(w).alias("lead_id"), F.sum("v").over(run).alias("s"), F.count("v").over(run).alias("n"),
                      F.max("v").over(run).alias("hi"), F.min("v").over(run).alias("lo"), F.last("v", True).over(run).alias("seen"), F.row_number().over(w).alias("rn"),
                      F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    cols = ["id", "lag_v", "lead_id", "s", "n", "hi", "lo", "seen", "rn", "before"]
    assert rows_of(got, *cols) == rows_of(want, *cols)


def test_no_task_gets_the_hot_key(split_all, hot):
    g = OrderedGroups(hot, ["k"], ["t", "id"], chunks=16, share=0.05)
    largest = g.df.groupBy("k", "__chunk").count().agg(F.max("count")).first()[0]
    assert largest < 300  # of 1650 rows of the hot key


@pytest.mark.parametrize("split", [False, True])
def test_rolling_equals_range_frame(spark, hot, split):
    spark.conf.set("spark.millrace.split.smallBytes", "0" if split else str(1 << 40))
    got = rolling(hot, ["k"], "ts", 900, {"s": ("sum", F.col("v")), "n": ("count", F.lit(1)), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))})
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-900, 0)
    want = hot.select("*", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"), F.max("v").over(w).alias("hi"), F.min("v").over(w).alias("lo"))
    assert rows_of(got.where("k IS NOT NULL"), "id", "s", "n", "hi", "lo") == rows_of(want.where("k IS NOT NULL"), "id", "s", "n", "hi", "lo")
    spark.conf.unset("spark.millrace.split.smallBytes")


def test_ranks_and_percentiles(split_all, hot):
    w = Window.partitionBy("k").orderBy(F.desc("v"))
    base = hot.where("v IS NOT NULL AND k IS NOT NULL")
    want = base.select("id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert rows_of(ranks(base, ["k"], "v", "r", "d"), "id", "r", "d") == rows_of(want, "id", "r", "d")
    # null keys and values, and texts that begin alike
    for value in (F.col("v"), F.concat(F.lit("the same beginning "), F.lpad(F.col("v").cast("string"), 3, "0"))):
        every = hot.withColumn("x", value)
        for keys in (["k"], []):
            wx = Window.partitionBy(*keys).orderBy(F.desc("x"))
            want = every.select("id", F.rank().over(wx).alias("r"), F.dense_rank().over(wx).alias("d"))
            assert rows_of(ranks(every, keys, "x", "r", "d"), "id", "r", "d") == rows_of(want, "id", "r", "d")
    got = exact_percentiles(hot.where("k IS NOT NULL"), ["k"], "v", {"a": 0.1, "b": 0.77})
    want = hot.where("k IS NOT NULL").groupBy("k").agg(F.percentile("v", F.lit(0.1)).alias("a"), F.percentile("v", F.lit(0.77)).alias("b")).where("a IS NOT NULL")
    near = lambda df: [(r["k"], round(r["a"], 9), round(r["b"], 9)) for r in df.orderBy("k").collect()]
    assert near(got) == near(want)


def test_sessions_and_packing(split_all, hot):
    base = hot.where("k IS NOT NULL")
    got = number_sessions(base, ["k"], "ts", ["id"], 30).groupBy("k", "session_no").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n"))
    want, rows = [], sorted((r["k"], r["t"], r["id"]) for r in base.collect())
    for k, t, _ in rows:
        if want and want[-1][0] == k and t - want[-1][2] <= 30:
            want[-1][2], want[-1][3] = t, want[-1][3] + 1
        else:
            want.append([k, t, t, 1])
    assert rows_of(got, "k", "a", "b", "n") == sorted(map(tuple, want))
    spans = base.select("k", F.col("t").alias("a"), (F.col("t") + F.coalesce("v", F.lit(1))).alias("b"))
    packed = pack_intervals(spans, ["k"], "a", "b")
    want = []
    for k, a, b in sorted(map(tuple, spans.collect())):
        if want and want[-1][0] == k and a <= want[-1][2]:
            want[-1][2], want[-1][3] = max(want[-1][2], b), want[-1][3] + 1
        else:
            want.append([k, a, b, 1])
    assert rows_of(packed, "k", "a", "b", "merged") == sorted(map(tuple, want))


def test_asof_join(split_all, hot):
    left = hot.where("k IS NOT NULL AND id % 2 = 0").select("id", "k", "ts", "t")
    right = hot.where("k IS NOT NULL AND id % 2 = 1").select("k", F.col("ts").alias("f_ts"), F.col("id").alias("f_id"), F.col("v").alias("fv"))
    got = asof_join(left, right, ["k"], "ts", "f_ts", ["f_id", "fv"], tiebreak=["f_id"])
    facts = {}
    for r in right.collect():
        facts.setdefault(r["k"], []).append((r["f_ts"], r["f_id"], r["fv"]))
    want = []
    for r in left.collect():
        best = max((f for f in facts.get(r["k"], []) if f[0] <= r["ts"]), key=lambda f: f[:2], default=(None, None, None))
        want.append((r["id"], best[1], best[2]))
    assert rows_of(got, "id", "f_id", "fv") == sorted(want, key=lambda r: [(x is not None, x) for x in r])


def test_asof_lookback(spark):
    left = spark.sql("SELECT 1 AS k, timestamp'2024-01-10' AS ts UNION ALL SELECT 1, timestamp'2024-03-10'")
    right = spark.sql("SELECT 1 AS k, timestamp'2024-01-05' AS f, 7 AS v")
    got = asof_join(left, right, ["k"], "ts", "f", ["v"], lookback=F.expr("INTERVAL 10 DAYS"))
    assert [r["v"] for r in got.orderBy("ts").collect()] == [7, None]


def test_interval_and_overlap_joins_against_pairs(spark, hot):
    facts = hot.where("k IS NOT NULL").select("id", "k", "ts")
    spans = hot.where("k IS NOT NULL AND id % 40 = 0").select(
        F.col("id").alias("sid"), "k", F.col("ts").alias("a"), F.when(F.col("id") % 80 != 0, F.timestamp_seconds(F.col("t") + 700)).alias("b"))
    got = rows_of(interval_join(facts, spans, ["k"], "ts", "a", "b", 1000), "id", "sid")
    s = [tuple(r) for r in spans.collect()]
    want = sorted((f["id"], x[0]) for f in facts.collect() for x in s if x[1] == f["k"] and f["ts"] >= x[2] and (x[3] is None or f["ts"] < x[3]))
    assert got == want and want
    left = hot.where("id % 100 = 0").select(F.col("id").alias("l"), F.col("ts").alias("la"), F.timestamp_seconds(F.col("t") + 300).alias("lb"))
    right = hot.where("id % 77 = 0").select(F.col("id").alias("r"), F.col("ts").alias("ra"), F.timestamp_seconds(F.col("t") + 900).alias("rb"))
    got = rows_of(overlap_join(left, right, ("la", "lb"), ("ra", "rb"), 200), "l", "r")
    want = sorted((x["l"], y["r"]) for x in left.collect() for y in right.collect() if x["la"] <= y["rb"] and y["ra"] <= x["lb"])
    assert got == want and want


def test_global_numbers(spark, hot):
    got = global_numbers(hot.select("id"), ["id"], "n", start=5, step=3)
    assert [(r["id"], r["n"]) for r in got.orderBy("id").collect()] == [(i, 5 + 3 * i) for i in range(3000)]
