"""What grows with the table: limits that small rows reach when they are set low, and plans that decide what a task or the driver holds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.operators import aggregates, ann, ordered, similar
from millrace.operators.ordered import OrderedGroups
from millrace.sources import snapshots


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_recursion_is_not_ended_by_a_row_limit(spark, tmp_path):
    spark.createDataFrame([(i,) for i in [*range(1, 200), 5, None, 0]], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "100")
    try:
        got = {r["part"]: r["depth"] for r in entry.queries()["recursive_cte"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert got == {i: i.bit_length() for i in range(200)} | {None: 0}


def test_distinct_users_beside_their_estimate(spark, tmp_path):
    rows = [("a", i % 300) for i in range(900)] + [(None, 1), (None, None), ("none", None), ("one", 7)]
    spark.createDataFrame(rows, "event_type string, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    made = entry.queries()["agg_approx_distinct"](spark, str(tmp_path))
    assert {tuple(r) for r in made.collect()} == {("a", 300, True), (None, 1, True), ("none", 0, True), ("one", 1, True)}
    # no aggregate by pairs of type and user may hold a sketch
    sketched = [line for line in plan_of(made).splitlines() if "approx_count_distinct" in line and "keys=" in line]
    assert sketched and not any("user_id" in line.split("keys=")[1].split("]")[0] for line in sketched)


def test_searches_broadcast_no_vectors(spark):
    rng = np.random.default_rng(3)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 8)))], "id long, v array<double>")
    index = ann.VectorIndex.build(table, "id", "v", 8, parts=4)
    made = index.search(table.where("id % 20 = 0").withColumnRenamed("id", "q"), "q", "v", 5, 3)
    joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert sum("strategy=merge" in line for line in joins) == 2 and made.count() == 50


def test_compacted_files_keep_their_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_FILE_ROWS", 50)
    table = snapshots.VersionedTable(spark, f"{tmp_path}/t")
    table.publish(spark.range(1000), "create")
    table.compact(["id"], 8)
    files = table.read().groupBy(F.input_file_name()).count().collect()
    assert len(files) == 20 and max(r["count"] for r in files) <= 100 and table.read().count() == 1000
    table.compact(["id"], 40)
    assert table.read().select(F.input_file_name()).distinct().count() == 40


@pytest.fixture
def chunks_of_100(monkeypatch, spark, split_all):
    monkeypatch.setattr(ordered, "TARGET_CHUNK_ROWS", 100)


def parts_of(df, spark):
    """Rows of the partitions in which ``df`` ends."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("folder", [False, True])
def test_chunks_and_their_tasks_follow_the_rows(spark, tmp_path, chunks_of_100, folder):
    """Two keys hold all rows; files say little of how many rows they hold."""
    rows = spark.range(6000).select((F.col("id") % 2).alias("k"), "id")
    if folder:
        rows.write.parquet(f"{tmp_path}/rows")
        rows = spark.read.parquet(f"{tmp_path}/rows")
    for keys, low, high in ((["k"], 60, 1 / 2), ([], 60, 1)):
        g = OrderedGroups(rows, keys, ["id"])
        assert g.split and g.df.select(ordered.CHUNK).distinct().count() >= low
        sizes = parts_of(g.row_number("n").df, spark)
        assert max(sizes) <= 1000 and sum(sizes) == 6000  # four partitions would hold 1,500 each
        assert g.row_number("n").result().where(F.col("n") != F.floor(F.col("id") * high) + 1).isEmpty()


def test_text_lists_of_a_hot_key_are_dealt_out(spark, chunks_of_100):
    rows = spark.range(6000).select(F.lit("x").alias("k"), "id", F.col("id").cast("string").alias("t"))
    made = aggregates.text_lists(rows, ["k"], ["id"], "t", "lines", " ", 50)
    assert len(parts_of(made, spark)) > 30  # four before
    assert {r.segment: (r.texts, r.lines) for r in made.collect()} == {s: (50, " ".join(str(50 * s + i) for i in range(50))) for s in range(120)}


def test_cosine_links_in_small_packets_and_blocks(spark, monkeypatch):
    """Many packets, blocks and tiles; the answer is that of all pairs."""
    monkeypatch.setattr(similar, "PACKET_WORDS", 60)
    monkeypatch.setattr(similar, "BLOCK_TERMS", 150)
    monkeypatch.setattr(similar, "OFTEN", 3)
    monkeypatch.setattr(similar, "TILE_CELLS", 40)
    rng = random.Random(4)
    rows = [(i % 70, rng.choices([f"w{int(rng.random() ** 2 * 60)}" for _ in range(60)], k=rng.randrange(0, 12))) for i in range(120)]
    rows += [rows[0]] * 3 + [(None, ["w1", None, "w2"]), (5, None), (6, ["alone"])]
    made = similar.cosine_links(spark.createDataFrame(rows, "id long, w array<string>").repartition(3), ["id"], "w", 0.3)
    counts = [{w: (b or []).count(w) for w in b or [] if w is not None} for _, b in rows]
    held = {w: sum(w in c for c in counts) for c in counts for w in c}
    vectors = [{w: n * (np.log(len(rows) / held[w]) + 1) for w, n in c.items()} for c in counts]
    vectors = [{w: x / np.sqrt(sum(y * y for y in v.values())) for w, x in v.items()} for v in vectors]
    links = [sum(i != j and sum(x * b.get(w, 0.0) for w, x in a.items()) >= 0.3 - 1e-9 for j, b in enumerate(vectors)) for i, a in enumerate(vectors)]
    got = sorted((str(r.id), r.links, r.copies) for r in made.collect())
    assert got == sorted((str(k), n, counts.count(c) if c else counts.count({})) for (k, _), n, c in zip(rows, links, counts))
    assert sum(links) > 500
