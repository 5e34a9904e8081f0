"""Restart, late rows and stateful sessions, on time-ordered files."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.intervals import number_sessions
from millrace.sources import files
from millrace.sources.snapshots import VersionedTable
from millrace.streaming import accounts, jobs, sessions

SHAPE = "id long, u long, at timestamp, kind string"


def batch(spark, path, rows):
    df = spark.createDataFrame(rows, "id long, u long, s long, kind string").select("id", "u", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("at"), "kind")
    df.coalesce(1).write.mode("append").parquet(path)


def test_restart_reads_each_file_once(spark, tmp_path):
    src, out, ckpt = (f"{tmp_path}/{x}" for x in ("in", "out", "ckpt"))
    batch(spark, src, [(1, 1, 0, "a"), (2, 1, 5, "a")])
    files.ingest(spark, src, out, ckpt, "parquet", SHAPE, max_files=1, keep_path=True)
    batch(spark, src, [(3, 1, 9, "b")])
    for _ in range(2):
        files.ingest(spark, src, out, ckpt, "parquet", SHAPE, max_files=1, keep_path=True)
    got = spark.read.parquet(out)
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3] and got.where("_file_path IS NULL").isEmpty()


def test_late_rows_are_counted(spark, tmp_path):
    src, ckpt = f"{tmp_path}/in", f"{tmp_path}/ckpt"
    for i, s in enumerate([0, 100_000, 200_000, 50]):  # the last file is far behind the watermark
        batch(spark, src, [(i, 1, s, "a")])
        stream = jobs.window_counts(jobs.with_event_time(jobs.file_stream(spark, src, SHAPE), "at", "1 hour"), "at", "10 minutes", ["kind"])
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        query.awaitTermination()
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.sum("n")).first()[0] == 2  # windows behind the watermark


def test_upsert_survives_a_repeated_batch(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", ["id"], 2)
    table.publish(spark.createDataFrame([], SHAPE), "create")
    src = f"{tmp_path}/in"
    batch(spark, src, [(1, 1, 0, "a"), (2, 1, 0, "a")])
    merge = lambda old, new: cdc.upsert(old, new, ["id"])
    jobs.upsert_stream(jobs.file_stream(spark, src, SHAPE), table, "s", merge, checkpoint=f"{tmp_path}/c1")
    assert table.latest() == 1
    # a fresh checkpoint replays batch 0: the table has it already
    jobs.upsert_stream(jobs.file_stream(spark, src, SHAPE), table, "s", merge, checkpoint=f"{tmp_path}/c2")
    assert table.latest() == 1 and table.read().count() == 2


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(key)


def test_stateful_sessions_over_batches(spark, tmp_path, rocks):
    src, gap = f"{tmp_path}/in", 100
    rows = [[(1, 1, 0, "c"), (2, 1, 100, "v"), (3, 2, 10, "c")], [(4, 1, 150, "c"), (5, 1, 400, "v")], [(6, 1, 301, "v"), (7, 2, 50_000, "c"), (8, 3, 60_000, "c")]]
    log = None
    for part in rows:
        batch(spark, src, part)
    stream = jobs.file_stream(spark, src, SHAPE, max_files=1)
    updates = sessions.stateful_sessions(stream, "u", "at", "kind = 'c'", gap)
    log = jobs.drain_updates(updates, "s")
    got = sessions.current_sessions(spark.read.parquet(log.path).drop("batch"))
    all_rows = spark.read.parquet(src)
    want = number_sessions(all_rows, ["u"], "at", ["id"], gap).groupBy("u", "session_no").agg(
        F.unix_micros(F.min("at")), F.unix_micros(F.max("at")), F.count("*"), F.count_if(F.col("kind") == "c")).drop("session_no")
    assert sorted(map(tuple, got.drop("status").collect())) == sorted(map(tuple, want.collect()))
    assert got.where("status = 'closed'").count() >= 1


def test_batches_on_both_sides_of_the_watermark_merge(spark):
    assert sessions.merge_spans([(0, 5, 1, 0), (20, 25, 2, 1), (8, 16, 1, 1)], 4) == [(0, 25, 4, 2)]
    assert sessions.merge_spans([(0, 5, 1, 0), (10, 11, 1, 0)], 4) == [(0, 5, 1, 0), (10, 11, 1, 0)]


def test_accounts_tell_rows_and_failures(spark, tmp_path):
    src = f"{tmp_path}/in"
    batch(spark, src, [(1, 1, 0, "a"), (2, 1, 5, "b")])

    def start(write, ckpt):
        return jobs.file_stream(spark, src, SHAPE).writeStream.queryName(f"q{ckpt}").option("checkpointLocation", f"{tmp_path}/{ckpt}").foreachBatch(write).trigger(availableNow=True).start()

    def broken(df, number):
        raise OSError("no room")

    with accounts.followed(spark) as followed:
        good = start(lambda df, number: df.write.format("noop").mode("append").save(), "c1")
        good.awaitTermination()
        followed.wait(good)
        bad = start(broken, "c2")
        with pytest.raises(Exception, match="no room"):
            bad.awaitTermination()
        followed.wait(bad)
    rows = followed.table().where("rows_in > 0").collect()
    assert [(r.query, r.batch, r.rows_in, r.late) for r in rows if r.run == str(good.runId)] == [("qc1", 0, 2, 0)] and rows[0].trigger_ms > 0
    assert set(followed.errors) == {str(bad.runId)} and "no room" in followed.errors[str(bad.runId)]
    late = start(lambda df, number: None, "c3")  # no longer followed
    late.awaitTermination()
    assert all(r.run != str(late.runId) for r in followed.table().collect())
    with pytest.raises(TimeoutError):
        followed.wait(late, 0.1)
