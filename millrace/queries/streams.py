"""Streaming jobs over the tables' files; each drains its input and returns the whole result."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.ordered import OrderedGroups
from millrace.queries.changes import FEED, feed
from millrace.queries.registry import Tables, ntz, query, rnd
from millrace.session import conf_int, work_dir
from millrace.sources.snapshots import VersionedTable
from millrace.streaming import accounts, jobs, queue, sessions


def events(t: Tables, delay: str = "1 hour"):
    return jobs.with_event_time(jobs.file_stream(t.spark, t.path("events"), t.events.schema), "ts", delay)


@query("st_parse_events", sql="SELECT event_id, user_id, event_type AS action, date_trunc('second', ts)::TIMESTAMP AS event_date FROM events WHERE event_type <> 'error'")
def st_parse_events(t: Tables):
    path = work_dir(t.spark, "messages")
    e = t.events
    # errors carry no user: those messages must be dropped by the parser
    body = F.to_json(F.struct("event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), F.col("event_type").alias("action"), F.unix_timestamp("ts").alias("event_date")))
    e.select(F.col("event_id").cast("string").cast("binary").alias("key"), body.cast("binary").alias("value")).write.parquet(path)
    raw = jobs.file_stream(t.spark, path, "key binary, value binary")
    from millrace.sources.files import key_value

    parsed = jobs.parse_events(key_value(raw), "event_id long, user_id long, action string, event_date long", ["event_id", "user_id"], epoch="event_date")
    return jobs.drain(parsed, "parse").withColumn("event_date", ntz("event_date"))


@query("st_dedup", sql="SELECT event_id, user_id, event_type FROM events")
def st_dedup(t: Tables):
    # the same events arrive twice
    twice = jobs.with_event_time(jobs.file_stream(t.spark, t.path("events"), t.events.schema).unionByName(
        jobs.file_stream(t.spark, t.path("events"), t.events.schema)), "ts", "1 hour")
    return jobs.drain(twice.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id", "event_type"), "dedup")


@query("st_tumbling", sql="SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def st_tumbling(t: Tables):
    counts = jobs.window_counts(events(t), "ts", "10 minutes", ["event_type"], aggs=[F.sum("value").alias("total")])
    rows = jobs.drain_updates(counts, "tumbling").latest(["window_start", "event_type"])
    return rows.select(ntz("window_start").alias("window_start"), "event_type", "n", rnd("total", 2).alias("total"))


@query("st_sliding", sql="""
SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(back::INTEGER) AS window_start, event_type, count(*) AS n FROM events, (SELECT unnest([0, 1, 2]) AS back) GROUP BY 1, 2""")
def st_sliding(t: Tables):
    counts = jobs.window_counts(events(t), "ts", "3 hours", ["event_type"], slide="1 hour")
    rows = jobs.drain_updates(counts, "sliding").latest(["window_start", "event_type"])
    return rows.select(ntz("window_start").alias("window_start"), "event_type", "n")


SESSIONS = """f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM f)"""


@query("st_session", sql=f"WITH {SESSIONS} SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k")
def st_session(t: Tables):
    # sessions of one task are merged before the shuffle, so a hot user sends few rows
    t.spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    counts = jobs.session_counts(events(t), "ts", "12 hours", ["user_id"])
    rows = jobs.drain_updates(counts, "session", mode="complete").last_batch()
    return rows.select("user_id", ntz("session_start").alias("session_start"), ntz("session_end").alias("session_end"), "n")


@query("st_stateful_session", sql=f"WITH {SESSIONS} SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'click') AS clicks FROM s GROUP BY user_id, k")
def st_stateful_session(t: Tables):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(key, None)
    t.spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    raw = jobs.file_stream(t.spark, t.path("events"), t.events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    updates = sessions.stateful_sessions(raw, "user_id", "ts", "event_type = 'click'", 12 * 3600)
    log = jobs.drain_updates(updates, "stateful")
    t.spark.conf.set(key, before) if before else t.spark.conf.unset(key)
    rows = sessions.current_sessions(t.spark.read.parquet(log.path).drop("batch"))
    at = lambda c: ntz(F.timestamp_micros(c)).alias(c)
    return rows.select("user_id", at("session_start"), at("session_end"), "n_events", "clicks")


@query("st_upsert", sql=f"""
WITH {FEED}, l AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC, seq2 DESC) = 1) SELECT id, priority, amount FROM l WHERE op <> 'DELETE'""")
def st_upsert(t: Tables):
    options = dict(keys=["id"], sequence=["seq", "seq2"], delete_when="op = 'DELETE'", drop=["op"])
    path = work_dir(t.spark, "feed")
    feed(t).repartitionByRange(4, "seq").write.parquet(path)
    table = VersionedTable(t.spark, work_dir(t.spark, "upsert"), ["id"], 8)
    table.publish(cdc.scd1_state(feed(t).where("false"), **options), "create")
    stream = jobs.file_stream(t.spark, path, feed(t).schema, max_files=2)
    jobs.upsert_stream(stream, table, "upsert", lambda old, new: cdc.scd1_state(new, state=old, **options))
    return cdc.scd1_rows(table.read(), ["seq", "seq2"])


@query("st_live_agg", sql="SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def st_live_agg(t: Tables):
    stream = jobs.file_stream(t.spark, t.path("events"), t.events.schema)
    live = stream.groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))
    return jobs.drain_updates(live, "live").latest(["event_type"]).withColumn("mean_value", rnd("mean_value", 6))


@query("st_union", sql="SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click')")
def st_union(t: Tables):
    path = work_dir(t.spark, "views-json")
    t.events.where("event_type = 'view'").select("event_id", "event_type").write.json(path)
    a = jobs.file_stream(t.spark, path, "event_id long, event_type string", "json")
    b = jobs.file_stream(t.spark, t.path("events"), t.events.schema).where("event_type = 'click'").select("event_id", "event_type")
    return jobs.drain(a.unionByName(b), "union")


@query("st_change_feed", sql="SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'")
def st_change_feed(t: Tables):
    rows = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    source = VersionedTable(t.spark, work_dir(t.spark, "cdf-source"), ["c_custkey"], 8)
    path = work_dir(t.spark, "cdf")
    steps = [None, rows.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0)), rows.where("c_mktsegment = 'MACHINERY'")]
    source.publish(rows, "create")
    jobs.publish_changes(source, path, ["c_custkey"], None, 0)
    source.rewrite(steps[1], lambda old, new: cdc.upsert(old, new, ["c_custkey"]), "update")
    jobs.publish_changes(source, path, ["c_custkey"], 0, 1)
    source.rewrite(steps[2], lambda old, new: cdc.upsert(old, new, ["c_custkey"], delete_when="true"), "delete")
    jobs.publish_changes(source, path, ["c_custkey"], 1, 2)
    copy = VersionedTable(t.spark, work_dir(t.spark, "cdf-copy"), ["c_custkey"], 8)
    copy.publish(rows.where("false"), "create")
    stream = jobs.file_stream(t.spark, path, t.spark.read.parquet(path).schema)
    jobs.upsert_stream(stream, copy, "cdf", lambda old, new: cdc.apply_feed(old, new, ["c_custkey"]))
    return copy.read()


@query("stream_static_join", sql="SELECT event_id, c_mktsegment, n_name FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE event_type = 'purchase'")
def stream_static_join(t: Tables):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    stream = jobs.file_stream(t.spark, t.path("events"), t.events.schema).where("event_type = 'purchase'")
    return jobs.drain(stream.join(people, F.col("user_id") == F.col("c_custkey")).select("event_id", "c_mktsegment", "n_name"), "static")


@query("stream_stream_join", sql="""
SELECT a.event_id AS click_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR
WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def stream_stream_join(t: Tables):
    # rows of one user meet within 6 hours; the hour is part of the key, so a hot user spreads
    hour = lambda c: F.floor(F.unix_seconds(c) / (6 * 3600))
    clicks = events(t).where("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("u"), F.col("ts").alias("c_ts"))
    clicks = clicks.withColumn("slot", F.explode(F.array(hour("c_ts"), hour("c_ts") + 1)))
    buys = events(t).where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("p_ts")).withColumn("p_slot", hour("p_ts"))
    near = F.expr("u = user_id AND slot = p_slot AND p_ts >= c_ts AND p_ts <= c_ts + INTERVAL 6 HOURS")
    return jobs.drain(clicks.join(buys, near).select("click_id", "purchase_id"), "pair")


@query("st_late_rows", sql="""
WITH w AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS mark FROM events WHERE event_type <> 'error')
SELECT 1 AS run, count(*) AS rows_in, 0::BIGINT AS late, count(*) AS kept FROM events WHERE event_type <> 'error'
UNION ALL SELECT 2, count(*), count(*) FILTER (WHERE ts <= mark), count(*) FILTER (WHERE ts > mark) FROM events, w WHERE event_type = 'error'""")
def st_late_rows(t: Tables):
    """Errors are delivered after everything else; those behind the watermark are dropped, and counted by the query's own reports."""
    path, out, ckpt = (work_dir(t.spark, x) for x in ("late-in", "late-out", "late-ckpt"))
    made = []
    with accounts.followed(t.spark) as followed:
        for run, part in enumerate(("event_type <> 'error'", "event_type = 'error'"), 1):
            t.events.where(part).write.mode("append").parquet(path)
            stream = jobs.with_event_time(jobs.file_stream(t.spark, path, t.events.schema), "ts", "1 hour")
            once = stream.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type")
            ended = once.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
            ended.awaitTermination()
            followed.wait(ended)
            made.append((run, str(ended.runId), "error" if run == 2 else "other"))
    runs = t.spark.createDataFrame(made, "run_number int, run string, kind string")
    reported = followed.table().join(runs, "run").groupBy("run_number", "kind").agg(F.sum("rows_in").alias("rows_in"), F.sum("late").alias("late"))
    kept = t.spark.read.schema("event_id long, event_type string").parquet(out).groupBy(F.when(F.col("event_type") == "error", "error").otherwise("other").alias("kind")).agg(F.count("*").alias("kept"))
    return reported.join(kept, "kind", "left").select(F.col("run_number").alias("run"), "rows_in", "late", F.coalesce("kept", F.lit(0).cast("long")).alias("kept"))


@query("st_restart", sql="SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, true AS broke FROM events GROUP BY 1")
def st_restart(t: Tables):
    """A writer that fails after its second batch is written and before it is committed; the restart writes that batch again, in its place."""
    path, ckpt = work_dir(t.spark, "restart-in"), work_dir(t.spark, "restart-ckpt")
    parts = max(4, conf_int(t.spark, "spark.sql.shuffle.partitions", 200))
    t.events.select("event_id", "event_type", "value").repartition(parts, "event_id").write.parquet(path)
    schema = "event_id long, event_type string, value double"
    log = jobs.UpdateLog(t.spark, work_dir(t.spark, "restart-log"), t.spark.read.parquet(path).schema)

    def failing(df, batch):
        log.write(df, batch)
        if batch == 1:
            raise OSError("the writer is lost")

    def run(write):
        stream = jobs.file_stream(t.spark, path, schema, max_files=parts // 4)  # four batches or so, however large the table
        stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()

    broke = False
    try:
        run(failing)
    except StreamingQueryException:
        broke = True
    run(log.write)
    rows = t.spark.read.parquet(log.path)
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), rnd(F.sum("value"), 2).alias("total")).withColumn("broke", F.lit(broke))


@query("st_queue", sql="""
WITH e AS (SELECT event_id, event_type, ts, lead(ts) OVER w AS next_at, lead(event_type) OVER w AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id AS request, CASE WHEN event_type = 'purchase' THEN 'done'
 WHEN ('0x' || substr(md5(event_id::VARCHAR || 'queue'), 1, 15))::BIGINT % 100 < 10 OR (next_type = 'error' AND next_at <= ts + INTERVAL 2 DAYS) THEN 'to_process' ELSE 'skipped' END AS status FROM e""")
def st_queue(t: Tables):
    """Every event is a request (purchases are done already); an error is feedback on what its user did just before. Feedback arrives after all requests."""
    asked = t.events.select(F.col("event_id").alias("request"), F.col("ts").cast("timestamp").alias("requested_at"),
                            F.when(F.col("event_type") == "purchase", "done").alias("status"), F.lit(None).cast("timestamp").alias("feedback_at"))
    steps = OrderedGroups(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).lag({"request": "event_id", "before": "ts"}).result()
    told = steps.where("event_type = 'error' AND request IS NOT NULL").select(
        "request", F.col("before").cast("timestamp").alias("requested_at"), F.lit(None).cast("string").alias("status"), F.col("ts").cast("timestamp").alias("feedback_at"))
    path, ckpt = work_dir(t.spark, "queue-in"), work_dir(t.spark, "queue-ckpt")
    days = t.events.agg(F.date_diff(F.max("ts"), F.min("ts"))).first()[0] or 0
    log = None
    for rows in (asked, told):  # the second run finds the state of the first
        rows.write.mode("append").parquet(path)
        marked = queue.claims(jobs.file_stream(t.spark, path, queue.SHAPE), within="2 days", keep=f"{days + 2} days")
        log = log or jobs.UpdateLog(t.spark, work_dir(t.spark, "queue"), marked.schema)
        queue.mark(marked, log, ckpt)
    return log.latest(["request"]).select("request", "status")
