"""Scans, loads and sinks: tables are written out in other formats and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import cdc
from millrace.queries.registry import Tables, day, query, rnd
from millrace.session import rebalanced, work_dir
from millrace.sources import evolution, files
from millrace.sources.snapshots import VersionedTable, morton_key


@query("scan_formats", sql=" UNION ALL ".join(
    f"SELECT '{k}' AS kind, count(*) AS n, round(sum(c_acctbal), 2) AS balance, max(c_name) AS last_name FROM customer" for k in ("csv", "json", "orc", "parquet")))
def scan_formats(t: Tables):
    out = None
    for kind in ("csv", "json", "orc", "parquet"):
        path = work_dir(t.spark, f"scan-{kind}")
        t.customer.write.format(kind).option("header", "true").save(path)
        one = files.read_files(t.spark, path).select(F.lit(kind).alias("kind"), "c_acctbal", "c_name").groupBy("kind").agg(
            F.count("*").alias("n"), rnd(F.sum("c_acctbal"), 2).alias("balance"), F.max("c_name").alias("last_name"))
        out = one if out is None else out.unionByName(one)
    return out


@query("scan_partitioned", sql="SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) IN (3, 4)")
def scan_partitioned(t: Tables):
    path = work_dir(t.spark, "partitioned")
    dated = t.orders.withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    rebalanced(dated, "y", "m").write.partitionBy("y", "m").parquet(path)
    return files.read_files(t.spark, path, "parquet").where("y = 1998 AND m IN (3, 4)").select("o_orderkey", "y", "m")


@query("scan_glob", sql="SELECT count(*) AS n, count(DISTINCT c_nationkey) AS nations FROM customer WHERE c_nationkey BETWEEN 10 AND 19")
def scan_glob(t: Tables):
    path = work_dir(t.spark, "glob")
    named = t.customer.withColumn("part", F.concat(F.lit("n"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
    rebalanced(named, "part").write.partitionBy("part").parquet(path)
    rows = files.read_files(t.spark, f"{path}/part=n1*", "parquet", glob="*.parquet")
    return rows.agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("nations"))


@query("scan_csv_options", sql="SELECT c_custkey AS id, replace(c_name, '#', chr(10)) AS name, c_acctbal AS balance FROM customer")
def scan_csv_options(t: Tables):
    path = work_dir(t.spark, "csv")
    rows = t.customer.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("\n")).alias("name"), "c_acctbal")
    rows.write.option("sep", "|").option("header", "false").option("quoteAll", "true").csv(path)
    return files.read_files(t.spark, path, "csv", "id long, name string, balance double", sep="|", header="false", multiLine="true")


@query("schema_hints", sql="SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, NULL::INTEGER AS c_rank FROM customer")
def schema_hints(t: Tables):
    path = work_dir(t.spark, "hints")
    t.customer.drop("c_name", "c_mktsegment").write.json(path)
    rows = files.read_files(t.spark, path, hints={"c_nationkey": "string", "c_rank": "int"})
    return rows.select("c_custkey", "c_nationkey", "c_acctbal", "c_rank")


@query("rescued_data", sql="""
SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 2) END AS value,
 CASE WHEN event_type = 'error' THEN '{"value":"n/a"}' WHEN event_type = 'click' THEN '{"extra":"' || user_id || '"}' END AS _rescued_data FROM events WHERE event_type <> 'signup'
UNION ALL SELECT NULL, NULL, '{"_line":"broken ' || event_id || '"}' FROM events WHERE event_type = 'signup'""")
def rescued_data(t: Tables):
    path = work_dir(t.spark, "rescue")
    e = t.events
    line = (
        F.when(F.col("event_type") == "error", F.to_json(F.struct("event_id", F.lit("n/a").alias("value"))))
        .when(F.col("event_type") == "click", F.to_json(F.struct("event_id", "value", F.col("user_id").alias("extra"))))
        .when(F.col("event_type") == "signup", F.concat(F.lit("broken "), F.col("event_id").cast("string")))
        .otherwise(F.to_json(F.struct("event_id", "value"))))
    e.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    lines = t.spark.read.text(path)
    out = files.rescue_json(lines.withColumnRenamed("value", "line"), schema, "line")
    return out.withColumn("value", F.round("value", 2))


@query("schema_evolve", sql="SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer")
def schema_evolve(t: Tables):
    path, kept = work_dir(t.spark, "evolve"), files.EvolvingSchema(t.spark, work_dir(t.spark, "evolve-schema"))
    t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_acctbal").write.json(path)
    kept.resolve(path, "json")
    t.customer.where("c_custkey % 2 = 1").select("c_custkey", "c_acctbal", "c_mktsegment").write.mode("append").json(path)
    try:
        kept.resolve(path, "json")
        raise AssertionError("the new column went unnoticed")
    except files.UnknownColumns:
        schema = kept.resolve(path, "json")  # the restart adopts the widened schema
    return files.read_files(t.spark, path, "json", schema).select("c_custkey", "c_acctbal", "c_mktsegment")


@query("schema_widen", sql="""
SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN c_nationkey::VARCHAR WHEN 1 THEN (10000000000 + c_custkey)::VARCHAR WHEN 2 THEN (floor(c_acctbal) + 0.25)::VARCHAR ELSE c_mktsegment END AS score,
 CASE WHEN c_custkey % 4 < 3 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 4 IN (1, 2) THEN c_name END AS name, CASE WHEN c_custkey % 4 = 3 THEN '{"who":"' || c_name || '"}' END AS _rescued_data,
 4 AS versions FROM customer""")
def schema_widen(t: Tables):
    """A folder whose score turns from int to long, double and text, whose struct grows, and is a plain name at last."""
    path, kept = work_dir(t.spark, "widen"), evolution.WideningSchema(t.spark, work_dir(t.spark, "widen-schema"), {"score": "int"})
    plain, named = F.struct(F.col("c_mktsegment").alias("segment")), F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    steps = [(F.col("c_nationkey"), plain), (F.col("c_custkey") + 10_000_000_000, named), (F.floor("c_acctbal") + F.lit(0.25), named), (F.col("c_mktsegment"), F.col("c_name"))]
    versions = 0
    for i, (score, who) in enumerate(steps):
        t.customer.where(F.col("c_custkey") % 4 == i).select(F.col("c_custkey").alias("id"), score.alias("score"), who.alias("who")).write.mode("append").json(path)
        try:
            schema = kept.resolve(path)
            versions += i == 0
        except evolution.SchemaWidened:
            versions += 1
            schema = kept.resolve(path)  # the restart adopts the wider schema
    rows = evolution.read_widened(t.spark.read.text(path), schema)
    return rows.select("id", "score", "who.segment", "who.name", "_rescued_data", F.lit(versions).alias("versions"))


@query("ingest_incremental", sql="SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def ingest_incremental(t: Tables):
    source, target, ckpt = (work_dir(t.spark, x) for x in ("ingest-in", "ingest-out", "ingest-ckpt"))
    old = F.col("o_orderdate") < "1998-01-01"
    run = lambda: files.ingest(t.spark, source, target, ckpt, "parquet", t.orders.schema, max_files=16)
    t.orders.where(old).write.parquet(source)
    run()
    t.orders.where(~old).write.mode("append").parquet(source)
    run()
    run()  # nothing new: nothing is loaded twice
    return t.spark.read.parquet(target).groupBy("o_orderstatus").agg(F.count("*").alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query("ingest_fanout", sql="SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'customer', count(*) FROM customer")
def ingest_fanout(t: Tables):
    names = ("nation", "region", "customer")
    specs = {n: {"source": t.path(n), "format": "parquet", "schema": getattr(t, n).schema} for n in names}
    made = files.ingest_many(t.spark, specs, work_dir(t.spark, "fan-out"), work_dir(t.spark, "fan-ckpt"))
    parts = [t.spark.read.parquet(p).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, p in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("file_metadata", sql="SELECT p_partkey, p_brand, 1 AS has_path FROM part")
def file_metadata(t: Tables):
    rows = files.read_files(t.spark, t.path("part"), metadata=["file_path", "file_name"])
    return rows.select("p_partkey", "p_brand", (F.col("_file_path").contains("part") & F.col("_file_name").isNotNull()).cast("int").alias("has_path"))


@query("direct_file_sql", sql="SELECT n_name, n_regionkey FROM nation WHERE n_regionkey < 3")
def direct_file_sql(t: Tables):
    return t.spark.sql(f"SELECT n_name, n_regionkey FROM parquet.`{t.path('nation')}` WHERE n_regionkey < 3")


@query("scan_binary", sql="SELECT page_id, length(html) AS chars, md5(html) AS digest FROM pages")
def scan_binary(t: Tables):
    # pages are written as lines of encoded bytes, and the files read back whole
    path = work_dir(t.spark, "binary")
    t.pages.select(F.concat_ws(" ", F.col("page_id"), F.translate(F.base64(F.col("html").cast("binary")), "\r\n", "")).alias("value")).write.text(path)
    rows = files.read_files(t.spark, path, "binaryFile", glob="*.txt")
    lines = rows.select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
    html = F.unbase64(F.split_part("line", F.lit(" "), F.lit(2))).cast("string")
    found = lines.select(F.split_part("line", F.lit(" "), F.lit(1)).cast("long").alias("page_id"), html.alias("h"))
    return found.select("page_id", F.length("h").cast("long").alias("chars"), F.md5("h").alias("digest"))


@query("copy_into", sql="SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")
def copy_into(t: Tables):
    source, target = work_dir(t.spark, "copy-in"), work_dir(t.spark, "copy-out")
    for half in (0, 1):
        t.supplier.where(F.col("s_suppkey") % 2 == half).write.mode("append").parquet(source)
        files.copy_into(t.spark, source, target, "parquet", t.supplier.schema)
    files.copy_into(t.spark, source, target, "parquet", t.supplier.schema)
    return files.loaded(t.spark, target).groupBy("s_nationkey").agg(F.count("*").alias("n"))


@query("export_by_key", sql="SELECT c_mktsegment AS key, count(*) AS rows FROM customer GROUP BY 1")
def export_by_key(t: Tables):
    manifest = files.export_by_key(t.customer, "c_mktsegment", work_dir(t.spark, "export"), "json", files_per_key=4)
    return manifest.groupBy("key").agg(F.sum("rows").alias("rows"))


@query("sink_modes", sql="SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal FROM customer")
def sink_modes(t: Tables):
    table = VersionedTable(t.spark, work_dir(t.spark, "modes"))
    table.publish(t.customer, "create")
    table.publish(t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_acctbal"), "overwrite with another schema")
    table.append(t.customer.where("c_custkey % 2 = 1").select("c_custkey", F.lit(None).cast("double").alias("c_acctbal")))
    return table.read()


@query("stream_partition_sink", sql="SELECT strftime(ts, '%Y-%m-%d') AS d, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_partition_sink(t: Tables):
    target = work_dir(t.spark, "part-sink")
    files.ingest(t.spark, t.path("events"), target, work_dir(t.spark, "part-ckpt"), "parquet", t.events.schema,
                 partition_by=["d"], extra={"d": F.date_format("ts", "yyyy-MM-dd")})
    return t.spark.read.parquet(target).groupBy(day("d").alias("d"), "event_type").agg(F.count("*").alias("n"))


@query("ctas_overwrite", sql="""
SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, CASE WHEN year(o_orderdate) = 1999 THEN 0 ELSE round(o_totalprice, 2) END AS total FROM orders""")
def ctas_overwrite(t: Tables):
    path = work_dir(t.spark, "ctas")
    rows = t.orders.select("o_orderkey", rnd("o_totalprice", 2).alias("total"), F.year("o_orderdate").alias("y"))
    rebalanced(rows, "y").write.partitionBy("y").parquet(path)
    # replaces only the partitions present in the new rows
    fixed = rows.where("y = 1999").withColumn("total", F.lit(0.0))
    rebalanced(fixed, "y").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("y").parquet(path)
    return t.spark.read.parquet(path)


# ---------------------------------------------------------------- versions


def account_table(t: Tables, label: str) -> VersionedTable:
    table = VersionedTable(t.spark, work_dir(t.spark, label), ["c_custkey"], 8)
    rows = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    table.publish(rows, "create")
    table.rewrite(rows.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0)), lambda old, new: cdc.upsert(old, new, ["c_custkey"]), "reset buildings")
    return table


@query("time_travel", sql="""
SELECT 0 AS version, round(sum(c_acctbal), 2) AS balance FROM customer UNION ALL SELECT 1, round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END), 2) FROM customer
UNION ALL SELECT 2, round(sum(c_acctbal), 2) FROM customer""")
def time_travel(t: Tables):
    table = account_table(t, "travel")
    table.restore(0)
    total = lambda v: table.read(v).agg(rnd(F.sum("c_acctbal"), 2).alias("balance")).select(F.lit(v).alias("version"), "balance")
    return total(0).unionByName(total(1)).unionByName(total(2))


@query("clone", sql="""
SELECT 'deep' AS kind, round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END), 2) AS balance FROM customer UNION ALL SELECT 'shallow', round(sum(c_acctbal), 2) FROM customer""")
def clone(t: Tables):
    table = account_table(t, "clone-source")
    deep = table.clone(work_dir(t.spark, "clone-deep"))
    shallow = table.clone(work_dir(t.spark, "clone-shallow"), version=0, deep=False)
    total = lambda k, c: c.read().agg(rnd(F.sum("c_acctbal"), 2).alias("balance")).select(F.lit(k).alias("kind"), "balance")
    return total("deep", deep).unionByName(total("shallow", shallow))


@query("cluster_layout", sql="SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem WHERE l_suppkey BETWEEN 10 AND 20 AND l_partkey < 500")
def cluster_layout(t: Tables):
    table = VersionedTable(t.spark, work_dir(t.spark, "layout"))
    low, high = t.lineitem.agg(F.max("l_suppkey"), F.max("l_partkey")).first()
    table.publish(t.lineitem.withColumn("z", morton_key([("l_suppkey", 0, low), ("l_partkey", 0, high)])), "create")
    table.compact(["z"], 8)
    return table.read().where("l_suppkey BETWEEN 10 AND 20 AND l_partkey < 500").agg(F.count("*").alias("n"), rnd(F.sum("l_extendedprice"), 2).alias("total"))


@query("table_copy_verify", sql="SELECT 'nation' AS name, count(*) AS n, 1 AS same FROM nation UNION ALL SELECT 'region', count(*), 1 FROM region UNION ALL SELECT 'supplier', count(*), 1 FROM supplier")
def table_copy_verify(t: Tables):
    from millrace.sources.copying import copy_and_verify

    names = ("nation", "region", "supplier")
    return copy_and_verify(t.spark, {n: getattr(t, n) for n in names}, work_dir(t.spark, "copy-tables"))


@query("mark_and_skip", sql="""
SELECT event_id, user_id, CASE WHEN ('0x' || substr(md5(event_id::VARCHAR || 'queue'), 1, 15))::BIGINT % 100 < 10 OR event_type = 'error' THEN 'to_process' ELSE 'skipped' END AS status
FROM events""")
def mark_and_skip(t: Tables):
    """Requests without a status: a sample and all with feedback are processed, the rest skipped."""
    from millrace.functions.columns import hash_bucket

    queue = t.events.select("event_id", "user_id", F.lit(None).cast("string").alias("status"))
    feedback = t.events.where("event_type = 'error'").select("event_id").withColumn("feedback", F.lit(True))
    picked = (hash_bucket(F.col("event_id"), 100, "queue") < 10) | F.col("feedback").isNotNull()
    return queue.join(feedback, "event_id", "left").withColumn(
        "status", F.coalesce("status", F.when(picked, "to_process").otherwise("skipped"))).drop("feedback")


@query("retention", sql="SELECT 2 AS folders_removed, count(*) AS n, round(sum(s_acctbal), 2) AS balance FROM supplier WHERE s_acctbal > 0")
def retention(t: Tables):
    import datetime as dt

    table = VersionedTable(t.spark, work_dir(t.spark, "retention"))
    for floor in (-100_000, -500, 0):
        table.publish(t.supplier.where(F.col("s_acctbal") > floor), "write")
    removed = table.vacuum(dt.datetime.now() + dt.timedelta(hours=1))
    return table.read().agg(F.count("*").alias("n"), rnd(F.sum("s_acctbal"), 2).alias("balance")).select(F.lit(removed).alias("folders_removed"), "n", "balance")
