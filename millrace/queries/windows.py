"""Window functions, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.columns import hash_bucket
from millrace.operators.intervals import number_sessions, pack_intervals
from millrace.operators.ordered import OrderedGroups, global_numbers
from millrace.operators.sampling import sample_share, top_per_group
from millrace.queries.registry import Tables, day, ntz, query, rnd


@query("win_latest", sql="""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def win_latest(t: Tables):
    return top_per_group(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"],
                         [F.desc("o_orderdate"), F.desc("o_orderkey")], 1)


@query("win_qualify", sql="""
SELECT user_id, event_id, event_type, ts FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def win_qualify(t: Tables):
    live = t.events.where("event_type <> 'error'").select("user_id", "event_id", "event_type", "ts")
    return top_per_group(live, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")], 1)


@query("win_rank", sql="""
SELECT o_custkey, o_orderkey, rank() OVER w AS rk, dense_rank() OVER w AS drk FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC) QUALIFY dense_rank() OVER w <= 2""")
def win_rank(t: Tables):
    from millrace.operators.aggregates import ranks

    rows = t.orders.select("o_custkey", "o_orderkey", F.date_trunc("month", "o_orderdate").alias("m"))
    return ranks(rows, ["o_custkey"], "m", "rk", "drk").where("drk <= 2").select("o_custkey", "o_orderkey", "rk", "drk")


@query("win_lag_lead", sql="""
SELECT event_id, user_id, lag(ts) OVER w AS prev_ts, lead(event_type) OVER w AS next_type,
 (epoch_us(ts) - epoch_us(lag(ts) OVER w)) // 1000000 AS gap_seconds FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag_lead(t: Tables):
    g = OrderedGroups(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"])
    out = g.lag({"prev_ts": "ts"}).lead({"next_type": "event_type"}).result()
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return out.select("event_id", "user_id", "prev_ts", "next_type",
                      F.floor((us("ts") - us("prev_ts")) / 1000000).alias("gap_seconds"))


@query("win_hot_key", sql="""
SELECT l_orderkey, l_linenumber, row_number() OVER w AS n, round(sum(l_quantity) OVER (w ROWS UNBOUNDED PRECEDING), 2) AS shipped,
 lag(l_orderkey) OVER w AS before, lead(l_linenumber) OVER w AS next_line FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_linestatus, l_shipdate, l_orderkey, l_linenumber, l_quantity)""")
def win_hot_key(t: Tables):
    """Three keys, each with about a third of all rows and a handful of values in the first order column: cut into chunks at any size of the table."""
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    g = OrderedGroups(rows, ["l_returnflag"], ["l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"], always=True)
    out = g.row_number("n").running({"shipped": ("sum", F.col("l_quantity"))}).lag({"before": "l_orderkey"}).lead({"next_line": "l_linenumber"}).result()
    return out.select("l_orderkey", "l_linenumber", "n", rnd("shipped", 2).alias("shipped"), "before", "next_line")


@query("win_lag_agg", sql="""
WITH m AS (SELECT c_mktsegment, date_trunc('month', o_orderdate)::TIMESTAMP AS month, sum(o_totalprice) AS total
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_mktsegment, month, round(total, 2) AS total, round(lag(total) OVER (PARTITION BY c_mktsegment ORDER BY month), 2) AS previous_total,
 round(total - lag(total) OVER (PARTITION BY c_mktsegment ORDER BY month), 2) AS change FROM m""")
def win_lag_agg(t: Tables):
    monthly = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", ntz(F.date_trunc("month", "o_orderdate")).alias("month")).agg(F.sum("o_totalprice").alias("total")))
    previous = F.lag("total").over(Window.partitionBy("c_mktsegment").orderBy("month"))
    return monthly.withColumn("p", previous).select(
        "c_mktsegment", "month", rnd("total", 2).alias("total"), rnd("p", 2).alias("previous_total"),
        rnd(F.col("total") - F.col("p"), 2).alias("change"))


@query("win_running", sql="""
SELECT event_id, user_id, max(value) OVER w AS peak, count(*) OVER w AS seen, round(sum(value) OVER w, 2) AS spent FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def win_running(t: Tables):
    g = OrderedGroups(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"])
    out = g.running({"peak": ("max", F.col("value")), "seen": ("count", F.lit(1)), "spent": ("sum", F.col("value"))}).result()
    return out.select("event_id", "user_id", "peak", "seen", rnd("spent", 2).alias("spent"))


@query("win_range_7d", sql="""
SELECT event_id, user_id, round(sum(value) OVER w, 2) AS sum_7d, count(*) OVER w AS n_7d FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""")
def win_range_7d(t: Tables):
    from millrace.operators.features import rolling

    out = rolling(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", 7 * 86400,
                  {"sum_7d": ("sum", F.col("value")), "n_7d": ("count", F.lit(1))})
    return out.select("event_id", "user_id", rnd("sum_7d", 2).alias("sum_7d"), "n_7d")


@query("win_smooth", sql="""
WITH d AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS d, sum(value) AS v FROM events GROUP BY 1, 2)
SELECT event_type, d, round(avg(v) OVER (PARTITION BY event_type ORDER BY d ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING), 4) AS smooth FROM d""")
def win_smooth(t: Tables):
    daily = t.events.groupBy("event_type", day("ts").alias("d")).agg(F.sum("value").alias("v"))
    w = Window.partitionBy("event_type").orderBy("d").rowsBetween(-7, 7)
    return daily.select("event_type", "d", rnd(F.avg("v").over(w)).alias("smooth"))


@query("win_partition_max", sql="""
SELECT o_orderkey, o_custkey, max(o_totalprice) OVER (PARTITION BY o_custkey) AS cap,
 round(o_totalprice / max(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share FROM orders""")
def win_partition_max(t: Tables):
    # aggregate and join back: the aggregate combines map-side and the join splits hot keys
    cap = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("cap"))
    return t.orders.join(cap, "o_custkey").select(
        "o_orderkey", "o_custkey", "cap", rnd(F.col("o_totalprice") / F.col("cap"), 6).alias("share"))


@query("win_compound", sql="""
WITH m AS (SELECT p_brand, date_trunc('month', l_shipdate)::TIMESTAMP AS month, avg(l_extendedprice / l_quantity) AS price
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
 r AS (SELECT *, price / lag(price) OVER (PARTITION BY p_brand ORDER BY month) - 1 AS ret FROM m)
SELECT p_brand, month, round(ln(exp(sum(ln(1 + ret)) OVER (PARTITION BY p_brand ORDER BY month ROWS UNBOUNDED PRECEDING))), 7) AS log_growth FROM r""")
def win_compound(t: Tables):
    monthly = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", ntz(F.date_trunc("month", "l_shipdate")).alias("month"))
        .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")))
    w = Window.partitionBy("p_brand").orderBy("month")
    returns = monthly.withColumn("ret", F.col("price") / F.lag("price").over(w) - 1)
    grown = F.exp(F.sum(F.log1p("ret")).over(w.rowsBetween(Window.unboundedPreceding, 0))) - 1
    return returns.select("p_brand", "month", rnd(F.log1p(grown), 7).alias("log_growth"))


@query("win_pack_intervals", sql="""
WITH s AS (SELECT user_id, ts AS span_start, ts + INTERVAL 6 HOUR AS span_end FROM events),
 m AS (SELECT *, max(span_end) OVER (PARTITION BY user_id ORDER BY span_start, span_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
 g AS (SELECT *, sum(CASE WHEN reach IS NULL OR span_start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY span_start, span_end ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT user_id, min(span_start) AS span_start, max(span_end) AS span_end, count(*) AS merged FROM g GROUP BY user_id, g""")
def win_pack_intervals(t: Tables):
    spans = t.events.select("user_id", F.col("ts").alias("span_start"), (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("span_end"))
    return pack_intervals(spans, ["user_id"], "span_start", "span_end")


@query("win_topn_group", sql="""
WITH s AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1, 2)
SELECT month, l_partkey, revenue FROM s QUALIFY row_number() OVER (PARTITION BY month ORDER BY revenue DESC, l_partkey) <= 10""")
def win_topn_group(t: Tables):
    sales = t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_partkey").agg(
        rnd(F.sum("l_extendedprice"), 2).alias("revenue"))
    return top_per_group(sales, ["month"], [F.desc("revenue"), F.asc("l_partkey")], 10)


@query("surrogate_key", sql="""
SELECT row_number() OVER (ORDER BY o_orderkey) AS order_sk, o_orderkey FROM orders""")
def surrogate_key(t: Tables):
    return global_numbers(t.orders.select("o_orderkey"), ["o_orderkey"], "order_sk")


@query("sessionize_batch", sql="""
WITH f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM f)
SELECT user_id, session_no::BIGINT AS session_no, min(ts) AS started, max(ts) AS ended, count(*) AS n_events,
 count(*) FILTER (WHERE event_type = 'click') AS clicks FROM s GROUP BY 1, 2""")
def sessionize_batch(t: Tables):
    numbered = number_sessions(t.events, ["user_id"], "ts", ["event_id"], 12 * 3600)
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("n_events"),
        F.count_if(F.col("event_type") == "click").alias("clicks"))


# ---------------------------------------------------------------- sort, limit, sampling


@query("sort_multi", sql="SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey")
def sort_multi(t: Tables):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        F.asc("c_mktsegment"), F.desc("c_acctbal"), F.asc("c_custkey"))


@query("topk", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("sample_seeded", sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE ('0x' || substr(md5(o_orderkey::VARCHAR || 'seed-7'), 1, 15))::BIGINT % 1000000 < 100000""")
def sample_seeded(t: Tables):
    return sample_share(t.orders, F.col("o_orderkey"), 0.1, "seed-7").select("o_orderkey", "o_totalprice")


@query("sample_per_group", sql="""
SELECT event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY md5(event_id::VARCHAR), event_id) <= 3""")
def sample_per_group(t: Tables):
    rows = t.events.select("event_id", "event_type", F.date_trunc("hour", "ts").alias("h"), F.md5(F.col("event_id").cast("string")).alias("r"))
    return top_per_group(rows, ["event_type", "h"], [F.asc("r"), F.asc("event_id")], 3).select("event_id", "event_type")


@query("split_time", sql="""
SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'validate' ELSE 'test' END AS part,
 count(*) AS n, round(avg(o_totalprice), 4) AS avg_total FROM orders GROUP BY 1""")
def split_time(t: Tables):
    part = F.when(F.col("o_orderdate") < "2000-01-01", "train").when(F.col("o_orderdate") < "2001-01-01", "validate").otherwise("test")
    return t.orders.groupBy(part.alias("part")).agg(F.count("*").alias("n"), rnd(F.avg("o_totalprice")).alias("avg_total"))


@query("split_hash", sql="""
SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR || 'split'), 1, 15))::BIGINT % 10 < 8 THEN 'train' ELSE 'test' END AS part FROM orders""")
def split_hash(t: Tables):
    return t.orders.select(
        "o_orderkey", F.when(hash_bucket(F.col("o_orderkey"), 10, "split") < 8, "train").otherwise("test").alias("part"))


# ---------------------------------------------------------------- set operations


@query("union_all", sql="""
SELECT 'order' AS kind, o_orderkey AS id, o_orderdate AS at FROM orders UNION ALL SELECT 'event', event_id, ts FROM events""")
def union_all(t: Tables):
    a = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
    return a.unionByName(t.events.select(F.col("ts").alias("at"), F.col("event_id").alias("id"), F.lit("event").alias("kind")))


@query("union_distinct", sql="SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("distinct_keys", sql="""
SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2""")
def distinct_keys(t: Tables):
    # dropDuplicates(keys) keeps any row; the smallest id makes the choice repeatable
    return t.orders.select("o_custkey", "o_orderpriority", "o_orderkey").groupBy("o_custkey", "o_orderpriority").agg(
        F.min("o_orderkey").alias("o_orderkey"))


@query("set_intersect", sql="SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size > 25")
def set_intersect(t: Tables):
    a = t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return a.intersect(t.part.where("p_size > 25").select("p_partkey"))


@query("set_except", sql="""
SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem""")
def set_except(t: Tables):
    keys = t.lineitem.select("l_orderkey", "l_linenumber")
    return keys.exceptAll(keys.distinct())


@query("recursive_cte", sql="""
WITH RECURSIVE up AS (SELECT p_partkey AS part, p_partkey AS top, 0 AS depth FROM part UNION ALL
 SELECT part, top // 2, depth + 1 FROM up WHERE top > 0)
SELECT part, max(depth)::INTEGER AS depth FROM up GROUP BY part""")
def recursive_cte(t: Tables):
    # without LIMIT ALL Spark ends a recursion with an error at a fixed number of rows
    return t.views("part").sql("""
        WITH RECURSIVE up(part, top, depth) AS (
            SELECT p_partkey, p_partkey, 0 FROM part
            UNION ALL SELECT part, top DIV 2, depth + 1 FROM up WHERE top > 0)
        SELECT part, max(depth) AS depth FROM (SELECT * FROM up LIMIT ALL) GROUP BY part""")
