"""Grouped aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import exact_percentiles, text_lists, totals_at_levels, trailing_months
from millrace.queries.registry import Tables, day, ntz, query, rnd


@query("agg_basic", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
 round(avg(l_discount), 6) AS avg_disc, min(l_shipdate) AS first_ship, max(l_tax) AS max_tax FROM lineitem GROUP BY 1, 2""")
def agg_basic(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), rnd(F.sum("l_quantity"), 2).alias("sum_qty"), rnd(F.sum("l_extendedprice"), 2).alias("sum_price"),
        rnd(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_shipdate").alias("first_ship"), F.max("l_tax").alias("max_tax"))


@query("agg_distinct", sql="""
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) AS n FROM events GROUP BY 1""")
def agg_distinct(t: Tables):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days"), F.count("*").alias("n"))


@query("agg_approx_distinct", sql="SELECT event_type, count(DISTINCT user_id) AS users, true AS estimate_close FROM events GROUP BY 1")
def agg_approx_distinct(t: Tables):
    # the estimate beside the exact count: within three of its standard errors; equal values leave the sketch as it is, so both are made
    # of the distinct pairs (beside a distinct count in one aggregate, Spark would keep a sketch for every pair)
    pairs = t.events.select("event_type", "user_id").distinct()
    both = pairs.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("guess"), F.count("user_id").alias("users"))
    return both.select("event_type", "users", (F.abs(F.col("guess") - F.col("users")) <= 0.06 * F.col("users")).alias("estimate_close"))


@query("agg_filter", sql="""
SELECT o_orderpriority, count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 250000) AS big_customers,
 count(*) FILTER (WHERE o_orderstatus = 'F') AS done, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS open_total
FROM orders GROUP BY 1""")
def agg_filter(t: Tables):
    t.views("orders")
    return t.spark.sql("""
        SELECT o_orderpriority, count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 250000) AS big_customers,
               count_if(o_orderstatus = 'F') AS done, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS open_total
        FROM orders GROUP BY o_orderpriority""")


@query("agg_conditional", sql="""
SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS returned,
 round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END), 2) AS accepted,
 round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) / sum(l_extendedprice), 6) AS returned_share
FROM lineitem GROUP BY 1""")
def agg_conditional(t: Tables):
    by = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice")).otherwise(0.0))
    return t.lineitem.groupBy("l_suppkey").agg(
        rnd(by("R"), 2).alias("returned"), rnd(by("A"), 2).alias("accepted"),
        rnd(by("R") / F.sum("l_extendedprice"), 6).alias("returned_share"))


@query("agg_minby", sql="""
SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY 1""")
def agg_minby(t: Tables):
    at = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(
        F.min_by("event_type", at).alias("first_type"), F.max_by("event_type", at).alias("last_type"),
        F.max_by("value", at).alias("last_value"))


@query("agg_first_det", sql="""
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, count(*) AS n FROM orders GROUP BY 1""")
def agg_first_det(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"), F.count("*").alias("n"))


@query("agg_stddev", sql="""
SELECT event_type, round(stddev_pop(value), 6) AS sd_pop, round(stddev_samp(value), 6) AS sd, round(var_samp(value), 4) AS var_samp,
 round(corr(value, user_id), 6) AS corr_user, round(covar_pop(value, user_id), 4) AS cov_user FROM events GROUP BY 1""")
def agg_stddev(t: Tables):
    return t.events.groupBy("event_type").agg(
        rnd(F.stddev_pop("value"), 6).alias("sd_pop"), rnd(F.stddev("value"), 6).alias("sd"),
        rnd(F.var_samp("value"), 4).alias("var_samp"), rnd(F.corr("value", F.col("user_id").cast("double")), 6).alias("corr_user"),
        rnd(F.covar_pop("value", F.col("user_id").cast("double")), 4).alias("cov_user"))


@query("agg_percentile", sql="""
SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50,
 round(quantile_cont(value, 0.95), 6) AS p95, round(median(value), 6) AS med FROM events GROUP BY 1""")
def agg_percentile(t: Tables):
    out = exact_percentiles(t.events, ["event_type"], "value", {"p10": 0.1, "p50": 0.5, "p95": 0.95})
    return out.select("event_type", rnd("p10", 6).alias("p10"), rnd("p50", 6).alias("p50"), rnd("p95", 6).alias("p95"), rnd("p50", 6).alias("med"))


@query("agg_percentile_approx", sql="SELECT event_type, count(value) AS n, true AS p10_close, true AS p50_close, true AS p95_close FROM events GROUP BY 1")
def agg_percentile_approx(t: Tables):
    # the estimates beside exact ranks: the share of values below each is within a thousandth of what it stands for
    marks = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    guess = t.events.groupBy("event_type").agg(F.percentile_approx("value", list(marks.values()), 10000).alias("q"))
    below = [F.count_if(F.col("value") < F.col("q")[i]).alias(f"{m}_under") for i, m in enumerate(marks)]
    upto = [F.count_if(F.col("value") <= F.col("q")[i]).alias(f"{m}_upto") for i, m in enumerate(marks)]
    ranks = t.events.join(guess, "event_type").groupBy("event_type").agg(F.count("value").alias("n"), *below, *upto)
    slack = 0.001 * F.col("n") + 1
    return ranks.select("event_type", "n", *[((F.col(f"{m}_under") <= p * F.col("n") + slack) & (F.col(f"{m}_upto") >= p * F.col("n") - slack)).alias(f"{m}_close")
                                            for m, p in marks.items()])


@query("agg_grouping_sets", sql="""
SELECT CASE WHEN grouping(n_name) = 1 THEN 'ALL' ELSE n_name END AS nation, CASE WHEN grouping(c_mktsegment) = 1 THEN 'ALL' ELSE c_mktsegment END AS segment,
 count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY GROUPING SETS ((n_name, c_mktsegment), (n_name), (c_mktsegment), ())""")
def agg_grouping_sets(t: Tables):
    facts = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), "o_totalprice"))
    return totals_at_levels(facts, [["nation", "segment"], ["nation"], ["segment"], []],
                            [F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total")])


@query("agg_rollup", sql="""
SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus, o_orderpriority)::BIGINT AS level, count(*) AS n FROM orders
GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def agg_rollup(t: Tables):
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(
        F.grouping_id().cast("long").alias("level"), F.count("*").alias("n"))


@query("agg_cube", sql="""
SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::BIGINT AS level, round(sum(l_quantity), 2) AS qty FROM lineitem
GROUP BY CUBE (l_returnflag, l_linestatus)""")
def agg_cube(t: Tables):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id().cast("long").alias("level"), rnd(F.sum("l_quantity"), 2).alias("qty"))


@query("agg_group_by_all", sql="""
SELECT o_orderstatus, year(o_orderdate)::INTEGER AS y, count(*) AS n FROM orders GROUP BY ALL""")
def agg_group_by_all(t: Tables):
    return t.views("orders").sql("SELECT o_orderstatus, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL ORDER BY 1, 2")


@query("agg_having", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING copies > 1""")
def agg_having(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).where("copies > 1")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("agg_pivot", sql="SELECT strftime(ts, '%Y-%m-%d') AS d, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES) + " FROM events GROUP BY 1")
def agg_pivot(t: Tables):
    return t.events.groupBy(day("ts").alias("d")).pivot("event_type", EVENT_TYPES).agg(F.count(F.lit(1))).fillna(0, EVENT_TYPES)


@query("agg_histogram", sql="""
SELECT CAST(floor(o_totalprice / 25000) * 25000 AS BIGINT) AS bucket_from, count(*) AS n FROM orders GROUP BY 1""")
def agg_histogram(t: Tables):
    return t.orders.groupBy((F.floor(F.col("o_totalprice") / 25000) * 25000).alias("bucket_from")).agg(F.count("*").alias("n"))


@query("agg_collect", sql="""
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ' | ') AS priorities FROM orders GROUP BY 1""")
def agg_collect(t: Tables):
    # a set over a fixed domain: the list per key cannot grow with the key's rows
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), " | ").alias("priorities"))


@query("agg_text_list", sql="""
WITH n AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity, l_linestatus || l_orderkey::VARCHAR AS t,
 row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_quantity, l_linestatus) AS n FROM lineitem)
SELECT l_returnflag, (n - 1) // 1000 AS segment, count(*) AS texts, string_agg(t, '; ' ORDER BY n) AS lines FROM n GROUP BY 1, 2""")
def agg_text_list(t: Tables):
    rows = t.lineitem.withColumn("t", F.concat("l_linestatus", F.col("l_orderkey").cast("string")))
    return text_lists(rows, ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_quantity", "l_linestatus"], "t", "lines")


@query("agg_ratio", sql="""
SELECT l_suppkey, round(sum(l_discount * l_extendedprice) / nullif(sum(l_extendedprice), 0), 8) AS disc_rate,
 round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN l_tax > 1 THEN 1 ELSE 0 END), 0), 6) AS never
FROM lineitem GROUP BY 1""")
def agg_ratio(t: Tables):
    c = F.col
    return t.lineitem.groupBy("l_suppkey").agg(
        rnd(F.try_divide(F.sum(c("l_discount") * c("l_extendedprice")), F.sum("l_extendedprice")), 8).alias("disc_rate"),
        rnd(F.try_divide(F.count_if(c("l_returnflag") == "R"), F.count_if(c("l_tax") > 1)), 6).alias("never"))


@query("agg_pct_total", sql="""
SELECT p_brand, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM part), 6) AS pct FROM part GROUP BY 1""")
def agg_pct_total(t: Tables):
    # the total comes from the grouped counts, not from a second scan or a one-task window
    counts = t.part.groupBy("p_brand").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", rnd(100.0 * F.col("n") / counts.select(F.sum("n")).scalar(), 6))


@query("agg_state_share", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS d, event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY strftime(ts, '%Y-%m-%d')), 6) AS share
FROM events GROUP BY 1, 2""")
def agg_state_share(t: Tables):
    from pyspark.sql import Window

    daily = t.events.groupBy(day("ts").alias("d"), "event_type").agg(F.count("*").alias("n"))
    return daily.withColumn("share", rnd(F.col("n") / F.sum("n").over(Window.partitionBy("d")), 6))


@query("agg_multi_horizon", sql="""
WITH m AS (SELECT max(o_orderdate) AS m FROM orders)
SELECT o_custkey""" + "".join(f""",
 round(sum(CASE WHEN o_orderdate >= m - INTERVAL {n} MONTH THEN o_totalprice END), 2) AS total_{n}m,
 count(CASE WHEN o_orderdate >= m - INTERVAL {n} MONTH THEN 1 END) AS orders_{n}m,
 count(DISTINCT CASE WHEN o_orderdate >= m - INTERVAL {n} MONTH THEN o_orderpriority END) AS kinds_{n}m""" for n in (3, 6, 12)) + """
FROM orders, m WHERE o_orderdate >= m - INTERVAL 12 MONTH GROUP BY 1""")
def agg_multi_horizon(t: Tables):
    anchor = t.orders.select(F.max("o_orderdate")).scalar()
    out = trailing_months(t.orders, ["o_custkey"], "o_orderdate", anchor, [3, 6, 12], {
        "total": ("sum", F.col("o_totalprice")), "orders": ("count", F.lit(1)), "kinds": ("distinct", F.col("o_orderpriority"))})
    return out.withColumns({f"total_{n}m": rnd(f"total_{n}m", 2) for n in (3, 6, 12)})


@query("agg_time_bucket", sql="""
SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def agg_time_bucket(t: Tables):
    return t.events.groupBy(ntz(F.date_trunc("hour", "ts")).alias("hour"), "event_type").agg(
        F.count("*").alias("n"), rnd(F.sum("value"), 2).alias("total"))
