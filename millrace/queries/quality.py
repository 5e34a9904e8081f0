"""Quality rules and dataset refreshes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality as q
from millrace.plans.pipeline import Pipeline
from millrace.session import work_dir
from millrace.queries.registry import Tables, day, query, rnd

ORDER_RULES = [
    q.Rule("positive_total", "o_totalprice > 5000", "drop"),
    q.Rule("known_state", "o_orderstatus IN ('O', 'F')", "drop"),
    q.Rule("recent", "nullif(o_orderpriority, '5-LOW') IS NOT NULL AND o_orderdate >= '1996-01-01'", "warn"),
]
COUNTS = """
SELECT '{d}' AS dataset, 'positive_total' AS rule, 'drop' AS action, count(*) FILTER (WHERE o_totalprice > 5000) AS passed, count(*) FILTER (WHERE NOT o_totalprice > 5000) AS failed, count(*) FILTER (WHERE NOT o_totalprice > 5000) AS dropped FROM orders
UNION ALL SELECT '{d}', 'known_state', 'drop', count(*) FILTER (WHERE o_orderstatus IN ('O','F')), count(*) FILTER (WHERE o_orderstatus NOT IN ('O','F')), count(*) FILTER (WHERE o_orderstatus NOT IN ('O','F')) FROM orders
UNION ALL SELECT '{d}', 'recent', 'warn', count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01'), count(*) FILTER (WHERE NOT (o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01')), 0 FROM orders"""


@query("expect_warn", sql=COUNTS.format(d="orders"))
def expect_warn(t: Tables):
    return q.rule_counts(t.orders, ORDER_RULES, "orders")


@query("expect_drop", sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 5000 AND o_orderstatus IN ('O', 'F')")
def expect_drop(t: Tables):
    return q.drop_failed(t.orders, ORDER_RULES).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("expect_rules_table", sql="SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 5 AND 40 AND p_brand <> 'Brand#2'")
def expect_rules_table(t: Tables):
    table = t.spark.createDataFrame(
        [("parts", "size_low", "p_size >= 5"), ("parts", "size_high", "p_size <= 40"), ("parts", "brand", "p_brand <> 'Brand#2'"),
         ("orders", "other", "false")], "tag string, name string, constraint string")
    return q.drop_failed(t.part, q.rules_from(table, "parts")).select("p_partkey", "p_size")


@query("quarantine", sql="""
SELECT o_orderkey, concat_ws(',', CASE WHEN NOT o_totalprice > 5000 THEN 'positive_total' END, CASE WHEN o_orderstatus NOT IN ('O','F') THEN 'known_state' END,
 CASE WHEN NOT (o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01') THEN 'recent' END) AS failed
FROM orders WHERE NOT (o_totalprice > 5000 AND o_orderstatus IN ('O','F') AND o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01')""")
def quarantine(t: Tables):
    _, bad = q.quarantine(t.orders, ORDER_RULES)
    return bad.select("o_orderkey", F.array_join("failed_rules", ",").alias("failed"))


def build(t: Tables) -> Pipeline:
    """Bronze, silver and gold over orders, with rules at silver."""
    p = Pipeline(t.spark)

    @p.view()
    def orders_raw():
        return t.orders

    @p.view()
    def customers():
        return t.customer.drop("c_name")

    @p.table(rules=ORDER_RULES)
    def orders_clean(orders_raw):
        return orders_raw.withColumn("order_day", day("o_orderdate"))

    @p.table(rules=[q.Rule("has_segment", "c_mktsegment IS NOT NULL", "fail")])
    def orders_joined(orders_clean, customers):
        return orders_clean.join(customers, F.col("o_custkey") == F.col("c_custkey"))

    @p.view()
    def segment_revenue(orders_joined):
        return orders_joined.groupBy("c_mktsegment", F.substring("order_day", 1, 4).alias("year")).agg(
            F.count("*").alias("n"), rnd(F.sum("o_totalprice"), 2).alias("revenue"))

    return p


@query("medallion_refresh", sql="""
SELECT c_mktsegment, substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 5000 AND o_orderstatus IN ('O','F') GROUP BY 1, 2""")
def medallion_refresh(t: Tables):
    return build(t).refresh()["segment_revenue"]


@query("quality_log", sql=COUNTS.format(d="orders_clean") + """
UNION ALL SELECT 'orders_joined', 'has_segment', 'fail', count(*), 0, 0 FROM orders WHERE o_totalprice > 5000 AND o_orderstatus IN ('O','F')""")
def quality_log(t: Tables):
    events = build(t).refresh().events()
    # one JSON event per dataset, as a log keeps them, opened again by the reader
    entry = F.struct("rule", "action", "passed", "failed", "dropped")
    log = events.groupBy("dataset").agg(F.to_json(F.struct(F.collect_list(entry).alias("expectations"))).alias("details"))
    shape = "expectations array<struct<rule:string, action:string, passed:long, failed:long, dropped:long>>"
    opened = log.select("dataset", F.explode(F.from_json("details", shape)["expectations"]).alias("e"))
    return opened.select("dataset", "e.*")


@query("lineage_rows", sql="""
WITH n AS (SELECT 'orders_raw' AS d, (SELECT count(*) FROM orders) AS n UNION ALL SELECT 'customers', (SELECT count(*) FROM customer)
 UNION ALL SELECT 'orders_clean', (SELECT count(*) FROM orders WHERE o_totalprice > 5000 AND o_orderstatus IN ('O','F'))
 UNION ALL SELECT 'orders_joined', (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 5000 AND o_orderstatus IN ('O','F'))
 UNION ALL SELECT 'segment_revenue', (SELECT count(*) FROM (SELECT DISTINCT c_mktsegment, year(o_orderdate) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 5000 AND o_orderstatus IN ('O','F')))),
 e(input, output, kind) AS (VALUES ('orders_raw', 'orders_clean', 'table'), ('orders_clean', 'orders_joined', 'table'), ('customers', 'orders_joined', 'table'), ('orders_joined', 'segment_revenue', 'view'))
SELECT e.*, i.n AS rows_in, o.n AS rows_out FROM e JOIN n i ON i.d = input JOIN n o ON o.d = output""")
def lineage_rows(t: Tables):
    """What each dataset of a refresh was made from, with the rows that went in and came out."""
    pipeline = build(t)
    made = pipeline.refresh().tables
    sizes = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).withColumn("d", F.lit(name)) for name, df in made.items()])
    side = lambda name, n: sizes.select(F.col("d").alias(name), F.col("n").alias(n))
    return pipeline.lineage().join(side("input", "rows_in"), "input").join(side("output", "rows_out"), "output")


@query("quality_report", sql="""
SELECT d, rule, sum(bad)::BIGINT AS failed, count(*) AS seen, round(sum(bad) / count(*), 6) AS failure_rate FROM (
 SELECT strftime(o_orderdate, '%Y-%m') AS d, 'positive_total' AS rule, (NOT o_totalprice > 5000)::INT AS bad FROM orders
 UNION ALL SELECT strftime(o_orderdate, '%Y-%m'), 'known_state', (o_orderstatus NOT IN ('O','F'))::INT FROM orders
 UNION ALL SELECT strftime(o_orderdate, '%Y-%m'), 'recent', (NOT (o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01'))::INT FROM orders) GROUP BY 1, 2""")
def quality_report(t: Tables):
    rows = t.orders.withColumn("d", F.date_format("o_orderdate", "yyyy-MM"))
    counts = q.rule_counts(rows, ORDER_RULES, "orders", by=["d"])
    seen = F.col("passed") + F.col("failed")
    return counts.select("d", "rule", "failed", seen.alias("seen"), rnd(F.col("failed") / seen, 6).alias("failure_rate"))


@query("schema_contract", sql="""
SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, round(c_acctbal, 2) AS balance, c_mktsegment AS segment FROM customer""")
def schema_contract(t: Tables):
    contract = T.StructType([
        T.StructField("id", T.LongType(), False, {"comment": "customer number"}),
        T.StructField("nation", T.LongType(), True, {"comment": "nation number"}),
        T.StructField("balance", T.DoubleType(), True, {"comment": "account balance"}),
        T.StructField("segment", T.StringType(), False, {"comment": "market segment"})])
    raw = t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"),
                            F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.lit(1).alias("extra"))
    return q.conform(raw, contract)


@query("expect_fail", sql="""
WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice < 1000) AS poor FROM orders)
SELECT 'known_key' AS rule, 'updated' AS outcome, n AS rows_after, NULL AS broken_rule FROM n
UNION ALL SELECT 'fair_price', CASE WHEN poor > 0 THEN 'failed' ELSE 'updated' END, CASE WHEN poor > 0 THEN 0 ELSE n END, CASE WHEN poor > 0 THEN 'fair_price' END FROM n""")
def expect_fail(t: Tables):
    """Two updates of an empty dataset: one whose rule holds, and one that a broken row makes fail, which leaves the dataset as it was."""
    tries = [("known_key", "o_orderkey >= 0"), ("fair_price", "o_totalprice >= 1000")]
    made = []
    for name, predicate in tries:
        broken = q.update_or_keep(q.fail_if_broken(t.orders, [q.Rule(name, predicate, "fail")], "orders"), path := work_dir(t.spark, f"expect-{name}"))
        left = 0 if broken else t.spark.read.parquet(path).count()
        made.append((name, "failed" if broken else "updated", left, broken))
    return t.spark.createDataFrame(made, "rule string, outcome string, rows_after long, broken_rule string")
