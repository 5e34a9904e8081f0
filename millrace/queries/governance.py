"""Row filters, masks and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import mask_tail
from millrace.operators import policy
from millrace.queries.registry import Tables, query, rnd


@query("row_filter", sql="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice < 300000")
def row_filter(t: Tables):
    rule = policy.RowFilter("o_orderstatus <> 'P' AND o_totalprice < 300000", exempt=["auditors"])
    return rule.apply(t.orders, groups=["analysts"]).select("o_orderkey", "o_orderstatus")


@query("row_filter_mapping", sql="SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_7')")
def row_filter_mapping(t: Tables):
    mapping = t.spark.createDataFrame(
        [("emea", ["NATION_1", "NATION_2"]), ("apac", ["NATION_9"]), ("latam", ["NATION_7", "NATION_2"])], "member_of string, values array<string>")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return policy.filter_by_mapping(rows, mapping, ["emea", "latam"], "n_name")


@query("column_mask", sql="""
SELECT c_custkey, repeat('*', length(c_name) - 4) || right(c_name, 4) AS c_name, 0::DOUBLE AS c_acctbal, c_mktsegment FROM customer""")
def column_mask(t: Tables):
    out = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    for m in (policy.ColumnMask("c_name", mask_tail, ["stewards"]), policy.ColumnMask("c_acctbal", lambda c: F.lit(0.0), ["finance"]),
              policy.ColumnMask("c_mktsegment", lambda c: F.lit("x"), ["analysts"])):
        out = m.apply(out, ["analysts"])
    return out


@query("gdpr_view", sql="""
SELECT c_custkey, CASE WHEN n_name = 'NATION_3' THEN sha1(c_name) ELSE c_name END AS c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_3', 'NATION_4')""")
def gdpr_view(t: Tables):
    grants = t.spark.createDataFrame([("ana", "NATION_3", 1), ("ana", "NATION_4", 0), ("bo", "NATION_5", 0)], "reader string, country string, gdpr int")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    return policy.pseudonymise(rows, grants, "ana", "n_name", ["c_name"])


@query("encrypt_view", sql="SELECT c_custkey, c_name, 1 AS sealed FROM customer")
def encrypt_view(t: Tables):
    secret = F.lit("0123456789abcdef")
    rows = t.customer.select("c_custkey", "c_name", F.col("c_name").alias("plain"))
    sealed = policy.seal(rows, ["c_name"], secret, can_read=False).withColumn("sealed", (F.col("c_name") != F.col("plain")).cast("int"))
    return policy.unseal(sealed, ["c_name"], secret).drop("plain")


@query("recipient_slice", sql="""
SELECT recipient, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN (VALUES ('east', 'BUILDING'), ('east', 'MACHINERY'), ('west', 'MACHINERY')) g(recipient, value)
 ON c_mktsegment = value GROUP BY 1""")
def recipient_slice(t: Tables):
    from millrace.session import work_dir

    grants = t.spark.createDataFrame([("east", "BUILDING"), ("east", "MACHINERY"), ("west", "MACHINERY")], "recipient string, value string")
    path = work_dir(t.spark, "share")
    policy.export_slices(t.customer, grants, "c_mktsegment", path)
    return t.spark.read.parquet(path).groupBy("recipient").agg(F.count("*").alias("n"), rnd(F.sum("c_acctbal"), 2).alias("balance"))


@query("tag_policy", sql="SELECT c_custkey, repeat('*', length(c_name) - 4) || right(c_name, 4) AS c_name, 0::DOUBLE AS c_acctbal, c_mktsegment FROM customer")
def tag_policy(t: Tables):
    tagged = policy.tag(t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), {"c_name": {"pii": "name"}, "c_acctbal": {"pii": "money"}})
    masks = {("pii", "name"): mask_tail, ("pii", "money"): lambda c: F.lit(0.0)}
    return policy.apply_tag_masks(tagged, masks, groups=["analysts"], exempt=["stewards"])
