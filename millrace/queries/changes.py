"""Change data capture and table DML."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.queries.registry import Tables, day, query, rnd

# Accounts: state of each customer after the orders before one date; the updates are all orders from that date on.
BASE = """
acc AS (SELECT o_custkey AS id, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS amount FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
 upd AS (SELECT o_custkey AS id, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS amount FROM orders
  WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1)"""


def accounts(t: Tables, where: str):
    return t.orders.where(where).groupBy(F.col("o_custkey").alias("id")).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("status"), F.max_by("o_totalprice", "o_orderkey").alias("amount"))


def base(t):
    return accounts(t, "o_orderdate < '2000-01-01'")


def updates(t):
    return accounts(t, "o_orderdate >= '2000-01-01'")


@query("merge_upsert", sql=f"""
WITH {BASE} SELECT coalesce(a.id, u.id) AS id, coalesce(u.status, a.status) AS status, coalesce(u.amount, a.amount) AS amount
FROM acc a FULL JOIN upd u ON a.id = u.id
WHERE NOT (a.id IS NOT NULL AND u.id IS NOT NULL AND u.status = 'F') AND NOT (a.id IS NULL AND u.status = 'F')""")
def merge_upsert(t: Tables):
    return cdc.upsert(base(t), updates(t), ["id"], delete_when="s.status = 'F'")


@query("merge_columns", sql=f"""
WITH {BASE} SELECT coalesce(a.id, u.id) AS id, CASE WHEN a.id IS NULL THEN 'new' ELSE a.status END AS status,
 CASE WHEN u.id IS NULL THEN a.amount WHEN a.id IS NULL THEN u.amount ELSE greatest(a.amount, u.amount) END AS amount
FROM acc a FULL JOIN upd u ON a.id = u.id""")
def merge_columns(t: Tables):
    return cdc.merge(base(t), updates(t), ["id"], [
        cdc.Clause("matched", "update", values={"amount": "greatest(t.amount, s.amount)"}),
        cdc.Clause("not_matched", "insert", values={"id": "s.id", "status": "'new'", "amount": "s.amount"})])


FEED = """feed AS (SELECT o_custkey AS id, o_orderdate AS seq, o_orderkey AS seq2, CASE WHEN o_orderstatus = 'F' THEN 'DELETE' ELSE 'UPDATE' END AS op,
 o_orderpriority AS priority, o_totalprice AS amount FROM orders)"""


def feed(t: Tables):
    return t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("seq"), F.col("o_orderkey").alias("seq2"),
        F.when(F.col("o_orderstatus") == "F", "DELETE").otherwise("UPDATE").alias("op"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("amount"))


@query("scd1", sql=f"""
WITH {FEED}, l AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC, seq2 DESC) = 1)
SELECT id, priority, amount FROM l WHERE op <> 'DELETE'""")
def scd1(t: Tables):
    # two batches, the second holding late events: older rows must not win
    rows, options = feed(t), dict(keys=["id"], sequence=["seq", "seq2"], delete_when="op = 'DELETE'", drop=["op"])
    late = F.col("seq2") % 2 == 0
    state = cdc.scd1_state(rows.where(~late), **options)
    return cdc.scd1_rows(cdc.scd1_state(rows.where(late), state=state, **options), ["seq", "seq2"])


@query("scd2", sql=f"""
WITH {FEED}, a AS (SELECT *, op = 'DELETE' AS gone FROM feed),
 b AS (SELECT *, lag(gone) OVER w AS pg, lag(priority) OVER w AS pp FROM a WINDOW w AS (PARTITION BY id ORDER BY seq, seq2)),
 c AS (SELECT * FROM b WHERE CASE WHEN gone THEN NOT coalesce(pg, true) ELSE pg IS NULL OR pg OR priority IS DISTINCT FROM pp END),
 d AS (SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq, seq2) AS e FROM c)
SELECT id, priority, amount, seq AS __START_AT, e AS __END_AT FROM d WHERE NOT gone""")
def scd2(t: Tables):
    return cdc.scd2(feed(t), ["id"], ["seq", "seq2"], "op = 'DELETE'", track=["priority"], drop=["op"])


@query("change_feed", sql=f"""
WITH {BASE}, j AS (SELECT a.id AS ai, a.status AS s0, a.amount AS m0, u.id AS ui, u.status AS s1, u.amount AS m1 FROM acc a FULL JOIN upd u ON a.id = u.id)
SELECT ui AS id, s1 AS status, m1 AS amount, 'insert' AS _change_type, 1::BIGINT AS _commit_version FROM j WHERE ai IS NULL
UNION ALL SELECT ai, s0, m0, 'delete', 1 FROM j WHERE ui IS NULL
UNION ALL SELECT ai, s0, m0, 'update_preimage', 1 FROM j WHERE ai = ui AND (s0, m0) IS DISTINCT FROM (s1, m1)
UNION ALL SELECT ui, s1, m1, 'update_postimage', 1 FROM j WHERE ai = ui AND (s0, m0) IS DISTINCT FROM (s1, m1)""")
def change_feed(t: Tables):
    return cdc.change_feed(base(t), updates(t), ["id"], 1)


@query("apply_change_feed", sql=f"WITH {BASE} SELECT * FROM upd")
def apply_change_feed(t: Tables):
    return cdc.apply_feed(base(t), cdc.change_feed(base(t), updates(t), ["id"], 1), ["id"])


@query("update_where", sql="""
SELECT o_orderkey, CASE WHEN o_totalprice < 10000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 round(CASE WHEN o_totalprice < 10000 THEN o_totalprice + 250.5 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""")
def update_where(t: Tables):
    return cdc.update_where(t.orders, "o_totalprice < 10000", {
        "o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 250.5}).select(
        "o_orderkey", "o_orderstatus", rnd("o_totalprice", 2).alias("o_totalprice"))


@query("delete_where", sql="SELECT event_id, event_type FROM events WHERE NOT coalesce(event_type = 'error' AND value < 10, false)")
def delete_where(t: Tables):
    return cdc.delete_where(t.events, "event_type = 'error' AND value < 10").select("event_id", "event_type")


@query("identity_column", sql="""
SELECT c_custkey, (100 + 10 * (row_number() OVER (ORDER BY c_custkey) - 1))::BIGINT AS id FROM customer""")
def identity_column(t: Tables):
    return cdc.add_identity(t.customer.select("c_custkey"), ["c_custkey"], "id", start=100, step=10)


@query("generated_column", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_day, (year(ts) * 100 + month(ts))::INTEGER AS event_month FROM events""")
def generated_column(t: Tables):
    return t.events.select("event_id", day("ts").alias("event_day"), (F.year("ts") * 100 + F.month("ts")).alias("event_month"))


@query("constraint_check", sql="""
SELECT 'check:positive' AS name, count(*) FILTER (WHERE NOT l_quantity > 1) AS violations FROM lineitem
UNION ALL SELECT 'not_null:l_tax', count(*) FILTER (WHERE l_tax IS NULL) FROM lineitem
UNION ALL SELECT 'primary_key:l_orderkey,l_linenumber', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'foreign_key:rich_supplier', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def constraint_check(t: Tables):
    return cdc.constraint_report(
        t.lineitem, {"positive": "l_quantity > 1"}, ["l_tax"], ["l_orderkey", "l_linenumber"],
        {"rich_supplier": ("l_suppkey", t.supplier.where("s_acctbal > 0"), "s_suppkey")})
