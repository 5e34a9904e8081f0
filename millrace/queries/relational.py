"""Projection, predicates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.joins import asof_join, close_intervals, interval_join, overlap_join
from millrace.operators.rules import add_rule_columns
from millrace.operators.windows import window_totals
from millrace.queries.registry import Tables, day, ntz, query, rnd

# ---------------------------------------------------------------- projection and filter


@query("star_except", sql="SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def star_except(t: Tables):
    return t.customer.drop("c_acctbal", "c_name")


@query("clean_cast", sql="""
SELECT c_custkey AS id, lower(c_name) AS name, sha1(c_name) AS name_hash,
       CAST(trunc(c_acctbal) AS INTEGER) AS balance_units,
       TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS name_no,
       TRY_CAST(c_mktsegment AS INTEGER) AS segment_no
FROM customer""")
def clean_cast(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.lower("c_name").alias("name"), F.sha1("c_name").alias("name_hash"),
        F.col("c_acctbal").cast("int").alias("balance_units"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).try_cast("int").alias("name_no"),
        F.col("c_mktsegment").try_cast("int").alias("segment_no"),
    )


@query("flatten_struct", sql="""
SELECT o_orderkey, o_custkey AS customer_key, o_orderstatus AS state_code, o_orderpriority AS state_priority,
       o_totalprice AS state_total FROM orders""")
def flatten_struct(t: Tables):
    from millrace.functions.columns import flatten

    nested = t.orders.select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("key")).alias("customer"),
        F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("priority"),
                 F.col("o_totalprice").alias("total")).alias("state"),
    )
    return flatten(nested)


@query("case_map", sql="""
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Processing' WHEN 'F' THEN 'Fulfilled' END AS status,
       CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END AS size_band
FROM orders""")
def case_map(t: Tables):
    status = F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "P", "Processing")
    status = status.when(F.col("o_orderstatus") == "F", "Fulfilled")
    band = F.when(F.col("o_totalprice") >= 300000, "large").when(F.col("o_totalprice") >= 100000, "medium").otherwise("small")
    return t.orders.select("o_orderkey", status.alias("status"), band.alias("size_band"))


@query("predicates", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderpriority LIKE '%URGENT%' AND o_orderstatus IN ('O','P') AND o_totalprice BETWEEN 50000 AND 400000
  AND o_orderdate IS NOT NULL AND NOT (o_custkey IS NULL)""")
def predicates(t: Tables):
    c = F.col
    return t.orders.where(
        c("o_orderpriority").like("%URGENT%") & c("o_orderstatus").isin("O", "P")
        & c("o_totalprice").between(50000, 400000) & c("o_orderdate").isNotNull() & c("o_custkey").isNotNull()
    ).select("o_orderkey", "o_custkey")


@query("in_subquery", sql="""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN
 (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 2500000)""")
def in_subquery(t: Tables):
    big = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s")).where("s > 2500000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("scalar_subquery", sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders)""")
def scalar_subquery(t: Tables):
    mean = t.orders.select(F.avg("o_totalprice")).scalar()
    return t.orders.where(F.col("o_totalprice") > 1.5 * mean).select("o_orderkey", "o_totalprice")


@query("exists_semi", sql="""
SELECT c_custkey FROM customer c WHERE EXISTS
 (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT' AND o.o_totalprice > 400000)""")
def exists_semi(t: Tables):
    hot = t.orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 400000")
    return t.customer.join(hot, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("not_exists_anti", sql="""
SELECT c_custkey FROM customer c WHERE NOT EXISTS
 (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1999)""")
def not_exists_anti(t: Tables):
    y99 = t.orders.where("o_orderdate >= '1999-01-01' AND o_orderdate < '2000-01-01'")
    return t.customer.join(y99, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("param_query", sql="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_orderstatus""")
def param_query(t: Tables):
    spark = t.views("orders")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n, round(sum(IDENTIFIER(:measure)), 2) AS total FROM IDENTIFIER(:source) "
        "WHERE o_orderdate >= to_timestamp_ntz(:start_date) AND o_orderdate < to_timestamp_ntz(:end_date) GROUP BY o_orderstatus",
        args={"measure": "o_totalprice", "source": "orders", "start_date": "1997-01-01", "end_date": "1999-01-01"},
    )


@query("derived_flag", sql="""
SELECT c_custkey, CASE WHEN last_order < TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END AS churned, coalesce(urgent, 0)::BIGINT AS urgent_orders
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order, count(*) FILTER (WHERE o_orderpriority='1-URGENT') AS urgent
 FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE c_acctbal >= 0""")
def derived_flag(t: Tables):
    seen = t.orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_order"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return (
        t.customer.where("c_acctbal >= 0").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", F.when(F.col("last_order") < "2001-01-01", 1).otherwise(0).alias("churned"),
                F.coalesce("urgent", F.lit(0)).cast("long").alias("urgent_orders"))
    )


@query("rule_engine", sql="""
WITH a AS (SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'HIGH' ELSE 'OK' END AS amount_check,
  CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'LIVE' END AS state_check FROM orders)
SELECT *, CASE WHEN amount_check = 'HIGH' AND state_check = 'LIVE' THEN 'REVIEW' ELSE 'PASS' END AS verdict FROM a""")
def rule_engine(t: Tables):
    rules = t.spark.createDataFrame(
        [(1, "amount_check", "CASE WHEN o_totalprice > 300000 THEN 'HIGH' ELSE 'OK' END", True),
         (2, "state_check", "CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'LIVE' END", True),
         (3, "unused_check", "1 / 0", False),
         (4, "verdict", "CASE WHEN amount_check = 'HIGH' AND state_check = 'LIVE' THEN 'REVIEW' ELSE 'PASS' END", True)],
        "rule_id long, adds string, formula string, in_use boolean")
    return add_rule_columns(t.orders, rules).select("o_orderkey", "amount_check", "state_check", "verdict")


# ---------------------------------------------------------------- joins


@query("join_inner", sql="""
SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def join_inner(t: Tables):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment")
        .agg(F.count("*").alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))
    )


@query("join_role_playing", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, sn.n_name AS from_nation, cn.n_name AS to_nation
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey""")
def join_role_playing(t: Tables):
    sn = t.nation.select(F.col("n_nationkey").alias("sk"), F.col("n_name").alias("from_nation"))
    cn = t.nation.select(F.col("n_nationkey").alias("ck"), F.col("n_name").alias("to_nation"))
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(sn, F.col("s_nationkey") == F.col("sk"), "left").join(cn, F.col("c_nationkey") == F.col("ck"), "left")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "from_nation", "to_nation")
    )


@query("join_full_outer", sql="""
WITH a AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS ordered FROM orders GROUP BY 1),
 b AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS d, count(*) AS shipped FROM lineitem GROUP BY 1)
SELECT coalesce(a.d, b.d) AS d, coalesce(ordered, 0) AS ordered, coalesce(shipped, 0) AS shipped FROM a FULL JOIN b ON a.d = b.d""")
def join_full_outer(t: Tables):
    a = t.orders.groupBy(day("o_orderdate").alias("d")).agg(F.count("*").alias("ordered"))
    b = t.lineitem.groupBy(day("l_shipdate").alias("d")).agg(F.count("*").alias("shipped"))
    return a.join(b, "d", "full").select(
        "d", F.coalesce("ordered", F.lit(0)).alias("ordered"), F.coalesce("shipped", F.lit(0)).alias("shipped"))


@query("join_cross", sql="""
WITH months AS (SELECT unnest(generate_series(1, 12))::INTEGER AS month_no),
 o AS (SELECT o_custkey, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT c_custkey, month_no, coalesce(n, 0)::BIGINT AS orders FROM customer CROSS JOIN months
LEFT JOIN o ON o_custkey = c_custkey AND m = month_no""")
def join_cross(t: Tables):
    # calendar x cohort: the calendar is a fixed sequence, so each row is exploded in place
    grid = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month_no"))
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.month("o_orderdate").alias("month_no")).agg(
        F.count("*").alias("n"))
    return grid.join(counts, ["c_custkey", "month_no"], "left").select(
        "c_custkey", "month_no", F.coalesce("n", F.lit(0)).alias("orders"))


@query("join_const_full", sql="""
SELECT a.*, b.* FROM (SELECT count(*) AS n_orders, round(avg(o_totalprice), 2) AS avg_total FROM orders HAVING count(*) > 0) a
FULL JOIN (SELECT count(*) AS n_lines, round(avg(l_quantity), 4) AS avg_qty FROM lineitem HAVING max(l_quantity) > 1000) b ON true""")
def join_const_full(t: Tables):
    # both sides are ungrouped aggregates: one row at most
    a = t.orders.agg(F.count("*").alias("n_orders"), rnd(F.avg("o_totalprice"), 2).alias("avg_total")).where("n_orders > 0")
    b = t.lineitem.agg(F.count("*").alias("n_lines"), rnd(F.avg("l_quantity")).alias("avg_qty"), F.max("l_quantity").alias("m"))
    b = b.where("m > 1000").drop("m")
    return a.withColumn("one", F.lit(1)).join(b.withColumn("one", F.lit(1)), "one", "full").drop("one")


PRICES = """
prices AS (SELECT o_custkey AS pk, d AS price_start, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS price_end, price
 FROM (SELECT o_custkey, o_orderdate AS d, max(o_totalprice) AS price FROM orders GROUP BY 1, 2))"""


def price_list(t: Tables):
    """Price in force per customer: from each order date until the next."""
    steps = t.orders.groupBy(F.col("o_custkey").alias("pk"), F.col("o_orderdate").alias("price_start")).agg(
        F.max("o_totalprice").alias("price"))
    return close_intervals(steps, ["pk"], "price_start", "price_end")


@query("join_interval", sql=f"""
WITH {PRICES}, f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, o_custkey AS pk
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, f.l_shipdate, f.l_quantity, f.pk, price FROM f JOIN prices p
 ON f.pk = p.pk AND f.l_shipdate >= price_start AND (price_end IS NULL OR f.l_shipdate < price_end)""")
def join_interval(t: Tables):
    facts = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", F.col("o_custkey").alias("pk"))
    # a customer's prices follow each other without overlap, so the last start at or before the date decides
    joined = asof_join(facts, price_list(t), ["pk"], "l_shipdate", "price_start", ["price", "price_end"])
    inside = F.col("matched_price_start").isNotNull() & (F.col("price_end").isNull() | (F.col("l_shipdate") < F.col("price_end")))
    return joined.where(inside).drop("matched_price_start", "price_end")


@query("join_theta_bucketed", sql="""
WITH w AS (SELECT event_id AS win_id, ts AS w_start, ts + to_seconds((value * 2)::BIGINT) AS w_end FROM events WHERE event_type = 'error'),
 p AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase')
SELECT win_id, count(*) AS purchases, min(event_id) AS first_event, round(sum(value), 4) AS revenue, count(DISTINCT user_id) AS buyers
 FROM w JOIN p ON p.ts BETWEEN w_start AND w_end GROUP BY win_id""")
def join_theta_bucketed(t: Tables):
    spans = t.events.where("event_type = 'error'").select(
        F.col("event_id").alias("win_id"), F.col("ts").alias("w_start"),
        (F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 2).cast("decimal(18,6)"))).alias("w_end"))
    points = t.events.where("event_type = 'purchase'").select("event_id", "ts", "user_id", "value")
    made = window_totals(spans, "win_id", ("w_start", "w_end"), points, "ts", "value", "user_id", "event_id")
    return made.select("win_id", F.col("n").alias("purchases"), F.col("least").alias("first_event"), rnd("total").alias("revenue"), F.col("items").alias("buyers"))


@query("join_asof", sql="""
WITH r AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS in_force FROM orders GROUP BY 1, 2),
 f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT f.*, r.o_orderdate AS matched_o_orderdate, r.in_force FROM f ASOF LEFT JOIN r ON f.o_custkey = r.o_custkey AND f.l_shipdate >= r.o_orderdate""")
def join_asof(t: Tables):
    facts = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "o_custkey")
    rates = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("in_force"))
    return asof_join(facts, rates, ["o_custkey"], "l_shipdate", "o_orderdate", ["in_force"])


@query("pit_lookup", sql="""
WITH lab AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
 feat AS (SELECT user_id, ts AS f_ts, value AS last_click_value FROM events WHERE event_type = 'click')
SELECT lab.event_id, lab.user_id, lab.ts, f_ts AS matched_f_ts, last_click_value FROM lab ASOF LEFT JOIN feat
 ON lab.user_id = feat.user_id AND lab.ts >= f_ts""")
def pit_lookup(t: Tables):
    labels = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    features = t.events.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("f_ts"), F.col("event_id").alias("f_id"), F.col("value").alias("last_click_value"))
    return asof_join(labels, features, ["user_id"], "ts", "f_ts", ["last_click_value"], tiebreak=["f_id"])


@query("join_self", sql="""
SELECT min(a.o_orderkey) AS first_order, a.o_custkey, a.o_orderdate, max(b.o_totalprice) AS best_total
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate
WHERE a.o_orderstatus IN ('O', 'P') GROUP BY a.o_custkey, a.o_orderdate""")
def join_self(t: Tables):
    # the self join matches a row with all rows of its key; both aggregates of the pairs
    # are aggregates of the group, so no pair is formed
    return (
        t.orders.groupBy("o_custkey", "o_orderdate")
        .agg(F.min(F.when(F.col("o_orderstatus").isin("O", "P"), F.col("o_orderkey"))).alias("first_order"),
             F.max("o_totalprice").alias("best_total"))
        .where("first_order IS NOT NULL").select("first_order", "o_custkey", "o_orderdate", "best_total")
    )


@query("join_overlap_priority", sql="""
WITH stay AS (SELECT event_id AS stay_id, user_id AS su, event_type AS stay_type, ts AS s_start, ts + INTERVAL 12 HOUR AS s_end
  FROM events WHERE event_type IN ('signup', 'view')),
 visit AS (SELECT event_id, user_id, event_type, ts FROM events WHERE event_type IN ('click', 'purchase')),
 j AS (SELECT v.*, stay_id, s_start, CASE WHEN stay_type = 'signup' THEN 1 WHEN event_type = 'click' THEN 2 ELSE 3 END AS pr
  FROM visit v JOIN stay ON user_id = su AND ts BETWEEN s_start AND s_end)
SELECT event_id, user_id, stay_id, pr AS priority FROM j
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY pr, s_start, stay_id) = 1""")
def join_overlap_priority(t: Tables):
    stays = t.events.where("event_type IN ('signup', 'view')").select(
        F.col("event_id").alias("stay_id"), "user_id", F.col("event_type").alias("stay_type"), F.col("ts").alias("s_start"),
        (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("s_end"))
    visits = t.events.where("event_type IN ('click', 'purchase')").select(
        "event_id", "user_id", "event_type", F.col("ts").alias("v_from"), F.col("ts").alias("v_to"))
    pairs = overlap_join(visits, stays, ("v_from", "v_to"), ("s_start", "s_end"), 12 * 3600, ["user_id"])
    priority = F.when(F.col("stay_type") == "signup", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    # best candidate per visit as a combinable aggregate
    return (
        pairs.groupBy("event_id", "user_id")
        .agg(F.min(F.struct(priority.alias("pr"), "s_start", "stay_id")).alias("best"))
        .select("event_id", "user_id", "best.stay_id", F.col("best.pr").alias("priority"))
    )


@query("join_semi", sql="""
SELECT p_partkey, p_brand FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49 AND l_discount = 0)""")
def join_semi(t: Tables):
    lines = t.lineitem.where("l_quantity >= 49 AND l_discount = 0")
    return t.part.join(lines, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@query("join_anti", sql="""
SELECT p_partkey, p_brand FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49 AND l_discount = 0)""")
def join_anti(t: Tables):
    lines = t.lineitem.where("l_quantity >= 49 AND l_discount = 0")
    return t.part.join(lines, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_brand")


@query("join_star", sql="""
SELECT r_name, p_type, year(o_orderdate)::INTEGER AS y, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE s_acctbal > 0 GROUP BY 1, 2, 3""")
def join_star(t: Tables):
    c = F.col
    return (
        t.lineitem.join(t.supplier.where("s_acctbal > 0"), c("l_suppkey") == c("s_suppkey"))
        .join(t.part, c("l_partkey") == c("p_partkey")).join(t.orders, c("l_orderkey") == c("o_orderkey"))
        .join(t.customer, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey"))
        .join(t.region, c("n_regionkey") == c("r_regionkey"))
        .groupBy("r_name", "p_type", F.year("o_orderdate").alias("y"))
        .agg(F.count("*").alias("n"), rnd(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 2).alias("revenue"))
    )


@query("join_vocab_map", sql="""
SELECT p.p_partkey AS source_id, p.p_name AS source_name, ps.l_suppkey AS target_id, s.s_name AS target_name
FROM part p JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE lower(l_returnflag) = 'r' AND l_tax = 0) ps ON p_partkey = l_partkey
JOIN supplier s ON l_suppkey = s_suppkey AND s_acctbal >= 0""")
def join_vocab_map(t: Tables):
    links = t.lineitem.where((F.lower("l_returnflag") == "r") & (F.col("l_tax") == 0)).select("l_partkey", "l_suppkey").distinct()
    return (
        t.part.join(links, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier.where("s_acctbal >= 0"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("p_partkey").alias("source_id"), F.col("p_name").alias("source_name"),
                F.col("l_suppkey").alias("target_id"), F.col("s_name").alias("target_name"))
    )


BOM = """
bom AS (SELECT p_partkey AS parent, p_partkey // 2 AS child, (p_size % 5 + 1)::BIGINT AS qty FROM part WHERE p_partkey > 0),
 demand AS (SELECT l_partkey AS part, sum(l_quantity)::BIGINT AS need FROM lineitem GROUP BY 1)"""


def bill_of_materials(t: Tables):
    """Each part above zero is built into half its number: a tree of logarithmic depth."""
    return t.part.where("p_partkey > 0").select(
        F.col("p_partkey").alias("parent"), F.floor(F.col("p_partkey") / 2).alias("child"),
        (F.col("p_size") % 5 + 1).cast("long").alias("qty"))


def part_demand(t: Tables):
    return t.lineitem.groupBy(F.col("l_partkey").alias("part")).agg(F.sum("l_quantity").cast("long").alias("need"))


@query("bom_rollup", sql=f"""
WITH RECURSIVE {BOM}, walk AS (
 SELECT part, need, 0 AS depth FROM demand
 UNION ALL SELECT part, need, depth FROM (SELECT child AS part, sum(need * qty)::BIGINT AS need, depth + 1 AS depth
   FROM walk JOIN bom ON part = parent GROUP BY child, depth))
SELECT part, sum(need)::BIGINT AS total_need, max(depth)::INTEGER AS deepest FROM walk GROUP BY part""")
def bom_rollup(t: Tables):
    from millrace.operators.aggregates import rollup_components

    return rollup_components(part_demand(t), bill_of_materials(t))
