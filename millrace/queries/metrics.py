"""Metric views over shipped lines and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.metric_view import MetricView
from millrace.queries.registry import Tables, query, rnd

SHIPMENTS = MetricView.from_yaml("""
source: lineitem
filter: l_quantity >= 2
joins:
  - name: maker
    source: supplier
    on: source.l_suppkey = maker.s_suppkey
  - name: land
    source: nation
    on: maker.s_nationkey = land.n_nationkey
  - name: item
    source: part
    on: source.l_partkey = item.p_partkey
dimensions:
  - {name: Land, expr: land.n_name}
  - {name: Brand, expr: item.p_brand}
  - {name: Return code, expr: l_returnflag}
  - {name: Lot, expr: "CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'middle' ELSE 'bulk' END"}
  - {name: Quarter, expr: "CAST(date_trunc('quarter', l_shipdate) AS timestamp_ntz)"}
measures:
  - {name: Lines, expr: count(*)}
  - {name: Net value, expr: sum(l_extendedprice * (1 - l_discount))}
  - {name: Pieces, expr: sum(l_quantity)}
  - {name: Parts, expr: count(DISTINCT l_partkey)}
  - {name: Pieces per part, expr: sum(l_quantity) / count(DISTINCT l_partkey)}
  - {name: Net per piece, expr: "MEASURE(`Net value`) / MEASURE(Pieces)"}
  - {name: Sent back, expr: "sum(l_quantity) FILTER (WHERE `Return code` = 'R')"}
  - {name: Sent back share, expr: "MEASURE(`Sent back`) / MEASURE(Pieces)"}
  - name: Pieces two quarters before
    expr: sum(l_quantity)
    window: [{order: Quarter, range: trailing 6 month, semiadditive: last}]
  - name: Pieces now
    expr: sum(l_quantity)
    window: [{order: Quarter, range: current, semiadditive: last}]
  - {name: Against half-year mean, expr: "MEASURE(`Pieces now`) - MEASURE(`Pieces two quarters before`) / 2"}
  - name: Parts in half a year
    expr: count(DISTINCT l_partkey)
    window: [{order: Quarter, range: trailing 6 month, semiadditive: last}]
""")


def ask(t: Tables, dims, measures, where=None):
    return SHIPMENTS.query(lambda name: getattr(t, name), dims, measures, where)


LOT = "CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'middle' ELSE 'bulk' END"


@query("metric_basic", sql=f"""
SELECT {LOT} AS lot, count(*) AS lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net FROM lineitem WHERE l_quantity >= 2 GROUP BY 1""")
def metric_basic(t: Tables):
    return ask(t, ["Lot"], ["Lines", "Net value"]).select(F.col("Lot").alias("lot"), F.col("Lines").alias("lines"), rnd("Net value", 2).alias("net"))


@query("metric_join", sql="""
SELECT n_name AS land, p_brand AS brand, count(DISTINCT l_partkey) AS parts, round(sum(l_quantity) / count(DISTINCT l_partkey), 6) AS per_part
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 2 GROUP BY 1, 2""")
def metric_join(t: Tables):
    return ask(t, ["Land", "Brand"], ["Parts", "Pieces per part"]).select(
        F.col("Land").alias("land"), F.col("Brand").alias("brand"), F.col("Parts").alias("parts"), rnd("Pieces per part", 6).alias("per_part"))


@query("metric_composed", sql="""
SELECT n_name AS land, round(sum(l_extendedprice * (1 - l_discount)) / sum(l_quantity), 4) AS net_per_piece,
 round(sum(l_quantity) FILTER (WHERE l_returnflag = 'R') / sum(l_quantity), 6) AS sent_back_share
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity >= 2 GROUP BY 1""")
def metric_composed(t: Tables):
    return ask(t, ["Land"], ["Net per piece", "Sent back share"]).select(
        F.col("Land").alias("land"), rnd("Net per piece").alias("net_per_piece"), rnd("Sent back share", 6).alias("sent_back_share"))


@query("metric_filtered", sql=f"""
SELECT {LOT} AS lot, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS sent_back FROM lineitem WHERE l_quantity >= 2 GROUP BY 1""")
def metric_filtered(t: Tables):
    return ask(t, ["Lot"], ["Sent back"]).select(F.col("Lot").alias("lot"), F.col("Sent back").alias("sent_back"))


@query("metric_trailing", sql="""
WITH q AS (SELECT l_returnflag AS code, date_trunc('quarter', l_shipdate)::TIMESTAMP AS quarter, sum(l_quantity) AS v FROM lineitem WHERE l_quantity >= 2 GROUP BY 1, 2),
 h AS (SELECT a.code, a.quarter, any_value(a.v) AS now, sum(b.v) AS half FROM q a LEFT JOIN q b ON a.code = b.code AND b.quarter >= a.quarter - INTERVAL 6 MONTH AND b.quarter < a.quarter GROUP BY 1, 2)
SELECT code, quarter, now, half, round(now - half / 2, 4) AS against_mean FROM h""")
def metric_trailing(t: Tables):
    return ask(t, ["Return code", "Quarter"], ["Pieces now", "Pieces two quarters before", "Against half-year mean"]).select(
        F.col("Return code").alias("code"), F.col("Quarter").alias("quarter"), F.col("Pieces now").alias("now"),
        F.col("Pieces two quarters before").alias("half"), rnd("Against half-year mean").alias("against_mean"))


@query("metric_distinct_trailing", sql="""
WITH l AS (SELECT l_partkey, date_trunc('quarter', l_shipdate)::TIMESTAMP AS quarter FROM lineitem WHERE l_quantity >= 2), a AS (SELECT DISTINCT quarter FROM l)
SELECT a.quarter, CASE WHEN count(l_partkey) > 0 THEN count(DISTINCT l_partkey) END AS parts
FROM a LEFT JOIN l ON l.quarter >= a.quarter - INTERVAL 6 MONTH AND l.quarter < a.quarter GROUP BY 1""")
def metric_distinct_trailing(t: Tables):
    return ask(t, ["Quarter"], ["Parts in half a year"]).select(F.col("Quarter").alias("quarter"), F.col("Parts in half a year").alias("parts"))


@query("metric_query", sql=f"""
SELECT date_trunc('quarter', l_shipdate)::TIMESTAMP AS quarter, n_name AS land, count(*) AS lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_quantity >= 2 AND {LOT} = 'bulk' AND n_name IN ('NATION_3', 'NATION_7', 'NATION_12') GROUP BY ALL ORDER BY 1, 2""")
def metric_query(t: Tables):
    rows = ask(t, ["Quarter", "Land"], ["Lines", "Net value"], "`Lot` = 'bulk' AND `Land` IN ('NATION_3', 'NATION_7', 'NATION_12')")
    return rows.select(F.col("Quarter").alias("quarter"), F.col("Land").alias("land"), F.col("Lines").alias("lines"),
                       rnd("Net value", 2).alias("net")).orderBy("quarter", "land")


CAMPAIGN = MetricView.from_yaml("""
source: events
dimensions:
  - {name: Day, expr: "date_format(ts, 'yyyy-MM-dd')"}
measures:
  - {name: Impressions, expr: "count_if(event_type = 'view')"}
  - {name: Clicks, expr: "count_if(event_type = 'click')"}
  - {name: Purchases, expr: "count_if(event_type = 'purchase')"}
  - {name: Revenue, expr: "sum(value) FILTER (WHERE event_type = 'purchase')"}
  - {name: Cost, expr: "sum(value) FILTER (WHERE event_type = 'view')"}
  - {name: CTR, expr: "try_divide(MEASURE(Clicks), MEASURE(Impressions))"}
  - {name: Conversion, expr: "try_divide(MEASURE(Purchases), MEASURE(Clicks))"}
  - {name: ROAS, expr: "try_divide(MEASURE(Revenue), MEASURE(Cost))"}
""")


@query("metric_kpis", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS d, round(count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'view'), 6) AS ctr,
 round(count(*) FILTER (WHERE event_type = 'purchase') / count(*) FILTER (WHERE event_type = 'click'), 6) AS conversion,
 round(sum(value) FILTER (WHERE event_type = 'purchase') / sum(value) FILTER (WHERE event_type = 'view'), 6) AS roas FROM events GROUP BY 1""")
def metric_kpis(t: Tables):
    rows = CAMPAIGN.query(lambda name: getattr(t, name), ["Day"], ["CTR", "Conversion", "ROAS"])
    return rows.select(F.col("Day").alias("d"), rnd("CTR", 6).alias("ctr"), rnd("Conversion", 6).alias("conversion"), rnd("ROAS", 6).alias("roas"))
