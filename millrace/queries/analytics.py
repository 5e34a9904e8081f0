"""Forecast and domain reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import analytics as an
from millrace.operators.aggregates import rollup_components
from millrace.operators.joins import close_intervals, interval_join
from millrace.queries.registry import Tables, day, ntz, query, rnd
from millrace.queries.relational import BOM, bill_of_materials, part_demand

FIT = """daily AS (SELECT event_type, CAST(ts AS DATE) AS d, sum(value) AS y, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS x, dayofweek(ts) AS dow FROM events GROUP BY ALL),
 fit AS (SELECT event_type, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS history, max(d) AS last FROM daily GROUP BY 1),
 r AS (SELECT daily.*, y - a - b * x AS r FROM daily JOIN fit USING (event_type)), s AS (SELECT event_type, dow, avg(r) AS s FROM r GROUP BY 1, 2),
 n AS (SELECT event_type, stddev_pop(r - s) AS sd FROM r JOIN s USING (event_type, dow) GROUP BY 1),
 f AS (SELECT fit.event_type, CAST(last + k AS DATE) AS d, a, b, history FROM fit, (SELECT unnest(generate_series(1, 14))::INTEGER AS k)),
 p AS (SELECT f.event_type, f.d, a + b * date_diff('day', DATE '1970-01-01', f.d) + coalesce(s, 0) AS yhat, 1.2815515655446004 * sd AS band, history
  FROM f JOIN n USING (event_type) LEFT JOIN s ON s.event_type = f.event_type AND s.dow = dayofweek(f.d))"""


def daily_values(t: Tables):
    return t.events.groupBy("event_type", F.to_date("ts").alias("d")).agg(F.sum("value").alias("y"))


@query("forecast_trend", sql=f"""
WITH {FIT} SELECT event_type, strftime(d, '%Y-%m-%d') AS d, round(greatest(0, yhat), 4) AS yhat, round(greatest(0, yhat - band), 4) AS lower, round(greatest(0, yhat + band), 4) AS upper, history FROM p""")
def forecast_trend(t: Tables):
    out = an.trend_forecast(daily_values(t), ["event_type"], "d", "y", 14)
    return out.select("event_type", day("d").alias("d"), rnd("yhat").alias("yhat"), rnd("lower").alias("lower"), rnd("upper").alias("upper"), "history")


@query("forecast_stitch", sql=f"""
WITH {FIT}, u AS (SELECT event_type, d, greatest(0, y) AS v, 0 AS is_prediction FROM daily UNION ALL SELECT event_type, d, greatest(0, yhat), 1 FROM p)
SELECT event_type, strftime(d, '%Y-%m-%d') AS d, round(v, 4) AS value, is_prediction, round(avg(v) OVER (PARTITION BY event_type ORDER BY d ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING), 4) AS smoothed FROM u""")
def forecast_stitch(t: Tables):
    daily = daily_values(t)
    out = an.stitch(daily, an.trend_forecast(daily, ["event_type"], "d", "y", 14), ["event_type"], "d", "y")
    return out.select("event_type", day("d").alias("d"), rnd("value").alias("value"), "is_prediction", rnd("smoothed").alias("smoothed"))


RET = """px AS (SELECT p_brand AS ticker, date_trunc('month', l_shipdate)::TIMESTAMP AS month, avg(l_extendedprice / l_quantity) AS price FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
 ret AS (SELECT *, price / lag(price) OVER (PARTITION BY ticker ORDER BY month) - 1 AS ret FROM px)"""
HOLD = """h AS (SELECT c_mktsegment AS portfolio, p_brand AS ticker, make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) AS eff, sum(l_quantity) AS shares
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
 w AS (SELECT portfolio, ticker, eff, shares / sum(shares) OVER (PARTITION BY portfolio, eff) AS weight, lead(eff) OVER (PARTITION BY portfolio, ticker ORDER BY eff) AS eff_end FROM h)"""


def returns(t: Tables):
    prices = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_brand").alias("ticker"), ntz(F.date_trunc("month", "l_shipdate")).alias("month")).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return an.period_returns(prices, "ticker", "month", "price")


def weights(t: Tables):
    held = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("portfolio"), F.col("p_brand").alias("ticker"), ntz(F.date_trunc("year", "o_orderdate")).alias("eff"))
        .agg(F.sum("l_quantity").alias("shares")))
    # one row per portfolio, ticker and year by now
    share = F.col("shares") / F.sum("shares").over(Window.partitionBy("portfolio", "eff"))
    shares = held.select("portfolio", "ticker", "eff", share.alias("weight"))
    return close_intervals(shares, ["portfolio", "ticker"], "eff", "eff_end")


@query("portfolio_returns", sql=f"""
WITH {RET}, {HOLD}, r AS (SELECT portfolio, month, sum(weight * ret) AS pr FROM ret JOIN w ON ret.ticker = w.ticker AND month >= eff AND (eff_end IS NULL OR month < eff_end) WHERE ret IS NOT NULL GROUP BY 1, 2),
 b AS (SELECT month, avg(ret) AS br FROM ret WHERE ret IS NOT NULL GROUP BY 1)
SELECT portfolio, month, round(pr, 8) AS ret, round(ln(exp(sum(ln(1 + pr)) OVER v)), 7) AS log_growth, round(ln(exp(sum(ln(1 + br)) OVER v)), 7) AS log_benchmark FROM r JOIN b USING (month)
WINDOW v AS (PARTITION BY portfolio ORDER BY month ROWS UNBOUNDED PRECEDING)""")
def portfolio_returns(t: Tables):
    r = returns(t).where("ret IS NOT NULL").select("ticker", "month", "ret")
    held = interval_join(r, weights(t), ["ticker"], "month", "eff", "eff_end", 366 * 86400)
    port = held.groupBy("portfolio", "month").agg(F.sum(F.col("weight") * F.col("ret")).alias("pr"))
    bench = r.groupBy("month").agg(F.avg("ret").alias("br"))
    both = port.join(bench, "month")
    out = an.compound(an.compound(both, ["portfolio"], "month", "pr", "cumulative"), ["portfolio"], "month", "br", "benchmark")
    # growth is reported as its logarithm: compounded over years it outgrows fixed decimals
    return out.select("portfolio", "month", rnd("pr", 8).alias("ret"), rnd(F.log1p("cumulative"), 7).alias("log_growth"), rnd(F.log1p("benchmark"), 7).alias("log_benchmark"))


@query("risk_metrics", sql=f"""
WITH {RET}, g AS (SELECT *, CASE WHEN month < TIMESTAMP '1998-01-01' THEN 'early' ELSE 'late' END AS regime FROM ret WHERE ret IS NOT NULL)
SELECT ticker, regime, count(*) AS n, round(avg(ret) * 12, 8) AS annual_return, round(stddev_samp(ret) * sqrt(12), 8) AS annual_vol,
 round(avg(ret) * 12 / (stddev_samp(ret) * sqrt(12)), 6) AS sharpe, round(quantile_cont(ret, 0.05), 8) AS value_at_risk FROM g GROUP BY 1, 2""")
def risk_metrics(t: Tables):
    regime = F.when(F.col("month") < "1998-01-01", "early").otherwise("late")
    out = an.risk(returns(t).withColumn("regime", regime), ["ticker", "regime"], "ret", 12)
    return out.select("ticker", "regime", "n", rnd("annual_return", 8).alias("annual_return"), rnd("annual_vol", 8).alias("annual_vol"),
                      rnd("sharpe", 6).alias("sharpe"), rnd("value_at_risk", 8).alias("value_at_risk"))


@query("concentration", sql="""
WITH s AS (SELECT year(l_shipdate)::INTEGER AS y, p_type, sum(l_extendedprice) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
 a AS (SELECT y, p_type, v / sum(v) OVER (PARTITION BY y) AS share FROM s), b AS (SELECT p_type, count(*) / sum(count(*)) OVER () AS base FROM part GROUP BY 1)
SELECT y, coalesce(a.p_type, b.p_type) AS p_type, round(coalesce(share, 0), 8) AS share, round(coalesce(base, 0), 8) AS base, round(coalesce(share, 0) - coalesce(base, 0), 8) AS overweight FROM a FULL JOIN b ON a.p_type = b.p_type""")
def concentration(t: Tables):
    held = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.year("l_shipdate").alias("y"), "p_type").agg(F.sum("l_extendedprice").alias("v"))
    share = held.withColumn("share", F.col("v") / F.sum("v").over(Window.partitionBy("y")))  # a handful of classes per year
    counts = t.part.groupBy("p_type").agg(F.count("*").alias("n"))
    base = counts.select("p_type", (F.col("n") / counts.select(F.sum("n")).scalar()).alias("base"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return share.join(base, "p_type", "full").select("y", "p_type", rnd(z("share"), 8).alias("share"), rnd(z("base"), 8).alias("base"), rnd(z("share") - z("base"), 8).alias("overweight"))


LIFE = """life AS (SELECT o_custkey, date_diff('month', date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)))::INTEGER AS months FROM orders GROUP BY 1),
 c AS (SELECT c_mktsegment AS arm, c_nationkey, months FROM life JOIN customer ON o_custkey = c_custkey)"""


def lifetimes(t: Tables):
    month = lambda c: F.year(c) * 12 + F.month(c)
    life = t.orders.groupBy("o_custkey").agg((month(F.max("o_orderdate")) - month(F.min("o_orderdate"))).alias("months"))
    return life.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("arm"), "c_nationkey", "months")


@query("survival_curve", sql=f"""
WITH {LIFE} SELECT arm, m::INTEGER AS month, count(*) FILTER (WHERE least(months, 80) >= m) AS alive, round(count(*) FILTER (WHERE least(months, 80) >= m) / count(*), 8) AS survival
FROM c, (SELECT unnest(generate_series(0, 80)) AS m) GROUP BY 1, 2""")
def survival_curve(t: Tables):
    return an.survival(lifetimes(t), "arm", "months", 80).withColumn("survival", rnd("survival", 8))


@query("lift_by_group", sql=f"""
WITH {LIFE}, o AS (SELECT avg((months >= 60)::INT) AS overall FROM c)
SELECT c_nationkey, count(*) AS n, round(avg((months >= 60)::INT), 6) AS rate, round(avg((months >= 60)::INT) - max(overall), 6) AS lift FROM c, o GROUP BY 1 HAVING count(*) >= 55""")
def lift_by_group(t: Tables):
    rows = lifetimes(t).withColumn("ok", (F.col("months") >= 60).cast("int"))
    overall = rows.select(F.avg("ok")).scalar()
    return rows.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.avg("ok").alias("r")).where("n >= 55").select(
        "c_nationkey", "n", rnd("r", 6).alias("rate"), rnd(F.col("r") - overall, 6).alias("lift"))


@query("weeks_of_cover", sql=f"""
WITH RECURSIVE {BOM}, walk AS (SELECT part, need, 0 AS depth FROM demand
 UNION ALL SELECT part, need, depth FROM (SELECT child AS part, sum(need * qty)::BIGINT AS need, depth + 1 AS depth FROM walk JOIN bom ON part = parent GROUP BY child, depth)),
 n AS (SELECT part, sum(need)::BIGINT AS need FROM walk GROUP BY 1)
SELECT p_partkey, need, (p_size * 100)::BIGINT AS on_hand, round(p_size * 100 / nullif(need / 52.0, 0), 4) AS weeks,
 CASE WHEN p_size * 100 / nullif(need / 52.0, 0) < 10 THEN 'critical' WHEN p_size * 100 / nullif(need / 52.0, 0) < 40 THEN 'low' ELSE 'fine' END AS status FROM part JOIN n ON p_partkey = part""")
def weeks_of_cover(t: Tables):
    need = rollup_components(part_demand(t), bill_of_materials(t)).select("part", F.col("total_need").alias("need"))
    stock = t.part.select("p_partkey", (F.col("p_size") * 100).cast("long").alias("on_hand"))
    weeks = F.try_divide(F.col("on_hand"), F.col("need") / 52.0)
    return stock.join(need, F.col("p_partkey") == F.col("part")).select(
        "p_partkey", "need", "on_hand", rnd(weeks).alias("weeks"), F.when(weeks < 10, "critical").when(weeks < 40, "low").otherwise("fine").alias("status"))


@query("loss_ratio", sql="""
WITH r AS (SELECT c_mktsegment AS line, o_orderdate AS d, o_totalprice * 0.1 AS premium, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 0.05 ELSE 0 END AS claim FROM orders JOIN customer ON o_custkey = c_custkey),
 w AS (SELECT line, sum(premium) FILTER (WHERE d >= TIMESTAMP '2000-01-01' AND d < TIMESTAMP '2001-01-01') AS p1, sum(claim) FILTER (WHERE d >= TIMESTAMP '2000-01-01' AND d < TIMESTAMP '2001-01-01') AS c1,
  count(DISTINCT CASE WHEN d >= TIMESTAMP '2000-01-01' AND d < TIMESTAMP '2001-01-01' THEN month(d) END) AS m1, sum(premium) FILTER (WHERE d >= TIMESTAMP '1999-01-01' AND d < TIMESTAMP '2000-01-01') AS p0,
  sum(claim) FILTER (WHERE d >= TIMESTAMP '1999-01-01' AND d < TIMESTAMP '2000-01-01') AS c0, count(DISTINCT CASE WHEN d >= TIMESTAMP '1999-01-01' AND d < TIMESTAMP '2000-01-01' THEN month(d) END) AS m0 FROM r GROUP BY 1)
SELECT line, round(c1 / nullif(p1 / 12 * m1, 0), 8) AS current_ratio, round(c0 / nullif(p0 / 12 * m0, 0), 8) AS previous_ratio, round(c1 / nullif(p1 / 12 * m1, 0) - c0 / nullif(p0 / 12 * m0, 0), 8) AS change FROM w""")
def loss_ratio(t: Tables):
    d = F.col("o_orderdate")
    spans = {"1": (d >= "2000-01-01") & (d < "2001-01-01"), "0": (d >= "1999-01-01") & (d < "2000-01-01")}
    rows = t.orders.where((d >= "1999-01-01") & (d < "2001-01-01")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    claim = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 0.05).otherwise(0.0)
    aggs = []
    for k, inside in spans.items():
        aggs += [F.sum(F.when(inside, F.col("o_totalprice") * 0.1)).alias(f"p{k}"), F.sum(F.when(inside, claim)).alias(f"c{k}"),
                 F.count_distinct(F.when(inside, F.month(d))).alias(f"m{k}")]
    ratio = lambda k: F.try_divide(F.col(f"c{k}"), F.col(f"p{k}") / 12 * F.col(f"m{k}"))
    return rows.groupBy(F.col("c_mktsegment").alias("line")).agg(*aggs).select(
        "line", rnd(ratio("1"), 8).alias("current_ratio"), rnd(ratio("0"), 8).alias("previous_ratio"), rnd(ratio("1") - ratio("0"), 8).alias("change"))


KINDS = {"view": "inpatient", "error": "emergency", "purchase": "emergency", "click": "outpatient"}
VISITS = """e AS (SELECT event_id AS id, user_id AS patient, ts AS start, ts + to_microseconds((value * 180000000)::BIGINT) AS stop,
  CASE event_type WHEN 'view' THEN 'inpatient' WHEN 'error' THEN 'emergency' WHEN 'purchase' THEN 'emergency' WHEN 'click' THEN 'outpatient' END AS kind FROM events WHERE event_type <> 'signup'),
 m AS (SELECT *, max(stop) OVER (PARTITION BY patient ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e WHERE kind = 'inpatient'),
 g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach + INTERVAL 1 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY patient ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS grp FROM m),
 v0 AS (SELECT patient, kind, min(start) AS v_start, max(stop) AS v_end FROM g GROUP BY patient, kind, grp UNION ALL SELECT patient, kind, start, max(stop) FROM e WHERE kind <> 'inpatient' GROUP BY 1, 2, 3),
 v AS (SELECT *, row_number() OVER (ORDER BY patient, v_start, kind) AS visit_id FROM v0)"""


def encounters(t: Tables):
    stop = F.col("ts") + F.make_dt_interval(secs=(F.col("value") * 180).cast("decimal(18,6)"))
    return t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("patient"), F.col("event_type").alias("class"), F.col("ts").alias("start"), stop.alias("stop"))


@query("visit_consolidation", sql=f"""
WITH {VISITS}, j AS (SELECT e.id, e.patient, e.kind, visit_id, v_start, CASE WHEN v.kind = 'inpatient' AND (e.kind <> 'emergency' OR start > v_start) THEN 1
  WHEN v.kind = e.kind AND (e.kind = 'inpatient' OR start = v_start) THEN 2 END AS rk FROM e JOIN v ON e.patient = v.patient AND start BETWEEN v_start AND v_end)
SELECT id, patient, kind, visit_id FROM j WHERE rk IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rk, v_start, visit_id) = 1""")
def visit_consolidation(t: Tables):
    return an.consolidate_visits(encounters(t), KINDS)[1]


@query("visit_table", sql=f"WITH {VISITS} SELECT visit_id, patient, kind AS visit_kind, v_start, v_end FROM v")
def visit_table(t: Tables):
    return an.consolidate_visits(encounters(t), KINDS)[0].select("visit_id", "patient", "visit_kind", "v_start", "v_end")


@query("cohort_build", sql="""
SELECT 'urgent' AS cohort, c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 450000)
UNION ALL SELECT 'errors', c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 15)""")
def cohort_build(t: Tables):
    people = t.customer.select("c_custkey", "c_name")
    urgent = t.orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    errors = t.events.where("event_type = 'error'").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n")).where("n >= 15")
    pick = lambda name, keys: people.join(keys, "c_custkey", "left_semi").select(F.lit(name).alias("cohort"), "c_custkey", "c_name")
    return pick("urgent", urgent).unionByName(pick("errors", errors))


@query("sensor_features", sql="""
WITH h AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, avg(value) AS mean, stddev_pop(value) AS sd, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90 FROM events GROUP BY 1, 2),
 st AS (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS s, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS e FROM events GROUP BY 1, 2 HAVING count(*) FILTER (WHERE value > 150) >= 6)
SELECT h.event_type, hour, round(mean, 6) AS mean, round(sd, 6) AS sd, round(p10, 6) AS p10, round(p90, 6) AS p90, CASE WHEN s IS NULL THEN 'ok' ELSE 'abnormal' END AS state FROM h LEFT JOIN st ON h.event_type = st.event_type AND hour >= s AND hour < e""")
def sensor_features(t: Tables):
    hour = ntz(F.date_trunc("hour", "ts")).alias("hour")
    from millrace.operators.aggregates import exact_percentiles

    rows = t.events.select("event_type", hour, "value")
    hourly = rows.groupBy("event_type", "hour").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")).join(
        exact_percentiles(rows, ["event_type", "hour"], "value", {"p10": 0.1, "p90": 0.9}), ["event_type", "hour"])
    d = ntz(F.date_trunc("day", "ts"))
    bad = t.events.groupBy("event_type", d.alias("s")).agg(F.count_if(F.col("value") > 150).alias("high")).where("high >= 6").select(
        "event_type", "s", (F.col("s") + F.expr("INTERVAL 1 DAY")).alias("e"))
    out = interval_join(hourly, bad, ["event_type"], "hour", "s", "e", 86400, "left")
    return out.select("event_type", "hour", rnd("mean", 6).alias("mean"), rnd("sd", 6).alias("sd"), rnd("p10", 6).alias("p10"), rnd("p90", 6).alias("p90"),
                      F.when(F.col("s").isNull(), "ok").otherwise("abnormal").alias("state"))


@query("fraud_summary", sql="""
WITH m AS (SELECT max(l_shipdate) AS m FROM lineitem),
 x AS (SELECT least(c_nationkey, s_nationkey) AS a, greatest(c_nationkey, s_nationkey) AS b, l_extendedprice AS v, (l_returnflag = 'R')::INT AS fraud FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey, m WHERE l_shipdate >= m - INTERVAL 360 DAY)
SELECT a, b, count(*) AS n, sum(fraud)::BIGINT AS frauds, round(sum(v), 2) AS amount FROM x GROUP BY 1, 2 ORDER BY amount DESC, a, b LIMIT 20""")
def fraud_summary(t: Tables):
    start = t.lineitem.select(F.max("l_shipdate") - F.expr("INTERVAL 360 DAYS")).scalar()
    rows = (
        t.lineitem.where(F.col("l_shipdate") >= start).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")))
    return rows.groupBy(F.least("c_nationkey", "s_nationkey").alias("a"), F.greatest("c_nationkey", "s_nationkey").alias("b")).agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("frauds"), rnd(F.sum("l_extendedprice"), 2).alias("amount")).orderBy(
        F.desc("amount"), "a", "b").limit(20)


@query("station_daily", sql="""
WITH f AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, c_nationkey AS station, count(*) AS out_n, round(sum(o_totalprice), 2) AS revenue, count(DISTINCT o_custkey) AS riders, arg_min(o_orderkey, o_orderkey) AS first_ride FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
 b AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS d, s_nationkey AS station, count(*) AS in_n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT coalesce(f.d, b.d) AS d, coalesce(f.station, b.station) AS station, coalesce(out_n, 0) AS out_n, coalesce(in_n, 0) AS in_n, coalesce(in_n, 0) - coalesce(out_n, 0) AS net, coalesce(revenue, 0) AS revenue, coalesce(riders, 0) AS riders, first_ride
FROM f FULL JOIN b ON f.d = b.d AND f.station = b.station""")
def station_daily(t: Tables):
    out = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(day("o_orderdate").alias("d"), F.col("c_nationkey").alias("station")).agg(
        F.count("*").alias("out_n"), rnd(F.sum("o_totalprice"), 2).alias("revenue"), F.count_distinct("o_custkey").alias("riders"), F.min("o_orderkey").alias("first_ride"))
    back = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(day("l_shipdate").alias("d"), F.col("s_nationkey").alias("station")).agg(F.count("*").alias("in_n"))
    both = out.join(back, ["d", "station"], "full").fillna(0, ["out_n", "in_n", "riders"]).fillna(0.0, ["revenue"])
    return both.select("d", "station", "out_n", "in_n", (F.col("in_n") - F.col("out_n")).alias("net"), "revenue", "riders", "first_ride")


@query("churn_kpis", sql="""
WITH l AS (SELECT o_custkey, max(o_orderdate) AS last, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1)
SELECT c_mktsegment AS segment, count(*) AS customers, sum((last < TIMESTAMP '2001-01-01')::INT)::BIGINT AS churned, round(avg((last < TIMESTAMP '2001-01-01')::INT), 6) AS churn_rate,
 round(coalesce(sum(total / 80) FILTER (WHERE last < TIMESTAMP '2001-01-01'), 0), 2) AS mrr_at_risk, round(sum(total) / sum(n), 4) AS mean_order FROM l JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def churn_kpis(t: Tables):
    life = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"), F.sum("o_totalprice").alias("total"), F.count("*").alias("n"))
    gone = F.col("last") < "2001-01-01"
    return life.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("customers"), F.count_if(gone).alias("churned"), rnd(F.avg(gone.cast("int")), 6).alias("churn_rate"),
        rnd(F.coalesce(F.sum(F.when(gone, F.col("total") / 80)), F.lit(0.0)), 2).alias("mrr_at_risk"), rnd(F.sum("total") / F.sum("n")).alias("mean_order"))
