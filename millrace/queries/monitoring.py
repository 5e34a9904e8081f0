"""Profiles, drift, prediction quality, audit and cost reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cdc, monitor, sketches
from millrace.operators.aggregates import exact_percentiles
from millrace.operators.joins import close_intervals, interval_join
from millrace.queries.registry import Tables, day, ntz, query, rnd
from millrace.session import materialize

def year():
    return F.date_format("l_shipdate", "yyyy")

PROFILE_PARTS = "\nUNION ALL ".join(
    f"""SELECT strftime(l_shipdate, '%Y') AS win, {sk} AS slice_key, {sv} AS slice_value, '{c}' AS column_name, count(*) AS "rows", count(*) - count({c}) AS nulls,
 {num.format(e=f'min({c}::DOUBLE)')} AS lo, {num.format(e=f'max({c}::DOUBLE)')} AS hi, {num.format(e=f'round(avg({c}::DOUBLE), 6)')} AS mean, {num.format(e=f'round(stddev_samp({c}::DOUBLE), 6)')} AS sd, count(DISTINCT {c}) AS kinds
 FROM lineitem GROUP BY 1, 3"""
    for sk, sv in (("NULL::VARCHAR", "NULL::VARCHAR"), ("'status'", "l_linestatus"))
    for c, num in (("l_quantity", "{e}"), ("l_discount", "{e}"), ("l_returnflag", "NULL::DOUBLE")))
PROFILE_PARTS = PROFILE_PARTS.replace("min(l_returnflag::DOUBLE)", "NULL")


@query("profile_metrics", sql=PROFILE_PARTS)
def profile_metrics(t: Tables):
    rows = monitor.profile(t.lineitem, year(), ["l_quantity", "l_discount"], ["l_returnflag"], {"status": "l_linestatus"})
    return rows.select("win", "slice_key", "slice_value", "column_name", "rows", "nulls", F.col("min").alias("lo"), F.col("max").alias("hi"),
                       rnd("avg", 6).alias("mean"), rnd("sd", 6).alias("sd"), F.col("distinct").alias("kinds"))


GRAINS, MARKS = ("day", "week", "month"), (0.1, 0.5, 0.9)


@query("profile_granular", sql="""
WITH g AS (SELECT *, CASE grain WHEN 'day' THEN date_trunc('day', ts) WHEN 'week' THEN date_trunc('week', ts) ELSE date_trunc('month', ts) END AS win,
  unnest(['*', 'type']) AS slice_key, unnest(['*', event_type]) AS slice_value FROM events, (SELECT unnest(['day', 'week', 'month']) AS grain))
SELECT grain, strftime(win, '%Y-%m-%d') AS win, slice_key, slice_value, count(*) AS "rows", count(*) - count(value) AS nulls, min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean,
 round(quantile_cont(value, 0.5), 6) AS median, true AS quantiles_near, count(DISTINCT user_id) AS users, true AS users_near FROM g GROUP BY 1, 2, 3, 4""")
def profile_granular(t: Tables):
    """Days, weeks and months from hourly sketches, each held against the exact median, ranks and distinct users."""
    slices = {"type": "event_type"}
    fine = materialize(sketches.fine_profile(t.events, "ts", ["value"], ["user_id"], slices), "hours")
    keys = ["grain", "win", "slice_key", "slice_value"]
    lines = sketches.merged_profile(fine, ["value"], ["user_id"], list(slices), GRAINS, MARKS)
    lines = lines.withColumn("slice_value", F.when(F.col("slice_key").isNull(), "*").otherwise(F.coalesce("slice_value", F.lit("-")))).withColumn("slice_key", F.coalesce("slice_key", F.lit("*")))
    lines = materialize(lines, "levels")
    value = lines.where("column_name = 'value'").select(*keys, "rows", "nulls", F.col("min").alias("lo"), F.col("max").alias("hi"), rnd("mean", 6).alias("mean"))
    users = lines.where("column_name = 'user_id'").select(*keys, "distinct_about")
    guesses = lines.where("column_name = 'value'").select(*keys, "quantiles")
    rows = sketches.levels(t.events.select("ts", "event_type", "value", "user_id"), "ts", slices, GRAINS)
    near = sketches.ranks_near(rows, keys, "value", guesses, MARKS, 0.01)
    median = exact_percentiles(rows, keys, "value", {"median": 0.5})
    exact = rows.groupBy(*keys, "user_id").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.count("user_id").alias("users"))
    out = value.join(users, keys).join(near, keys, "left").join(median, keys, "left").join(exact, keys)
    return out.select("grain", day("win").alias("win"), "slice_key", "slice_value", "rows", "nulls", "lo", "hi", "mean", rnd("median", 6).alias("median"), F.col("near").alias("quantiles_near"),
                      "users", (F.abs(F.col("distinct_about") - F.col("users")) <= 0.05 * F.col("users") + 1).alias("users_near"))


@query("profile_custom", sql="\nUNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS column_name, round(sum({c} * {c}), 2) AS squares, count({c})::DOUBLE AS filled, round(sqrt(sum({c} * {c}) / count({c})), 6) AS rms FROM lineitem GROUP BY 1"""
    for c in ("l_quantity", "l_tax")))
def profile_custom(t: Tables):
    out = monitor.custom_metrics(t.lineitem, ["l_returnflag"], ["l_quantity", "l_tax"], {"squares": "sum({{column}} * {{column}})", "filled": "count({{column}})"},
                                 {"rms": "sqrt(squares / filled)"})
    return out.select("l_returnflag", "column_name", rnd("squares", 2).alias("squares"), "filled", rnd("rms", 6).alias("rms"))


SHARE = """h AS (SELECT strftime(o_orderdate, '%Y') AS win, o_orderpriority AS item, count(*) AS n FROM orders GROUP BY 1, 2),
 s AS (SELECT *, n / sum(n) OVER (PARTITION BY win) AS share FROM h), items AS (SELECT DISTINCT item FROM h),
 wins AS (SELECT win, lag(win) OVER (ORDER BY win) AS prev FROM (SELECT DISTINCT win FROM h))"""
PAIRED = SHARE + """, pair AS (SELECT w.win, items.item, coalesce(a.share, 0) AS p, coalesce(b.share, 0) AS q, coalesce(a.n, 0) AS n_now
  FROM wins w CROSS JOIN items LEFT JOIN s a ON a.win = w.win AND a.item = items.item LEFT JOIN s b ON b.win = {ref} AND b.item = items.item WHERE w.prev IS NOT NULL)"""
PAIRED = PAIRED.replace("b.win = {ref}", "b.win = w.prev")
DRIFT = """SELECT win, round(sqrt(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)), 8) AS js,
 round(sum(abs(p - q)) / 2, 8) AS tv, round(max(abs(p - q)), 8) AS linf"""


def priority_shares(t: Tables):
    hist = monitor.value_histogram(t.orders, F.date_format("o_orderdate", "yyyy"), ["o_orderpriority"])
    return monitor.shares(hist, ["win"]).select("win", "item", "n", "share")


def drift_columns(df):
    return [rnd("js_distance", 8).alias("js"), rnd("total_variation", 8).alias("tv"), rnd("l_infinity", 8).alias("linf")]


@query("drift_js_tv_linf", sql=f"""WITH {PAIRED}, e AS (SELECT *, q * sum(n_now) OVER (PARTITION BY win) AS ex FROM pair)
{DRIFT}, round(sum(CASE WHEN ex > 0 THEN (n_now - ex) * (n_now - ex) / ex END), 6) AS chi2 FROM e GROUP BY 1""")
def drift_js(t: Tables):
    out = monitor.drift(monitor.pair_previous(priority_shares(t), []), ["win"])
    return out.select("win", *drift_columns(out), rnd("chi_squared", 6).alias("chi2"))


@query("drift_consecutive", sql="""
WITH m AS (SELECT strftime(l_shipdate, '%Y') AS win, avg(l_quantity) AS mean, avg(l_discount) AS disc FROM lineitem GROUP BY 1)
SELECT win, round(mean - lag(mean) OVER (ORDER BY win), 8) AS mean_change, round(disc - lag(disc) OVER (ORDER BY win), 8) AS disc_change FROM m QUALIFY lag(mean) OVER (ORDER BY win) IS NOT NULL""")
def drift_consecutive(t: Tables):
    from pyspark.sql import Window

    means = t.lineitem.groupBy(year().alias("win")).agg(F.avg("l_quantity").alias("mean"), F.avg("l_discount").alias("disc"))
    w = Window.orderBy("win")  # one row per period
    change = lambda c: F.col(c) - F.lag(c).over(w)
    return means.select("win", rnd(change("mean"), 8).alias("mean_change"), rnd(change("disc"), 8).alias("disc_change")).where("mean_change IS NOT NULL")


@query("drift_baseline", sql=f"""
WITH {SHARE}, b AS (SELECT item, share AS q FROM s WHERE win = '1995'), pair AS (SELECT w.win, items.item, coalesce(a.share, 0) AS p, coalesce(b.q, 0) AS q
 FROM wins w CROSS JOIN items LEFT JOIN s a ON a.win = w.win AND a.item = items.item LEFT JOIN b ON b.item = items.item)
{DRIFT} FROM pair GROUP BY 1""")
def drift_baseline(t: Tables):
    now = priority_shares(t)
    paired = monitor.pair_baseline(now, now.where("win = '1995'").drop("win"), [])
    out = monitor.drift(paired, ["win"])
    return out.select("win", *drift_columns(out))


SCORED = """r AS (SELECT strftime(l_shipdate, '%Y') AS win, (l_suppkey % 3)::BIGINT AS model, l_extendedprice AS actual, l_quantity * 1500 AS predicted FROM lineitem)"""


def scored(t: Tables):
    return t.lineitem.select(year().alias("win"), (F.col("l_suppkey") % 3).alias("model"), F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500).alias("predicted"))


@query("inference_quality", sql=f"""
WITH {SCORED} SELECT win, model, count(*) AS n, round(avg((actual - predicted) ** 2), 2) AS mse, round(avg(abs(actual - predicted)), 6) AS mae,
 round(1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)), 6) AS r2 FROM r GROUP BY 1, 2""")
def inference_quality(t: Tables):
    out = monitor.regression_quality(scored(t), ["win", "model"], "actual", "predicted")
    return out.select("win", "model", "n", rnd("mse", 2).alias("mse"), rnd("mae", 6).alias("mae"), rnd("r2", 6).alias("r2"))


@query("expected_loss", sql=f"""
WITH {SCORED} SELECT win, round(sum(CASE WHEN predicted > actual THEN 2 * (predicted - actual) ELSE actual - predicted END), 2) AS loss,
 round(avg(CASE WHEN predicted > actual THEN 2 * (predicted - actual) ELSE actual - predicted END), 6) AS mean_loss FROM r GROUP BY 1""")
def expected_loss(t: Tables):
    over = F.col("predicted") - F.col("actual")
    loss = F.when(over > 0, 2 * over).otherwise(-over)
    return scored(t).groupBy("win").agg(rnd(F.sum(loss), 2).alias("loss"), rnd(F.avg(loss), 6).alias("mean_loss"))


@query("drift_alerts", sql=f"""
WITH {PAIRED}, d AS ({DRIFT} FROM pair GROUP BY 1), {SCORED}, q AS (SELECT win, avg(abs(actual - predicted)) AS mae, count(*) AS n FROM r GROUP BY 1)
SELECT q.win, round(mae, 6) AS mae, js, (mae > 19500)::INT AS alert_error, coalesce(js > 0.02, false)::INT AS alert_drift, (mae > 19500)::INT + coalesce(js > 0.02, false)::INT AS violations FROM q LEFT JOIN d ON q.win = d.win""")
def drift_alerts(t: Tables):
    found = monitor.drift(monitor.pair_previous(priority_shares(t), []), ["win"])
    perf = monitor.regression_quality(scored(t), ["win"], "actual", "predicted").select("win", "mae")
    out = monitor.alerts(perf, found.select("win", rnd("js_distance", 8).alias("js")), ["win"], {"error": "mae > 19500", "drift": "js > 0.02"})
    return out.withColumn("mae", rnd("mae", 6))


@query("label_backfill", sql="""
SELECT d.doc_id, source, CASE WHEN l.doc_id IS NOT NULL THEN quality END AS label, (l.doc_id IS NOT NULL)::INT AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def label_backfill(t: Tables):
    log = t.documents.select("doc_id", "source", F.lit(None).cast("int").alias("label"), F.lit(0).alias("labelled"))
    return cdc.merge(log, t.labels, ["doc_id"], [cdc.Clause("matched", "update", values={"label": "s.quality", "labelled": "1"})])


@query("audit_reports", sql="""
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS d, event_type AS action, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
 a AS (SELECT d, action, count(*) AS n, count(DISTINCT user_id) AS users, sum(CASE WHEN k > 50 THEN 1 ELSE 0 END)::BIGINT AS big FROM e GROUP BY 1, 2)
SELECT d, action, n, users, big FROM a QUALIFY row_number() OVER (PARTITION BY d ORDER BY n DESC, action) <= 3""")
def audit_reports(t: Tables):
    from millrace.operators.sampling import top_per_group

    params = F.map_filter(F.from_json("props", "map<string,string>"), lambda k, v: v.isNotNull())
    flat = t.events.select(day("ts").alias("d"), F.col("event_type").alias("action"), "user_id", params["k"].try_cast("long").alias("k"))
    counts = flat.groupBy("d", "action").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.count_if(F.col("k") > 50).alias("big"))
    return top_per_group(counts, ["d"], [F.desc("n"), F.asc("action")], 3)


@query("usage_cost", sql="""
WITH u AS (SELECT p_brand AS sku, l_shipdate AS used, l_quantity AS units, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey),
 y AS (SELECT p_brand AS sku, make_timestamp(year(l_shipdate), 1, 1, 0, 0, 0) AS price_start, avg(l_extendedprice / l_quantity) AS unit_price FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
 p AS (SELECT *, lead(price_start) OVER (PARTITION BY sku ORDER BY price_start) AS price_end FROM y)
SELECT u.sku, strftime(used, '%Y-%m') AS month, round(sum(units * unit_price), 2) AS cost, round(sum(units), 2) AS units, max((l_returnflag = 'R')::INT) AS had_returns
FROM u JOIN p ON u.sku = p.sku AND used >= price_start AND (price_end IS NULL OR used < price_end) GROUP BY 1, 2""")
def usage_cost(t: Tables):
    usage = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("sku"), F.col("l_shipdate").alias("used"), F.col("l_quantity").alias("units"), "l_returnflag", "l_extendedprice")
    steps = usage.groupBy("sku", ntz(F.date_trunc("year", "used")).alias("price_start")).agg(F.avg(F.col("l_extendedprice") / F.col("units")).alias("unit_price"))
    prices = close_intervals(steps, ["sku"], "price_start", "price_end")
    # usage collapses to sku and day before the range join
    daily = usage.groupBy("sku", "used").agg(F.sum("units").alias("units"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"))
    priced = interval_join(daily, prices, ["sku"], "used", "price_start", "price_end", 366 * 86400)
    return priced.groupBy("sku", F.date_format("used", "yyyy-MM").alias("month")).agg(
        rnd(F.sum(F.col("units") * F.col("unit_price")), 2).alias("cost"), rnd(F.sum("units"), 2).alias("units"), F.max("returned").alias("had_returns"))
