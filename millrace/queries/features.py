"""Features, training sets, scoring and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import cyclical, hash_bucket
from millrace.operators import learning
from millrace.operators.features import Feature, Lookup, TimeWindow, one_hot, training_set, window_features
from millrace.operators.ordered import OrderedGroups
from millrace.operators.quality import Rule, drop_failed
from millrace.queries.registry import Tables, day, ntz, query, rnd

DAY = 86400
SPECS = [Feature("spent", "sum", "value"), Feature("mean_value", "avg", "value"), Feature("peak", "max", "value"),
         Feature("clicks", "count", "value", "event_type = 'click'"), Feature("spread", "stddev_samp", "value")]
AGGS = """round(sum(value) {f}, 2) AS spent, round(avg(value) {f}, 8) AS mean_value, max(value) {f} AS peak,
 count(CASE WHEN event_type = 'click' THEN value END) {f} AS clicks, round(stddev_samp(value) {f}, 8) AS spread"""


def tidy(df, *keys):
    return df.select(*keys, rnd("spent", 2).alias("spent"), rnd("mean_value", 8).alias("mean_value"), "peak", "clicks", rnd("spread", 8).alias("spread"))


@query("feat_continuous", sql=f"""
SELECT event_id, user_id, {AGGS.format(f="OVER w")} FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW)""")
def feat_continuous(t: Tables):
    return tidy(window_features(t.events, ["user_id"], "ts", TimeWindow("continuous", 3 * DAY), SPECS), "event_id", "user_id")


@query("feat_tumbling", sql=f"""
SELECT user_id, time_bucket(INTERVAL 3 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, {AGGS.format(f="")} FROM events GROUP BY 1, 2""")
def feat_tumbling(t: Tables):
    return tidy(window_features(t.events, ["user_id"], "ts", TimeWindow("tumbling", 3 * DAY), SPECS), "user_id", "window_start")


@query("feat_sliding", sql=f"""
SELECT user_id, date_trunc('day', ts)::TIMESTAMP - to_days(back::INTEGER) AS window_start, {AGGS.format(f="")}
FROM events, (SELECT unnest([0, 1, 2]) AS back) GROUP BY 1, 2""")
def feat_sliding(t: Tables):
    return tidy(window_features(t.events, ["user_id"], "ts", TimeWindow("sliding", 3 * DAY, DAY), SPECS), "user_id", "window_start")


@query("feat_cyclical", sql="""
SELECT event_id, round(sin(hour(ts) * 2 * pi() / 24), 8) AS hour_sin, round(cos(hour(ts) * 2 * pi() / 24), 8) AS hour_cos,
 round(sin((dayofweek(ts) + 1) * 2 * pi() / 7), 8) AS weekday_sin, round(cos(day(ts) * 2 * pi() / 31), 8) AS day_cos FROM events""")
def feat_cyclical(t: Tables):
    hs, hc = cyclical(F.hour("ts"), 24)
    return t.events.select("event_id", rnd(hs, 8).alias("hour_sin"), rnd(hc, 8).alias("hour_cos"),
                           rnd(cyclical(F.dayofweek("ts"), 7)[0], 8).alias("weekday_sin"), rnd(cyclical(F.dayofmonth("ts"), 31)[1], 8).alias("day_cos"))


@query("training_set", sql="""
WITH lab AS (SELECT event_id, user_id, ts, CASE WHEN value > 50 THEN 1 ELSE 0 END AS label FROM events WHERE event_type = 'purchase'),
 clicks AS (SELECT user_id, ts AS c_ts, value AS click_value FROM events WHERE event_type = 'click'),
 views AS (SELECT user_id, ts AS v_ts, value AS view_value FROM events WHERE event_type = 'view'),
 a AS (SELECT lab.*, click_value FROM lab ASOF LEFT JOIN clicks ON lab.user_id = clicks.user_id AND ts >= c_ts),
 b AS (SELECT a.*, view_value FROM a ASOF LEFT JOIN views ON a.user_id = views.user_id AND ts >= v_ts)
SELECT event_id, label, click_value, view_value, c_mktsegment FROM b LEFT JOIN customer ON user_id = c_custkey""")
def training(t: Tables):
    labels = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", F.when(F.col("value") > 50, 1).otherwise(0).alias("label"))
    def source(kind, at, name):
        return t.events.where(F.col("event_type") == kind).select("user_id", F.col("ts").alias(at), F.col("value").alias(name), F.col("event_id").alias("eid"))
    people = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return training_set(labels, "ts", [
        Lookup(source("click", "c_ts", "click_value"), ["user_id"], ["click_value"], "c_ts", ["eid"]),
        Lookup(source("view", "v_ts", "view_value"), ["user_id"], ["view_value"], "v_ts", ["eid"]),
        Lookup(people, ["user_id"], ["c_mktsegment"])], exclude=["user_id", "ts"])


@query("onehot", sql="SELECT event_id, " + ", ".join(
    f"CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END AS event_type_{k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events")
def onehot(t: Tables):
    from millrace.operators.features import categories

    return one_hot(t.events.select("event_id", "event_type"), "event_type", categories(t.events, "event_type"))


@query("label_within_days", sql="""
SELECT event_id, user_id, CASE WHEN lag(ts) OVER w IS NOT NULL AND ts - lag(ts) OVER w <= INTERVAL 1 DAY THEN 1 ELSE 0 END AS returned
FROM events WHERE event_type IN ('purchase', 'signup') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def label_within_days(t: Tables):
    rows = t.events.where("event_type IN ('purchase', 'signup')").select("event_id", "user_id", "ts")
    out = OrderedGroups(rows, ["user_id"], ["ts", "event_id"]).lag({"prev": "ts"}).result()
    near = F.col("prev").isNotNull() & (F.col("ts") <= F.col("prev") + F.expr("INTERVAL 1 DAY"))
    return out.select("event_id", "user_id", F.when(near, 1).otherwise(0).alias("returned"))


@query("feat_consolidate", sql="""
WITH o AS (SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS done FROM orders GROUP BY 1),
 e AS (SELECT user_id, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT c_custkey, coalesce(orders, 0)::BIGINT AS orders, coalesce(events, 0)::BIGINT AS events, round(coalesce(done / nullif(orders, 0), 0), 6) AS done_rate,
 round(coalesce(errors / nullif(events, 0), 0), 6) AS error_rate, round(coalesce(total, 0) / (1 + coalesce(events, 0)), 7) AS total_per_event
FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id""")
def feat_consolidate(t: Tables):
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    e = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))
    all_ = t.customer.select("c_custkey").join(o, "c_custkey", "left").join(e, "c_custkey", "left").fillna(0)
    return all_.select("c_custkey", "orders", "events", rnd(F.coalesce(F.try_divide("done", "orders"), F.lit(0)), 6).alias("done_rate"),
                       rnd(F.coalesce(F.try_divide("errors", "events"), F.lit(0)), 6).alias("error_rate"),
                       rnd(F.col("total") / (1 + F.col("events")), 7).alias("total_per_event"))


@query("feat_c360", sql="""
WITH quarters AS (SELECT o_custkey, date_trunc('quarter', o_orderdate) AS quarter, count(*) AS n, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2),
 buying AS (SELECT o_custkey, count(*) AS quarters, max(n) AS busiest, round(arg_max(value, quarter) / sum(value), 6) AS last_share FROM quarters GROUP BY 1),
 steps AS (SELECT user_id, event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events),
 acting AS (SELECT user_id, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_share, round(max(gap) / 3.6e9, 4) AS silent_hours FROM steps GROUP BY 1)
SELECT c_custkey, coalesce(quarters, 0) AS quarters, coalesce(busiest, 0) AS busiest, last_share, error_share, silent_hours
FROM customer LEFT JOIN buying ON c_custkey = o_custkey LEFT JOIN acting ON c_custkey = user_id""")
def feat_c360(t: Tables):
    """How steadily customers buy (by quarter) and how smoothly they act: every customer, also those without orders or events."""
    by_quarter = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.date_trunc("quarter", "o_orderdate").alias("quarter")).agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("value"))
    buying = by_quarter.groupBy("c_custkey").agg(
        F.count("*").alias("quarters"), F.max("n").alias("busiest"), rnd(F.max_by("value", "quarter") / F.sum("value"), 6).alias("last_share"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    steps = OrderedGroups(t.events.select("user_id", "event_type", "event_id", at.alias("at")), ["user_id"], ["at", "event_id"]).lag({"before": "at"}).result()
    acting = steps.groupBy(F.col("user_id").alias("c_custkey")).agg(
        rnd(F.count_if(F.col("event_type") == "error") / F.count("*"), 6).alias("error_share"), rnd(F.max(F.col("at") - F.col("before")) / 3.6e9).alias("silent_hours"))
    everyone = t.customer.select("c_custkey").join(buying, "c_custkey", "left").join(acting, "c_custkey", "left")
    return everyone.fillna(0, ["quarters", "busiest"])


@query("feat_count_flags", sql="""
SELECT user_id, ((sum((event_type='click')::INT) > 0)::INT + (sum((event_type='error')::INT) > 15)::INT + (sum((event_type='view')::INT) > 12)::INT)::INTEGER AS services,
 coalesce(max(TRY_CAST(nullif(trim(CASE WHEN event_type = 'error' THEN ' ' ELSE value::VARCHAR END), '') AS DOUBLE)), 0) AS top_value FROM events GROUP BY 1""")
def feat_count_flags(t: Tables):
    has = lambda kind, n: (F.count_if(F.col("event_type") == kind) > n).cast("int")
    text = F.when(F.col("event_type") == "error", " ").otherwise(F.col("value").cast("string"))
    blank_is_null = F.nullif(F.trim(text), F.lit("")).try_cast("double")
    return t.events.groupBy("user_id").agg((has("click", 0) + has("error", 15) + has("view", 12)).alias("services"),
                                           F.coalesce(F.max(blank_is_null), F.lit(0.0)).alias("top_value"))


# ---------------------------------------------------------------- learning


def customer_rows(t: Tables):
    """Per customer: numbers, a category, and whether the newest order is fulfilled."""
    o = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").cast("double").alias("orders"), F.avg("o_totalprice").alias("avg_total"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))).alias("urgent_total"),
        (F.max_by("o_orderstatus", "o_orderkey") == "F").cast("double").alias("label"))
    return o.join(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")), "id")


@query("ml_prep")
def ml_prep(t: Tables):
    from pyspark.ml.functions import vector_to_array

    rows = customer_rows(t)
    stages = learning.prepare(["orders", "avg_total", "urgent_total", "balance"], ["segment"])
    return stages.fit(rows).transform(rows).select("id", vector_to_array("features").alias("v")).select("id", F.size("v").alias("width"), rnd(F.col("v")[0], 6).alias("first"))


@query("ml_train_score")
def ml_train_score(t: Tables):
    # fitted on four fifths of the customers; the others show how it does on rows it has not seen
    rows = customer_rows(t).withColumn("held_out", hash_bucket(F.col("id"), 5, "fold") == 0)
    model = learning.fit_classifier(rows.where("not held_out"), ["orders", "avg_total", "urgent_total", "balance"], ["segment"])
    return learning.score(model, rows).select("id", "held_out", "label", "prediction", rnd("probability", 6).alias("probability"))


@query("ml_boosted")
def ml_boosted(t: Tables):
    """Trees grown on three fifths of the customers, their number chosen on a fifth; all are scored, the last fifth tells how well."""
    fold = hash_bucket(F.col("id"), 5, "fold")
    rows = customer_rows(t).withColumns({"held_out": fold == 0, "choosing": fold == 1})
    model = learning.fit_boosted(rows.where("not held_out"), ["orders", "avg_total", "urgent_total", "balance"], ["segment"], "choosing")
    return learning.score(model, rows).select("id", "held_out", "choosing", "label", "prediction", rnd("probability", 6).alias("probability"))


@query("ml_batch_score")
def ml_batch_score(t: Tables):
    """Score with a fitted model shipped to the tasks as plain numbers."""
    rows = customer_rows(t).fillna(0.0)
    weights, intercept = learning.linear_weights(rows, ["orders", "avg_total", "balance"])
    return rows.select("id", rnd(learning.linear_score(weights, intercept)("orders", "avg_total", "balance"), 6).alias("score"))


@query("ml_lookup_score")
def ml_lookup_score(t: Tables):
    """Only ids and times come in; features are fetched as of that time, then scored."""
    asks = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    feats = t.events.where("event_type <> 'purchase'").select("user_id", F.col("ts").alias("f_ts"), F.col("value").alias("last_value"), F.col("event_id").alias("f_id"))
    people = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance"))
    rows = training_set(asks, "ts", [Lookup(feats, ["user_id"], ["last_value"], "f_ts", ["f_id"]), Lookup(people, ["user_id"], ["balance"])])
    rows = rows.fillna(0.0)
    known = rows.join(t.events.select("event_id", (F.col("value") > 50).cast("double").alias("label")), "event_id")
    weights, intercept = learning.linear_weights(known, ["last_value", "balance"])
    return rows.select("event_id", rnd(learning.linear_score(weights, intercept)("last_value", "balance"), 6).alias("score"))


# ---------------------------------------------------------------- evaluation

PRED = """p AS (SELECT d.doc_id, lang, source, quality AS label, CASE WHEN n_chars >= 1500 THEN 1 ELSE 0 END AS champion, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS challenger
 FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def predictions(t: Tables):
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", "lang", "source", F.col("quality").alias("label"), F.when(F.col("n_chars") >= 1500, 1).otherwise(0).alias("champion"),
        F.when(F.col("lang") == "en", 1).otherwise(0).alias("challenger"))


@query("eval_confusion", sql=f"""
WITH {PRED}, c AS (SELECT count(*) FILTER (WHERE label=1 AND champion=1) AS tp, count(*) FILTER (WHERE label=0 AND champion=1) AS fp,
 count(*) FILTER (WHERE label=1 AND champion=0) AS fn, count(*) FILTER (WHERE label=0 AND champion=0) AS tn FROM p),
 r AS (SELECT label, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS place FROM p JOIN documents USING (doc_id)),
 u AS (SELECT (sum(place) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2) / nullif(count(*) FILTER (label = 1) * count(*) FILTER (label = 0), 0) AS auc FROM r)
SELECT c.*, round(tp/nullif(tp+fp,0), 6) AS "precision", round((tp+tn)/(tp+tn+fp+fn), 6) AS accuracy, round(tp/nullif(tp+fn,0), 6) AS recall, round(2*tp/nullif(2*tp+fp+fn,0), 6) AS f1,
 round(auc, 6) AS auc FROM c, u""")
def eval_confusion(t: Tables):
    out = learning.confusion(predictions(t), "label", "champion")
    scored = t.documents.join(t.labels, "doc_id").select(F.col("quality").alias("label"), "n_chars")
    out = out.withColumn("auc", learning.auc(scored, "label", "n_chars").scalar())
    return out.select("tp", "fp", "fn", "tn", *[rnd(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc")])


@query("eval_business_value", sql=f"""
WITH {PRED}, m AS (SELECT 'champion' AS model, label, champion AS pred FROM p UNION ALL SELECT 'challenger', label, challenger FROM p)
SELECT model, count(*) AS n, sum(CASE WHEN label=1 AND pred=1 THEN 50 WHEN label=0 AND pred=1 THEN -20 WHEN label=1 AND pred=0 THEN -35 ELSE 0 END)::DOUBLE AS value FROM m GROUP BY 1""")
def eval_business_value(t: Tables):
    return learning.business_value(predictions(t), "label", ["champion", "challenger"], {(1, 1): 50.0, (0, 1): -20.0, (1, 0): -35.0, (0, 0): 0.0})


@query("eval_set_pr", sql="""
WITH a AS (SELECT o_custkey, list(DISTINCT o_orderpriority) FILTER (WHERE o_orderdate < TIMESTAMP '1999-01-01') AS predicted,
 list(DISTINCT o_orderpriority) FILTER (WHERE o_orderdate >= TIMESTAMP '1999-01-01') AS truth FROM orders GROUP BY 1)
SELECT o_custkey, round(len(list_intersect(coalesce(predicted, []), coalesce(truth, []))) / nullif(len(coalesce(predicted, [])), 0), 6) AS "precision",
 round(len(list_intersect(coalesce(predicted, []), coalesce(truth, []))) / nullif(len(coalesce(truth, [])), 0), 6) AS recall FROM a""")
def eval_set_pr(t: Tables):
    kinds = lambda cond: F.collect_set(F.when(F.expr(cond), F.col("o_orderpriority")))
    sets = t.orders.groupBy("o_custkey").agg(kinds("o_orderdate < '1999-01-01'").alias("predicted"), kinds("o_orderdate >= '1999-01-01'").alias("truth"))
    p, r = learning.set_scores(F.col("predicted"), F.col("truth"))
    return sets.select("o_custkey", rnd(p, 6).alias("precision"), rnd(r, 6).alias("recall"))


@query("fairness_parity", sql=f"""
WITH {PRED}, g AS (SELECT lang, avg(champion) AS rate FROM p GROUP BY 1) SELECT round(max(rate) - min(rate), 6) AS parity_gap, arg_max(lang, rate) AS highest, count(*) AS groups FROM g""")
def fairness_parity(t: Tables):
    return learning.parity_gap(predictions(t), "lang", "champion").select(rnd("parity_gap", 6).alias("parity_gap"), "highest", "groups")


@query("hash_assign", sql="""
SELECT c_custkey, CASE ('0x' || substr(md5(c_custkey::VARCHAR || 'arm'), 1, 15))::BIGINT % 3 WHEN 0 THEN 'control' WHEN 1 THEN 'low' ELSE 'high' END AS arm FROM customer""")
def hash_assign(t: Tables):
    bucket = hash_bucket(F.col("c_custkey"), 3, "arm")
    return t.customer.select("c_custkey", F.when(bucket == 0, "control").when(bucket == 1, "low").otherwise("high").alias("arm"))


@query("ab_split", sql="""
WITH a AS (SELECT *, CASE WHEN ('0x' || substr(md5(user_id::VARCHAR || 'route'), 1, 15))::BIGINT % 100 < 90 THEN 'champion' ELSE 'challenger' END AS arm FROM events)
SELECT arm, count(*) AS n, round(avg(value), 6) AS mean_value, round(count(*) FILTER (WHERE event_type = 'purchase') / count(*), 6) AS purchase_rate FROM a GROUP BY 1""")
def ab_split(t: Tables):
    arm = F.when(hash_bucket(F.col("user_id"), 100, "route") < 90, "champion").otherwise("challenger")
    return t.events.groupBy(arm.alias("arm")).agg(F.count("*").alias("n"), rnd(F.avg("value"), 6).alias("mean_value"),
                                                  rnd(F.count_if(F.col("event_type") == "purchase") / F.count("*"), 6).alias("purchase_rate"))
