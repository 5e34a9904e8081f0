"""Forecasts, portfolio measures, survival and visit consolidation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import exact_percentiles
from millrace.operators.intervals import pack_intervals
from millrace.operators.joins import overlap_join
from millrace.operators.ordered import global_numbers, null_safe, settle
from millrace.session import materialize

# Two-sided normal quantiles.
Z_SCORES = {0.8: 1.2815515655446004, 0.9: 1.6448536269514722, 0.95: 1.959963984540054}


def trend_forecast(daily: DataFrame, series: Sequence[str], at: str, value: str, horizon: int, level: float = 0.8,
                   floor: float = 0.0, least_history: int = 10) -> DataFrame:
    """Linear trend plus weekday offset per series, with an interval of ``level``.

    ``daily`` has one row per series and day. Everything is aggregates over those rows.
    Series with at most ``least_history`` days are carried forward at their mean.
    Returns ``series, at, yhat, lower, upper, history``.
    """
    x = F.datediff(F.col(at), F.lit("1970-01-01")).cast("double")
    rows = daily.withColumns({"__x": x, "__y": F.col(value).cast("double"), "__dow": F.dayofweek(at)})
    fit = rows.groupBy(*series).agg(
        F.regr_slope("__y", "__x").alias("__b"), F.regr_intercept("__y", "__x").alias("__a"), F.avg("__y").alias("__mean"),
        F.count("__y").alias("history"), F.max(at).alias("__last"))
    flat = F.col("history") <= least_history
    fit = fit.withColumns({"__b": F.when(flat, 0.0).otherwise(F.coalesce("__b", F.lit(0.0))), "__a": F.when(flat, F.col("__mean")).otherwise(F.coalesce("__a", "__mean"))})
    off = rows.join(fit, list(series)).withColumn("__r", F.col("__y") - F.col("__a") - F.col("__b") * F.col("__x"))
    season = off.groupBy(*series, "__dow").agg(F.avg(F.when(~flat, F.col("__r")).otherwise(0.0)).alias("__s"))
    noise = off.join(season, [*series, "__dow"]).groupBy(*series).agg(F.coalesce(F.stddev_pop(F.col("__r") - F.col("__s")), F.lit(0.0)).alias("__sd"))
    ahead = fit.join(noise, list(series)).withColumn(at, F.explode(F.sequence(F.date_add("__last", 1), F.date_add("__last", horizon))))
    ahead = ahead.withColumn("__dow", F.dayofweek(at)).join(season, [*series, "__dow"], "left")
    yhat = F.col("__a") + F.col("__b") * F.datediff(F.col(at), F.lit("1970-01-01")) + F.coalesce("__s", F.lit(0.0))
    band = F.col("__sd") * Z_SCORES[level]
    clip = lambda c: F.greatest(F.lit(floor), c)
    return ahead.select(*series, at, clip(yhat).alias("yhat"), clip(yhat - band).alias("lower"), clip(yhat + band).alias("upper"), "history")


def stitch(actual: DataFrame, forecast: DataFrame, series: Sequence[str], at: str, value: str, smooth: int = 7) -> DataFrame:
    """History and forecast in one table, values clamped at zero, with a centred moving average."""
    a = actual.select(*series, at, F.greatest(F.lit(0.0), F.col(value).cast("double")).alias("value"), F.lit(0).alias("is_prediction"))
    f = forecast.select(*series, at, F.greatest(F.lit(0.0), F.col("yhat")).alias("value"), F.lit(1).alias("is_prediction"))
    # one row per series and day: the window holds days, not raw rows
    w = Window.partitionBy(*series).orderBy(at).rowsBetween(-smooth, smooth)
    return a.unionByName(f).withColumn("smoothed", F.avg("value").over(w))


def period_returns(prices: DataFrame, key: str, at: str, price: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(at)
    return prices.withColumn("ret", F.col(price) / F.lag(price).over(w) - 1)


def compound(df: DataFrame, by: Sequence[str], at: str, ret: str, name: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.exp(F.sum(F.log1p(ret)).over(w)) - 1)


def risk(returns: DataFrame, by: Sequence[str], ret: str, periods: int, tail: float = 0.05) -> DataFrame:
    """Annualised return and volatility, Sharpe ratio and historical value at risk (null where no return is known).

    The tail quantile comes from counted values, so no task holds a group's returns.
    """
    known = settle(returns.where(F.col(ret).isNotNull()).select(*by, ret), "returns")
    mean, sd = F.avg(ret) * periods, F.stddev_samp(ret) * F.sqrt(F.lit(float(periods)))
    moments = known.groupBy(*by).agg(F.count("*").alias("n"), mean.alias("annual_return"), sd.alias("annual_vol"), F.try_divide(mean, sd).alias("sharpe"))
    tails, on = null_safe(moments, exact_percentiles(known, by, ret, {"value_at_risk": tail}), by)
    return moments.join(tails, on, "left").drop(*[f"__key{i}" for i in range(len(by))])


def survival(df: DataFrame, arm: str, lived: str, most: int) -> DataFrame:
    """Share of each arm still alive at every month 0..``most``.

    Members are counted per (arm, month) first; the curve is a running sum over months.
    """
    counts = df.groupBy(arm, F.least(F.col(lived), F.lit(most)).alias("month")).agg(F.count("*").alias("n"))
    spine = counts.select(arm).distinct().select(arm, F.explode(F.sequence(F.lit(0), F.lit(most))).alias("month"))
    w = Window.partitionBy(arm).orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, 0)
    full = spine.join(counts.withColumn("month", F.col("month").cast("int")), [arm, "month"], "left")
    alive = full.withColumn("alive", F.sum(F.coalesce("n", F.lit(0))).over(w))
    total = F.max("alive").over(Window.partitionBy(arm))
    return alive.withColumn("survival", F.col("alive") / total).select(arm, "month", "alive", "survival")


def consolidate_visits(enc: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Encounters to visits, and the visit of every encounter.

    ``enc(id, patient, class, start, stop)``; ``kinds`` maps class to ``inpatient``,
    ``emergency`` or ``outpatient``. Inpatient stays overlapping or within a day merge;
    emergency and outpatient visits group by start. An emergency or outpatient encounter
    inside an inpatient stay belongs to it (emergency only if it starts after the stay does),
    otherwise to its own visit.
    """
    kind = None
    for name, k in kinds.items():
        kind = F.when(F.col("class") == name, k) if kind is None else kind.when(F.col("class") == name, k)
    rows = enc.withColumn("kind", kind).where("kind IS NOT NULL")
    stays = rows.where("kind = 'inpatient'").select("patient", "kind", F.col("start").alias("v_start"), F.col("stop").alias("v_end"))
    stays = pack_intervals(stays, ["patient", "kind"], "v_start", "v_end", slack=F.expr("INTERVAL 1 DAY")).drop("merged")
    short = rows.where("kind <> 'inpatient'").groupBy("patient", "kind", F.col("start").alias("v_start")).agg(F.max("stop").alias("v_end"))
    # numbering reads its input three times (cuts, counts per chunk, rows)
    visits = materialize(stays.unionByName(short.select(*stays.columns)), "visit-spans")
    visits = global_numbers(visits, ["patient", "v_start", "kind"], "visit_id")
    visits = materialize(visits.withColumnRenamed("kind", "visit_kind"), "visits")
    points = rows.select("id", "patient", "kind", F.col("start").alias("e_from"), F.col("start").alias("e_to"))
    # the bucket is a day: stays of many days are exploded by day, never by patient
    pairs = overlap_join(points, visits, ("e_from", "e_to"), ("v_start", "v_end"), 86400, ["patient"])
    inside = F.when(F.col("kind") == "emergency", F.col("e_from") > F.col("v_start")).otherwise(F.lit(True))
    own = (F.col("visit_kind") == F.col("kind")) & ((F.col("kind") == "inpatient") | (F.col("e_from") == F.col("v_start")))
    rank = F.when((F.col("visit_kind") == "inpatient") & inside, 1).when(own, 2)
    best = pairs.withColumn("rank", rank).where("rank IS NOT NULL").groupBy("id", "patient", "kind").agg(
        F.min(F.struct("rank", "v_start", "visit_id")).alias("b"))
    return visits, best.select("id", "patient", "kind", F.col("b.visit_id").alias("visit_id"))
