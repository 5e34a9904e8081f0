"""Profiles of tables over time, drift between windows, and quality of predictions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import null_safe


def _levels(df: DataFrame, window: Column, slices: Mapping[str, str]) -> tuple[DataFrame, list[str], list[list[str]]]:
    """Rows with ``win`` and one column per slice expression, and the grouping levels."""
    names = [f"__slice{i}" for i in range(len(slices))]
    out = df.withColumn("win", window).withColumns({n: F.expr(e).cast("string") for n, e in zip(names, slices.values())})
    return out, names, [["win"], *[["win", n] for n in names]]


def _label(df: DataFrame, names: Sequence[str], slices: Mapping[str, str]) -> DataFrame:
    """Turn grouping flags into ``slice_key`` and ``slice_value`` (both null for the whole window)."""
    key = value = None
    for n, title in zip(names, slices):
        on = F.col(f"__g{n}") == 0
        key = F.when(on, title) if key is None else key.when(on, title)
        value = F.when(on, F.col(n)) if value is None else value.when(on, F.col(n))
    none = F.lit(None).cast("string")
    return df.withColumns({"slice_key": none if key is None else key, "slice_value": none if value is None else value}).drop(
        *names, *[f"__g{n}" for n in names])


def _at_levels(df: DataFrame, names: Sequence[str], levels: Sequence[Sequence[str]], extra: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    keys = ["win", *names, *extra]
    sets = [[F.col(c) for c in [*level, *extra]] for level in levels]
    return df.groupingSets(sets, *[F.col(k) for k in keys]).agg(*[F.grouping(n).alias(f"__g{n}") for n in names], *aggs)


def profile(df: DataFrame, window: Column, numeric: Sequence[str], text: Sequence[str] = (), slices: Mapping[str, str] = {}) -> DataFrame:
    """Metrics per window, slice and column: rows, nulls, min, max, mean, stddev, distinct, top item.

    Moments of all columns come from one wide aggregate (rows are not multiplied by columns);
    distinct counts and top items come from value counts that combine map-side.
    """
    rows, names, levels = _levels(df, window, slices)
    wide = []
    for c in [*numeric, *text]:
        wide.append(F.count_if(F.col(c).isNull()).alias(f"nulls__{c}"))
    for c in numeric:
        x = F.col(c).cast("double")
        wide += [F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}"), F.avg(x).alias(f"avg__{c}"), F.stddev(x).alias(f"sd__{c}")]
    base = _at_levels(rows, names, levels, [], [F.count("*").alias("rows"), *wide])
    nothing = F.lit(None).cast("double")

    def line(c: str) -> Column:
        num = c in numeric
        return F.struct(
            F.lit(c).alias("column_name"), F.col(f"nulls__{c}").alias("nulls"), *[
                (F.col(f"{k}__{c}") if num else nothing).alias(k) for k in ("min", "max", "avg", "sd")])

    moments = _label(base.withColumn("c", F.explode(F.array(*[line(c) for c in [*numeric, *text]]))), names, slices).select(
        "win", "slice_key", "slice_value", "rows", "c.*")
    counted = value_histogram(df, window, [*numeric, *text], slices)
    kinds = counted.groupBy("win", "slice_key", "slice_value", "column_name").agg(
        F.count("*").alias("distinct"), F.max(F.struct(F.col("n"), F.col("item"))).alias("t")).select(
        "win", "slice_key", "slice_value", "column_name", "distinct", F.col("t.item").alias("top_item"), F.col("t.n").alias("top_count"))
    return _null_safe_join(moments, kinds, ["win", "slice_key", "slice_value", "column_name"])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    l, r = left.alias("l"), right.alias("r")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return l.join(r, on, how).select("l.*", *[F.col(f"r.{c}") for c in right.columns if c not in keys])


def value_histogram(df: DataFrame, window: Column, columns: Sequence[str], slices: Mapping[str, str] = {}) -> DataFrame:
    """Rows per (window, slice, column, value), nulls left out.

    Values are first counted at the finest grain with a combinable aggregate, so the
    grouping sets see distinct values only.
    """
    rows, names, levels = _levels(df, window, slices)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("item")) for c in columns])
    fine = (
        rows.select("win", *names, F.explode(pairs).alias("p")).select("win", *names, "p.*").where("item IS NOT NULL")
        .groupBy("win", *names, "column_name", "item").agg(F.count("*").alias("n"))
    )
    out = _at_levels(fine, names, levels, ["column_name", "item"], [F.sum("n").alias("n")])
    return _label(out, names, slices)


def custom_metrics(df: DataFrame, by: Sequence[str], columns: Sequence[str], aggregates: Mapping[str, str], derived: Mapping[str, str] = {}) -> DataFrame:
    """User metrics from templates: ``{{column}}`` in an aggregate is replaced by each column.

    Derived metrics are expressions over the aggregates of the same row.
    """
    aggs = [F.expr(text.replace("{{column}}", f"`{c}`")).cast("double").alias(f"{name}__{c}") for c in columns for name, text in aggregates.items()]
    wide = df.groupBy(*by).agg(*aggs)
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}__{c}").alias(n) for n in aggregates]) for c in columns])
    out = wide.select(*by, F.explode(lines).alias("c")).select(*by, "c.*")
    return out.withColumns({n: F.expr(e) for n, e in derived.items()})


def with_total(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Add the sum of a column over each group, by a combinable aggregate and a join."""
    totals = df.groupBy(*keys).agg(F.sum(column).alias(name))
    side, on = null_safe(df, totals, keys)
    return df.join(side, on).drop(*[f"__key{i}" for i in range(len(keys))])


def shares(histogram: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts as shares of their group."""
    return with_total(histogram, keys, "n", "__all").withColumn("share", F.col("n") / F.col("__all")).drop("__all")


def pair_previous(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each window's categories beside those of the window before it (zeros where absent)."""
    wins = hist.select("win").distinct()
    # windows are few (one per period); ordering them needs no partition
    order = wins.withColumn("prev", F.lag("win").over(Window.orderBy("win"))).where("prev IS NOT NULL")
    now = hist.join(order.select("win", "prev"), "win").select(*keys, "win", "item", F.col("share").alias("p"), F.col("n").alias("n_now"), F.lit(0.0).alias("q"), F.lit(0).cast("long").alias("n_ref"))
    ref = hist.select(*keys, F.col("win").alias("prev"), "item", F.col("share").alias("q"), F.col("n").alias("n_ref")).join(order, "prev").select(
        *keys, "win", "item", F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("n_now"), "q", "n_ref")
    return now.unionByName(ref).groupBy(*keys, "win", "item").agg(*[F.sum(c).alias(c) for c in ("p", "n_now", "q", "n_ref")])


def pair_baseline(hist: DataFrame, baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each window's categories beside a fixed baseline distribution.

    A baseline item meets the windows through the list of windows of its keys, one per period: an explode, never a product
    of rows.
    """
    lists = hist.select(*keys, "win").distinct().groupBy(*keys).agg(F.collect_list("win").alias("__wins"))
    now = hist.select(*keys, "win", "item", F.col("share").alias("p"), F.col("n").alias("n_now"), F.lit(0.0).alias("q"), F.lit(0).cast("long").alias("n_ref"))
    items = baseline.select(*keys, "item", F.col("share").alias("q"), F.col("n").alias("n_ref"))
    # without keys the one list is a scalar, not a join
    items = items.join(lists, list(keys)) if keys else items.withColumn("__wins", lists.scalar())
    ref = items.withColumn("win", F.explode("__wins")).select(
        *keys, "win", "item", F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("n_now"), "q", "n_ref")
    return now.unionByName(ref).groupBy(*keys, "win", "item").agg(*[F.sum(c).alias(c) for c in ("p", "n_now", "q", "n_ref")])


def drift(paired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance (base 2), total variation, largest gap and chi-squared per group."""
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    rows = with_total(paired, keys, "n_now", "__all").withColumn("__e", q * F.col("__all"))
    chi = F.when(F.col("__e") > 0, F.pow(F.col("n_now") - F.col("__e"), F.lit(2)) / F.col("__e"))
    return rows.groupBy(*keys).agg(
        F.sqrt(F.greatest(F.lit(0.0), F.sum((part(p) + part(q)) / 2))).alias("js_distance"), (F.sum(F.abs(p - q)) / 2).alias("total_variation"),
        F.max(F.abs(p - q)).alias("l_infinity"), F.sum(chi).alias("chi_squared"), (F.count_if(F.col("__e") > 0) - 1).alias("freedom"))


@F.pandas_udf(T.DoubleType())
def chi_squared_p(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Upper tail of chi-squared by the series of the incomplete gamma function."""

    def tail(x: float, k: float) -> float:
        if not x > 0 or not k > 0:
            return 1.0
        a, z = k / 2, x / 2
        n = np.arange(1, 2000)
        terms = np.cumprod(z / (a + n))
        lower = math.exp(a * math.log(z) - z - math.lgamma(a + 1)) * (1 + terms.sum())
        return float(min(1.0, max(0.0, 1 - lower)))

    return pd.Series([tail(x, k) for x, k in zip(statistic.fillna(0), freedom.fillna(0))])


def regression_quality(rows: DataFrame, by: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """MSE, MAE and R-squared per group in one aggregate."""
    e = F.col(actual) - F.col(predicted)
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(actual) * F.count("*"))).alias("r2"))


def alerts(performance: DataFrame, drifts: DataFrame, on: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Performance beside pivoted drift; ``violations`` counts the rules that hold."""
    joined = performance.join(drifts, list(on), "left")
    hit = {f"alert_{n}": F.coalesce(F.expr(e), F.lit(False)).cast("int") for n, e in rules.items()}
    return joined.withColumns(hit).withColumn("violations", sum((F.col(c) for c in hit), F.lit(0)))
