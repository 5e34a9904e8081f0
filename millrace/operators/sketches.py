"""Profiles over several granularities: one sketch per finest window and slice, merged upward.

Rows are read once. What leaves the first aggregate is one row per finest window and combination of
slice values (slices are columns with few values); counts, extremes, a quantile sketch and a distinct
sketch of such rows merge, so days, weeks and months, whole or sliced, come from that small table, and
so does the profile of old and new rows together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch; ranks are then off by less than half a percent with a chance of 0.99.
QUANTILE_SIZE = 1000
#: Logarithm of a distinct sketch's cells; its standard error is 0.8 percent.
DISTINCT_BITS = 14

_NESTED = {"hour": ("hour", "day", "week", "month", "quarter", "year"), "day": ("day", "week", "month", "quarter", "year"), "week": ("week",),
           "month": ("month", "quarter", "year"), "quarter": ("quarter", "year"), "year": ("year",)}


def fine_profile(df: DataFrame, at: str, numeric: Sequence[str], other: Sequence[str] = (), slices: Mapping[str, str] = {}, finest: str = "hour") -> DataFrame:
    """One row of mergeable facts per finest window and combination of slice values.

    ``numeric`` columns get extremes, sums and quantile sketches, all columns get null counts and
    distinct sketches. Null times form a window of their own; an empty table gives no rows.
    """
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate([*numeric, *other]):
        aggs += [F.count(F.col(c)).alias(f"filled_{i}"), F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(c)), DISTINCT_BITS).alias(f"distinct_{i}")]
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"), F.sum(x).alias(f"sum_{i}"), F.kll_sketch_agg_double(x, QUANTILE_SIZE).alias(f"quantiles_{i}")]
    keys = [F.expr(e).cast("string").alias(f"slice_{i}") for i, e in enumerate(slices.values())]
    return df.groupBy(F.date_trunc(finest, F.col(at)).alias("win"), *keys).agg(*aggs)


def merged_profile(fine: DataFrame, numeric: Sequence[str], other: Sequence[str] = (), slices: Sequence[str] = (), grains: Sequence[str] = ("day", "week", "month"),
                   marks: Sequence[float] = (0.25, 0.5, 0.75), finest: str = "hour") -> DataFrame:
    """Profile per granularity, window, slice and column from rows of :func:`fine_profile` (or a union of several).

    ``slice_key`` is null for whole windows. ``quantiles`` holds one estimate per mark; it, the extremes
    and the mean are null for columns without numbers.
    """
    stray = [g for g in grains if g not in _NESTED[finest]]
    if stray:
        raise ValueError(f"{stray} cannot be built from windows of one {finest}")
    spread = fine.withColumn("g", F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "win").alias("win")) for g in grains])))
    names = [f"slice_{i}" for i in range(len(slices))]
    spread = spread.select("g.grain", F.col("g.win").alias("win"), *[c for c in fine.columns if c != "win"])
    sets = [[F.col("grain"), F.col("win"), *[F.col(n) for n in level]] for level in ([], *[[n] for n in names])]
    aggs = [F.sum("rows").alias("rows")]
    for i in range(len(numeric) + len(other)):
        aggs += [F.sum(f"filled_{i}").alias(f"filled_{i}"), F.hll_union_agg(f"distinct_{i}").alias(f"distinct_{i}")]
    for i in range(len(numeric)):
        aggs += [F.min(f"min_{i}").alias(f"min_{i}"), F.max(f"max_{i}").alias(f"max_{i}"), F.sum(f"sum_{i}").alias(f"sum_{i}"), F.kll_merge_agg_double(f"quantiles_{i}", QUANTILE_SIZE).alias(f"quantiles_{i}")]
    flags = [F.grouping(n).alias(f"whole_{n}") for n in names]
    wide = spread.groupingSets(sets, F.col("grain"), F.col("win"), *[F.col(n) for n in names]).agg(*flags, *aggs)
    key = value = F.lit(None).cast("string")
    for n, title in zip(names, slices):
        key = F.when(F.col(f"whole_{n}") == 0, title).otherwise(key)
        value = F.when(F.col(f"whole_{n}") == 0, F.col(n)).otherwise(value)
    lines = F.array(*[_line(i, c, i < len(numeric), marks) for i, c in enumerate([*numeric, *other])])
    return wide.select("grain", "win", key.alias("slice_key"), value.alias("slice_value"), "rows", F.explode(lines).alias("c")).select("grain", "win", "slice_key", "slice_value", "rows", "c.*")


def _line(i: int, column: str, is_number: bool, marks: Sequence[float]) -> Column:
    none = F.lit(None).cast("double")
    pick = lambda c: F.col(c) if is_number else none
    filled = F.col(f"filled_{i}")
    quantiles = F.lit(None).cast("array<double>")
    if is_number:
        # a sketch that saw no number has no quantiles
        quantiles = F.when(F.kll_sketch_get_n_double(f"quantiles_{i}") > 0, F.kll_sketch_get_quantile_double(f"quantiles_{i}", F.array(*[F.lit(float(m)) for m in marks])))
    return F.struct(
        F.lit(column).alias("column_name"), (F.col("rows") - filled).alias("nulls"), pick(f"min_{i}").alias("min"), pick(f"max_{i}").alias("max"),
        (pick(f"sum_{i}") / F.nullif(filled, F.lit(0))).alias("mean"), quantiles.alias("quantiles"), F.hll_sketch_estimate(f"distinct_{i}").alias("distinct_about"))


def levels(df: DataFrame, at: str, slices: Mapping[str, str], grains: Sequence[str]) -> DataFrame:
    """Every row once per granularity and slice, with the keys of :func:`merged_profile` (whole windows: ``*``), to check a profile exactly."""
    wins = F.array(*[F.struct(F.lit(g).alias("grain"), F.date_trunc(g, F.col(at)).alias("win")) for g in grains])
    parts = F.array(F.struct(F.lit("*").alias("slice_key"), F.lit("*").alias("slice_value")),
                    *[F.struct(F.lit(k).alias("slice_key"), F.coalesce(F.expr(e).cast("string"), F.lit("-")).alias("slice_value")) for k, e in slices.items()])
    return df.withColumn("__w", F.explode(wins)).withColumn("__s", F.explode(parts)).select("*", "__w.*", "__s.*").drop("__w", "__s")


def ranks_near(rows: DataFrame, keys: Sequence[str], value: str, guesses: DataFrame, marks: Sequence[float], error: float) -> DataFrame:
    """Per key whether each guessed quantile lies at its mark in the exact order, give or take ``error`` of the rows.

    The values under and up to each guess are counted by one combinable aggregate.
    """
    met = rows.where(F.col(value).isNotNull()).join(guesses, list(keys))
    counts = []
    for i in range(len(marks)):
        guess = F.col("quantiles")[i]
        counts += [F.count_if(F.col(value) < guess).alias(f"__under{i}"), F.count_if(F.col(value) <= guess).alias(f"__upto{i}")]
    n = F.col("__n")
    fits = [(F.col(f"__under{i}") <= (F.lit(m) + error) * n) & (F.col(f"__upto{i}") >= (F.lit(m) - error) * n) for i, m in enumerate(marks)]
    every = fits[0]
    for fit in fits[1:]:
        every = every & fit
    return met.groupBy(*keys).agg(F.count("*").alias("__n"), *counts).select(*keys, every.alias("near"))
