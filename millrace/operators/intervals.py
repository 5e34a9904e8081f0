"""Sessions and merged intervals per key, by running maxima instead of self joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups


def number_sessions(df: DataFrame, keys: Sequence[str], at: str, tiebreak: Sequence[str], gap_seconds: int,
                    name: str = "session_no") -> DataFrame:
    """Number sessions per key; a distance above the gap opens a new one (equal stays)."""
    gap = gap_seconds * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    seen = OrderedGroups(df, keys, [at, *tiebreak]).lag({"__last": at})
    opens = F.when(F.col("__last").isNull() | (micros(at) - micros("__last") > gap), 1).otherwise(0)
    out = seen.with_columns({"__open": opens}).running({name: ("sum", F.col("__open"))})
    return out.result().drop("__last", "__open")


def pack_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, aggs: Sequence[Column] = (),
                   slack: Column | None = None) -> DataFrame:
    """Merge overlapping or touching ``[start, end]`` rows into maximal spans.

    A row opens a span when it starts after the largest end before it (plus ``slack``).
    Three windows on one sort; the final aggregate combines map-side, so long spans are fine.
    """
    groups = OrderedGroups(df, keys, [start, end]).running_before({"__reach": ("max", F.col(end))})
    limit = F.col("__reach") if slack is None else F.col("__reach") + slack
    opens = F.when(F.col("__reach").isNull() | (F.col(start) > limit), 1).otherwise(0)
    marked = groups.with_columns({"__open": opens}).running({"__span": ("sum", F.col("__open"))}).result()
    return (
        marked.groupBy(*keys, "__span")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("merged"), *aggs)
        .drop("__span")
    )
