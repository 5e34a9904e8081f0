"""Deterministic rows for fixtures, derived from a row number by hashing (same on any layout)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(row: Column, salt: str, choices: Sequence) -> Column:
    """One of ``choices`` by the hash of the row number and a salt."""
    spot = F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(len(choices)))
    return F.array(*[F.lit(c) for c in choices])[spot.cast("int")]


def number(row: Column, salt: str, low: float, high: float) -> Column:
    unit = F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(1_000_003)) / 1_000_003.0
    return F.lit(low) + unit * (high - low)


def generate(spark: SparkSession, rows: int, columns: Mapping[str, Column]) -> DataFrame:
    """``rows`` rows with an ``id`` and the given columns, which may use ``F.col("id")``."""
    return spark.range(rows).withColumns(dict(columns))
