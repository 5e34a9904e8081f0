"""Copying tables and proving the copies equal."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent hash of all rows (one combinable aggregate)."""
    h = F.xxhash64(*sorted(df.columns))
    # two moments of the hash in decimals: equal multisets agree, and sums cannot overflow
    low, high = F.pmod(h, F.lit(1 << 31)).cast("decimal(38,0)"), F.shiftright(h, 31).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(low).alias("h1"), F.sum(high).alias("h2"))


def copy_and_verify(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Copy every table to ``root`` and report rows and equality per table."""
    out = None
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
        a = fingerprint(df).select(F.lit(name).alias("name"), "n", "h1", "h2")
        b = fingerprint(spark.read.parquet(f"{root}/{name}")).select(F.lit(name).alias("name"), F.col("n").alias("m"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
        same = F.col("n").eqNullSafe(F.col("m")) & F.col("h1").eqNullSafe(F.col("g1")) & F.col("h2").eqNullSafe(F.col("g2"))
        one = a.join(b, "name").select("name", "n", same.cast("int").alias("same"))
        out = one if out is None else out.unionByName(one)
    return out
