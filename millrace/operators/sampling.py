"""Top-n per group and repeatable samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import hash_bucket


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key.

    Spark pushes the row-number limit below the shuffle (WindowGroupLimit): every map task
    sends at most ``n`` rows per key, so a hot key cannot flood one task. The pushdown covers
    ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default); beyond that, the first ``n``
    of each part of a key are picked before the parts meet.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        part = Window.partitionBy(*keys, "__part").orderBy(*order)
        df = df.withColumn("__part", F.spark_partition_id()).withColumn("__rn", F.row_number().over(part)).where(F.col("__rn") <= n).drop("__rn", "__part")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def sample_share(df: DataFrame, key: Column, share: float, seed: str) -> DataFrame:
    """Keep about ``share`` of the rows by hash of their key: repeatable on any layout.

    ``DataFrame.sample`` depends on how rows are laid out in files; a key hash does not.
    """
    return df.where(hash_bucket(key, 1_000_000, seed) < int(share * 1_000_000))
