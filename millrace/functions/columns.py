"""Small column helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Expand every struct column into ``parent<sep>child`` columns, at all depths."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        out = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                out += [F.col(f"`{f.name}`.`{c.name}`").alias(f"{f.name}{sep}{c.name}") for c in f.dataType.fields]
            else:
                out.append(F.col(f"`{f.name}`"))
        df = df.select(*out)
    return df


def cyclical(unit: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a cyclic unit (hour of 24, weekday of 7, day of 31)."""
    angle = unit.cast("double") * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """Stable bucket 0..buckets-1 of a key: same key and salt, same bucket, on any engine.

    The first 15 hex digits of md5 fit a long; md5 is used so SQL twins agree.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(buckets))


def mask_tail(value: Column, keep: int = 4, fill: str = "*") -> Column:
    """Keep the last characters, replace the rest."""
    kept = F.least(F.length(value), F.lit(keep))
    return F.concat(F.repeat(F.lit(fill), F.length(value) - kept), F.right(value, kept))
