"""Row filters, masks and tag policies as DataFrame rewrites.

The caller's groups are an explicit argument; nothing is read from the session.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import rebalanced


@dataclass(frozen=True)
class RowFilter:
    """Rows satisfy ``predicate`` unless the reader is in one of ``exempt`` groups."""

    predicate: str
    exempt: Collection[str] = ()

    def apply(self, df: DataFrame, groups: Collection[str]) -> DataFrame:
        return df if set(groups) & set(self.exempt) else df.where(F.expr(self.predicate))


@dataclass(frozen=True)
class ColumnMask:
    """``column`` is replaced by ``mask(column)`` unless the reader is in one of ``exempt`` groups."""

    column: str
    mask: Callable[[Column], Column]
    exempt: Collection[str] = ()

    def apply(self, df: DataFrame, groups: Collection[str]) -> DataFrame:
        if set(groups) & set(self.exempt):
            return df
        kind = df.schema[self.column].dataType
        return df.withColumn(self.column, self.mask(F.col(self.column)).cast(kind))


def filter_by_mapping(df: DataFrame, mapping: DataFrame, groups: Collection[str], column: str,
                      group_col: str = "member_of", values_col: str = "values") -> DataFrame:
    """Rows whose ``column`` is listed for one of the reader's groups in a mapping table."""
    allowed = (
        mapping.where(F.col(group_col).isin(list(groups))).select(F.explode(values_col).alias("__v")).distinct()
    )
    return df.join(allowed, F.col(column) == F.col("__v"), "left_semi")


def pseudonymise(df: DataFrame, permissions: DataFrame, reader: str, country_col: str, columns: Sequence[str]) -> DataFrame:
    """The reader's countries only; personal columns hashed where their permission says so.

    ``permissions(reader, country, gdpr)``: one row per reader and country.
    """
    mine = permissions.where(F.col("reader") == reader).groupBy("country").agg(F.max("gdpr").alias("__gdpr"))
    joined = df.join(mine, F.col(country_col) == F.col("country"))
    hashed = {c: F.when(F.col("__gdpr") == 1, F.sha1(F.col(c).cast("string"))).otherwise(F.col(c).cast("string")) for c in columns}
    return joined.withColumns(hashed).select(*df.columns)


def tag(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach tags to columns; they travel in the schema's metadata."""
    return df.select(*[
        F.col(f.name).alias(f.name, metadata={**(f.metadata or {}), "tags": dict(tags[f.name])}) if f.name in tags else F.col(f.name)
        for f in df.schema.fields])


def tagged_columns(df: DataFrame, key: str, value: str | None = None) -> list[str]:
    out = []
    for f in df.schema.fields:
        tags = (f.metadata or {}).get("tags", {})
        if key in tags and (value is None or tags[key] == value):
            out.append(f.name)
    return out


def apply_tag_masks(df: DataFrame, masks: Mapping[tuple[str, str], Callable[[Column], Column]], groups: Collection[str],
                    exempt: Collection[str] = ()) -> DataFrame:
    """Mask every column carrying one of the (key, value) tags."""
    for (key, value), mask in masks.items():
        for name in tagged_columns(df, key, value):
            df = ColumnMask(name, mask, exempt).apply(df, groups)
    return df


def seal(df: DataFrame, columns: Sequence[str], secret: Column, can_read: bool) -> DataFrame:
    """Columns encrypted for readers without the right to see them (random nonce per value)."""
    if can_read:
        return df
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string"), secret, F.lit("GCM"))) for c in columns})


def unseal(df: DataFrame, columns: Sequence[str], secret: Column) -> DataFrame:
    return df.withColumns({c: F.aes_decrypt(F.unbase64(F.col(c)), secret, F.lit("GCM")).cast("string") for c in columns})


def export_slices(df: DataFrame, grants: DataFrame, column: str, path: str) -> None:
    """One folder per recipient holding only the rows granted to it.

    ``grants(recipient, value)``. A big recipient is split over tasks by the rebalance.
    """
    rows = df.join(grants, F.col(column) == F.col("value")).drop("value")
    rebalanced(rows, "recipient").write.partitionBy("recipient").parquet(path)
