"""Versioned tables over plain parquet folders.

A version is a set of folders listed in an append-only manifest; writing data never touches
older versions, so readers of any version are safe. Keyed tables are laid out in hash buckets
and a merge rewrites only the buckets that hold changed keys. One writer per table at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import rebalanced

#: Rows that one file of a compacted table gets at most, about.
MOST_FILE_ROWS = 1_000_000
MANIFEST = "version long, bucket int, path string, operation string, rows long, written_at timestamp, batch string"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (), buckets: int = 1):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.buckets = list(keys), buckets if keys else 1

    # -- manifest ---------------------------------------------------------------------
    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def manifest(self) -> DataFrame:
        if not self._exists(f"{self.root}/_manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest")

    def history(self) -> DataFrame:
        return self.manifest().groupBy("version").agg(
            F.max("operation").alias("operation"), F.sum("rows").alias("rows"),
            F.max("written_at").alias("written_at"), F.max("batch").alias("batch"))

    def latest(self) -> int:
        top = self.manifest().agg(F.max("version")).first()[0]
        return -1 if top is None else top

    def version_at(self, when: dt.datetime) -> int:
        top = self.manifest().where(F.col("written_at") <= F.lit(when)).agg(F.max("version")).first()[0]
        if top is None:
            raise ValueError(f"no version at {when}")
        return top

    def done(self, batch: str) -> bool:
        return not self.manifest().where(F.col("batch") == batch).isEmpty()

    def _files(self, version: int) -> dict[int, str]:
        """Folder per bucket; the manifest has one row per bucket and version."""
        rows = self.manifest().where(F.col("version") == version).select("bucket", "path").collect()
        return {r["bucket"]: r["path"] for r in rows}

    def _commit(self, files: dict[int, str], operation: str, rows: dict[int, int], batch: str) -> int:
        version = self.latest() + 1
        now = dt.datetime.now(dt.timezone.utc)
        lines = [(version, b, p, operation, rows.get(b, 0), now, batch) for b, p in files.items()]
        self.spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")
        return version

    # -- reading ----------------------------------------------------------------------
    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        files = self._files(version)
        if not files:
            raise ValueError(f"{self.root} has no version {version}")
        schema = self.spark.read.parquet(f"{self.root}/_schema/v={self._schema_version(version)}").schema
        paths = [p for b, p in files.items() if p and b >= 0 and (buckets is None or b in buckets)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def changed_buckets(self, old: int | None, new: int) -> list[int]:
        before = {} if old is None else self._files(old)
        after = self._files(new)
        return [b for b in {*before, *after} if b >= 0 and before.get(b) != after.get(b)]

    def _schema_version(self, version: int) -> int:
        folders = self._fs(f"{self.root}/_schema")
        names = [s.getPath().getName() for s in folders[0].listStatus(folders[1])]
        return max(v for v in (int(n.split("=")[1]) for n in names if n.startswith("v=")) if v <= version)

    # -- writing ----------------------------------------------------------------------
    def bucket_of(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.keys else F.lit(0)

    def _write(self, df: DataFrame, clustered: Callable[[DataFrame], DataFrame] | None) -> tuple[dict[int, str], dict[int, int]]:
        """Write data folders; return folder and row count per bucket."""
        base = f"{self.root}/data/{uuid.uuid4().hex}"
        if self.buckets == 1:
            seen = Observation()
            out = df.observe(seen, F.count(F.lit(1)).alias("n"))
            (clustered(out) if clustered else out).write.parquet(base)
            return {0: base}, {0: seen.get["n"]}
        tagged = df.withColumn("__bucket", self.bucket_of())
        tagged = clustered(tagged) if clustered else rebalanced(tagged, "__bucket")
        tagged.write.partitionBy("__bucket").parquet(base)
        counts = self.spark.read.parquet(base).groupBy("__bucket").count().collect() if self._has_data(base) else []
        rows = {r["__bucket"]: r["count"] for r in counts}
        return {b: f"{base}/__bucket={b}" for b in rows}, rows

    def _has_data(self, base: str) -> bool:
        fs, p = self._fs(base)
        return any(s.getPath().getName().startswith("__bucket=") for s in fs.listStatus(p))

    def publish(self, df: DataFrame, operation: str = "write", batch: str = "",
                clustered: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Write all rows as the next version; a batch already published is skipped."""
        if batch and self.done(batch):
            return self.latest()
        files, rows = self._write(df, clustered)
        return self._finish(df, files, rows, operation, batch)

    def _finish(self, df, files, rows, operation, batch) -> int:
        version = self.latest() + 1
        self.spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{self.root}/_schema/v={version}")
        # bucket -1 keeps an empty version visible
        return self._commit(files or {-1: ""}, operation, rows, batch)

    def rewrite(self, changes: DataFrame, make: Callable[[DataFrame, DataFrame], DataFrame],
                operation: str = "merge", batch: str = "") -> int:
        """Next version from ``make(old_rows, changes)``, touching only buckets with changes."""
        if batch and self.done(batch):
            return self.latest()
        current = self.latest()
        if current < 0:
            raise ValueError("publish a first version before rewriting")
        # at most ``buckets`` values
        touched = [r[0] for r in changes.select(self.bucket_of()).distinct().collect()]
        files = self._files(current)
        new = make(self.read(current, touched), changes)
        new_files, new_rows = self._write(new, None)
        old_rows = {r["bucket"]: r["rows"] for r in self.manifest().where(F.col("version") == current).collect()}
        merged = {b: p for b, p in files.items() if b not in touched and b >= 0} | new_files
        counts = {b: n for b, n in old_rows.items() if b in merged} | new_rows
        return self._finish(new, merged, counts, operation, batch)

    def append(self, df: DataFrame, batch: str = "") -> int:
        """Next version = old folders plus new ones (unkeyed tables)."""
        if batch and self.done(batch):
            return self.latest()
        current = self.latest()
        files, rows = self._write(df, None)
        if current >= 0:
            old = self._files(current)
            start = max(old, default=-1) + 1
            counts = {r["bucket"]: r["rows"] for r in self.manifest().where(F.col("version") == current).collect()}
            files = {**{b: p for b, p in old.items() if b >= 0}, **{start + b: p for b, p in files.items()}}
            rows = {**counts, **{start + b: n for b, n in rows.items()}}
        return self._finish(df, files, rows, "append", batch)

    def restore(self, version: int) -> int:
        files = {b: p for b, p in self._files(version).items() if b >= 0}
        rows = {r["bucket"]: r["rows"] for r in self.manifest().where(F.col("version") == version).collect()}
        return self._finish(self.read(version), files, rows, f"restore {version}", "")

    def clone(self, root: str, version: int | None = None, deep: bool = True) -> VersionedTable:
        version = self.latest() if version is None else version
        other = VersionedTable(self.spark, root, self.keys, self.buckets)
        source = self.read(version)
        if deep:
            other.publish(source, f"deep clone of {version}")
        else:
            files = {b: p for b, p in self._files(version).items() if b >= 0}
            rows = {r["bucket"]: r["rows"] for r in self.manifest().where(F.col("version") == version).collect()}
            other._finish(source, files, rows, f"shallow clone of {version}", "")
        return other

    def compact(self, by: Sequence[str], files: int) -> int:
        """Fewer, range-clustered files: min/max statistics then prune scans on ``by``.

        There are ``files`` of them, or more where one would get over MOST_FILE_ROWS rows, as a task sorts the rows of its file.
        """
        rows = self.manifest().where(F.col("version") == self.latest()).agg(F.sum("rows")).first()[0] or 0
        parts = max(files, -(-rows // MOST_FILE_ROWS))
        sort = lambda df: df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
        return self.publish(self.read(), "compact", clustered=sort)

    def vacuum(self, older_than: dt.datetime) -> int:
        """Delete folders used only by versions written before the moment (never the latest).

        Only folders under this table are deleted: shallow clones do not own their files.
        """
        latest = self.latest()
        m = self.manifest().where("bucket >= 0")
        keep = (F.col("version") == latest) | (F.col("written_at") >= F.lit(older_than))
        stale = m.groupBy("path").agg(F.bool_or(keep).alias("used")).where(~F.col("used")).select("path")
        removed = 0
        for row in stale.toLocalIterator():
            if row["path"].startswith(f"{self.root}/data/"):
                fs, p = self._fs(row["path"])
                removed += bool(fs.delete(p, True))
        return removed


def morton_key(columns: Sequence[tuple[str, float, float]], bits: int = 16):
    """Interleaved-bit key of several numeric columns, given their (low, high) ranges.

    Sorting by it clusters on all columns at once.
    """
    cells = []
    for name, low, high in columns:
        cell = F.floor((F.col(name).cast("double") - low) / (high - low) * ((1 << bits) - 1)).cast("long")
        cells.append(F.greatest(F.lit(0), F.least(cell, F.lit((1 << bits) - 1))))
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(cells) + i))
    return key
