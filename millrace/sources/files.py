"""Reading files of any supported format: hints, rescued fields, evolving schemas, incremental loads."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import work_dir

# File extension to reader format.
FORMATS = {".json": "json", ".jsonl": "json", ".csv": "csv", ".tsv": "csv", ".parquet": "parquet", ".orc": "orc", ".txt": "text", ".avro": "avro"}
RESCUED = "_rescued_data"


def hadoop_fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stream_location(spark: SparkSession, path: str) -> tuple[str, dict[str, str]]:
    """Folder and glob of a stream source; a single file is followed through its folder."""
    fs, p = hadoop_fs(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        return p.getParent().toString(), {"pathGlobFilter": p.getName()}
    return path, {}


def sniff_format(spark: SparkSession, path: str) -> str:
    """Format from the extension of the first data file under a path or glob."""
    fs, p = hadoop_fs(spark, path)
    found = fs.globStatus(p)
    stack = list(found) if found else []
    while stack:
        status = stack.pop(0)
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            stack = list(fs.listStatus(status.getPath())) + stack
            continue
        for compression in (".gz", ".bz2", ".zst", ".snappy"):
            name = name.removesuffix(compression)
        ext = os.path.splitext(name)[1]
        if ext in FORMATS:
            return FORMATS[ext]
        raise ValueError(f"unknown file type {name}")
    raise FileNotFoundError(path)


def read_files(spark: SparkSession, path: str, format: str = "auto", schema: T.StructType | str | None = None,
               hints: Mapping[str, str] | None = None, glob: str | None = None, metadata: Sequence[str] = (), **options) -> DataFrame:
    """Scan files; ``hints`` overrides some inferred types, ``metadata`` adds file columns.

    Partition folders become columns. ``metadata`` may name ``file_path``, ``file_name``,
    ``file_size`` and ``file_modification_time``.
    """
    kind = sniff_format(spark, path) if format == "auto" else format
    if kind == "csv":
        options = {"header": "true", **options}
    if glob:
        options["pathGlobFilter"] = glob
    if schema is None and kind in ("csv", "json"):
        schema = hinted_schema(spark, path, kind, hints or {}, options)
    reader = spark.read.format(kind).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    if hints and kind not in ("csv", "json"):
        df = df.withColumns({c: F.col(c).cast(t) for c, t in hints.items()})
    return df.withColumns({f"_{m}": F.col(f"_metadata.{m}") for m in metadata}) if metadata else df


def hinted_schema(spark: SparkSession, path: str | list[str], format: str, hints: Mapping[str, str], options: Mapping[str, str]) -> T.StructType:
    """Inferred schema with hinted columns replaced (and missing hinted columns added)."""
    opts = {**options, **({"inferSchema": "true"} if format == "csv" else {})}
    found = spark.read.format(format).options(**opts).load(path).schema
    typed = {n: T._parse_datatype_string(t) for n, t in hints.items()}
    fields = [T.StructField(f.name, typed.get(f.name, f.dataType), True) for f in found.fields]
    fields += [T.StructField(n, t, True) for n, t in typed.items() if n not in found.names]
    return T.StructType(fields)


def rescue_json(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse JSON text into ``schema``; everything that does not fit is kept in ``_rescued_data``.

    Unknown fields and values of the wrong type go to a JSON object of strings; a line that is
    not a JSON object is kept whole under ``_line``.
    """
    v = F.try_parse_json(F.col(column))
    raw = F.from_json(F.col(column), "map<string,string>")
    typed = {f.name: F.try_variant_get(v, f"$.{f.name}", f.dataType.simpleString()) for f in schema.fields}
    parsed = lines.withColumns({**{n: c for n, c in typed.items()}, "__raw": raw})
    known = F.create_map(*[x for f in schema.fields for x in (F.lit(f.name), F.col(f.name).isNotNull())])
    misfit = F.map_filter("__raw", lambda k, val: val.isNotNull() & ~F.coalesce(F.try_element_at(known, k), F.lit(False)))
    whole = F.to_json(F.struct(F.col(column).alias("_line")))
    rescued = F.when(F.col("__raw").isNull(), whole).when(F.size(misfit) > 0, F.to_json(misfit))
    return parsed.withColumn(RESCUED, rescued).select(*[f.name for f in schema.fields], RESCUED)


class UnknownColumns(RuntimeError):
    """New columns arrived; the widened schema is saved and a restart adopts it."""


class EvolvingSchema:
    """Schema of a growing folder, kept as JSON versions beside the data."""

    def __init__(self, spark: SparkSession, location: str, hints: Mapping[str, str] | None = None):
        self.spark, self.location, self.hints = spark, location.rstrip("/"), dict(hints or {})

    def current(self) -> T.StructType | None:
        fs, p = hadoop_fs(self.spark, self.location)
        if not fs.exists(p):
            return None
        saved = self.spark.read.schema("version int, schema string").parquet(self.location)
        top = saved.agg(F.max_by("schema", "version").alias("s")).first()["s"]
        return None if top is None else T.StructType.fromJson(json.loads(top))

    def save(self, schema: T.StructType) -> None:
        fs, p = hadoop_fs(self.spark, self.location)
        version = 0
        if fs.exists(p):
            version = self.spark.read.schema("version int, schema string").parquet(self.location).agg(F.max("version")).first()[0] + 1
        self.spark.createDataFrame([(version, schema.json())], "version int, schema string").coalesce(1).write.mode("append").parquet(self.location)

    def resolve(self, path: str, format: str, **options) -> T.StructType:
        """Schema to read with; raises :class:`UnknownColumns` after saving a widened one."""
        found = hinted_schema(self.spark, path, format, self.hints, options)
        known = self.current()
        if known is None:
            self.save(found)
            return found
        new = [f for f in found.fields if f.name not in known.names]
        if new:
            self.save(T.StructType([*known.fields, *new]))
            raise UnknownColumns(", ".join(f.name for f in new))
        return known


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, format: str, schema: T.StructType | str,
           max_files: int | None = None, partition_by: Sequence[str] = (), extra: Mapping[str, Column] | None = None,
           keep_path: bool = False, **options) -> None:
    """Append files not seen before to a parquet folder, each exactly once, then stop.

    The stream's checkpoint remembers what was read; ``max_files`` bounds one micro-batch.
    """
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    source, only = stream_location(spark, source)
    df = spark.readStream.format(format).schema(schema).options(**options, **only).load(source)
    if keep_path:
        df = df.withColumn("_file_path", F.col("_metadata.file_path"))
    df = df.withColumns(dict(extra)) if extra else df
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start().awaitTermination()


def ingest_many(spark: SparkSession, specs: Mapping[str, Mapping], target_root: str, checkpoint_root: str) -> dict[str, str]:
    """The same flow for several sources, one checkpoint each; returns the target folders."""
    out = {}
    for name, spec in specs.items():
        ingest(spark, target=f"{target_root}/{name}", checkpoint=f"{checkpoint_root}/{name}", **spec)
        out[name] = f"{target_root}/{name}"
    return out


LOADED = "path string, load string"


def plain_path(column: str) -> Column:
    """Local paths appear with one or three slashes after the scheme; make them equal."""
    return F.regexp_replace(column, "^file:/+", "/")


def decoded_path(column: str) -> Column:
    """The plain path behind ``_metadata.file_path``, which is URL-encoded but for plus signs."""
    return plain_path(F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B"))))


#: File names that one reader call is given.
PATHS_AT_ONCE = 10_000


def exactly(path: str) -> str:
    """A path that readers take as it is, not as a pattern."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def copy_into(spark: SparkSession, source: str, target: str, format: str, schema: T.StructType | str, **options) -> int:
    """Append files whose path was not loaded before; safe to run again. Returns the files loaded.

    The list of new paths is saved first, then the rows, and last the load is committed to the
    log. Readers (:func:`loaded`) only see committed loads, so a crash leaves nothing half done.
    """
    picked = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")}
    # only paths are selected, so file contents are not read here
    listing = spark.read.format("binaryFile").options(**picked).load(source).select("path")
    log, load = f"{target}/_loaded", os.path.basename(work_dir(spark, "load"))
    fs, p = hadoop_fs(spark, log)
    if fs.exists(p):
        listing = listing.join(spark.read.schema(LOADED).parquet(log), "path", "left_anti")
    pending = f"{target}/_pending/{load}"
    listing.withColumn("load", F.lit(load)).write.parquet(pending)
    fresh = spark.read.schema(LOADED).parquet(pending)
    names = [r.path for r in fresh.select("path").toLocalIterator()]  # the files of one load
    for at in range(0, len(names), PATHS_AT_ONCE):
        # only new files are opened, whatever was loaded before
        rows = spark.read.format(format).schema(schema).options(**options).load([exactly(n) for n in names[at:at + PATHS_AT_ONCE]])
        rows = rows.withColumn("__path", decoded_path("_metadata.file_path"))
        rows.write.mode("append").parquet(f"{target}/load={load}")
    if names:
        found = spark.read.parquet(f"{target}/load={load}").select("__path").distinct()
        strange = found.join(fresh.select(plain_path("path").alias("__path")), "__path", "left_anti").count()
        if strange:
            raise ValueError(f"{strange} files were read that are not in the load")
        fresh.write.mode("append").parquet(log)
    return len(names)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """Rows of committed loads."""
    committed = spark.read.schema(LOADED).parquet(f"{target}/_loaded").select("load").distinct()
    return spark.read.parquet(target).join(committed, "load", "left_semi").drop("load", "__path")


def export_by_key(df: DataFrame, key: str, path: str, format: str = "json", files_per_key: int = 1) -> DataFrame:
    """One folder per key value; returns a manifest of (key, file, rows).

    Rows are spread by key and by their own hash, so ``files_per_key`` > 1 splits a hot key.
    """
    spread = [F.col(key)] if files_per_key == 1 else [F.col(key), F.pmod(F.xxhash64(*df.columns), F.lit(files_per_key))]
    df.withColumn("__key", F.col(key)).repartition(*spread).write.partitionBy("__key").format(format).option("header", "true").save(path)
    back = df.sparkSession.read.format(format).schema(df.schema).option("header", "true").load(path)
    return back.groupBy(F.col(key).cast("string").alias("key"), F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Kafka topic as string key and value (needs Spark's Kafka connector on the class path)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return key_value(reader.load())


def key_value(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


def image_rows(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Binary files with a label taken from the parent folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content", F.element_at(F.split("path", "/"), -2).alias("label"))


def transform_images(images: DataFrame, make) -> DataFrame:
    """Decode, change and encode image bytes; ``make()`` runs once per task and returns bytes → bytes."""

    def run(batches):
        change = make()
        for b in batches:
            b["content"] = b["content"].map(change)
            yield b

    return images.mapInPandas(run, images.schema)
