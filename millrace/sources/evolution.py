"""Schemas that widen with a folder of JSON lines: least common types, conflicts kept in the rescue column."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import PATHS_AT_ONCE, RESCUED, EvolvingSchema, exactly, hadoop_fs, hinted_schema

#: Numbers from narrow to wide; a pair takes the wider one.
_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]


class SchemaWidened(RuntimeError):
    """New fields or wider types arrived; the widened schema is saved and a restart adopts it."""


def common_type(known: T.DataType, found: T.DataType, at: str = "", conflicts: list[str] | None = None) -> T.DataType:
    """The least type that holds values of both; for plain types it does not matter in which order many are combined.

    Numbers widen (whole ones above 2**53 lose digits as doubles), dates become timestamps, other different plain types become text, structs combine by
    field, arrays by item. Plain against nested is a conflict: the known type stays, the place is added to
    ``conflicts``, and values of the other kind go to the rescue column when read.
    """
    if known == found or isinstance(found, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return found
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        there = {f.name: f.dataType for f in found.fields}
        fields = [T.StructField(f.name, common_type(f.dataType, there.pop(f.name, f.dataType), f"{at}.{f.name}".lstrip("."), conflicts)) for f in known.fields]
        return T.StructType(fields + [T.StructField(n, t) for n, t in there.items()])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(common_type(known.elementType, found.elementType, f"{at}[]", conflicts))
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in (known, found)):
        if conflicts is not None:
            conflicts.append(at)
        return known
    if known in _NUMBERS and found in _NUMBERS:
        return max(known, found, key=_NUMBERS.index)
    if {type(known), type(found)} <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType()
    return T.StringType()


class WideningSchema(EvolvingSchema):
    """Schema of a growing folder of JSON lines; each file is inferred once, when it is new.

    Beside the schema versions lies the list of files that took part in one. It is written after the
    version, so a crash between the two infers those files again, which changes nothing.
    """

    @property
    def seen(self) -> str:
        return f"{self.location}-files"

    def _new_files(self, path: str) -> Iterator[str]:
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
        fs, p = hadoop_fs(self.spark, self.seen)
        if fs.exists(p):
            listing = listing.join(self.spark.read.schema("path string").parquet(self.seen), "path", "left_anti")
        return (r.path for r in listing.toLocalIterator())

    def resolve(self, path: str, format: str = "json", **options) -> T.StructType:
        """Schema to read with; raises :class:`SchemaWidened` after saving a wider one (not for the first)."""
        if format != "json":
            raise ValueError("types widen over JSON lines only")
        first = known = self.current()
        files = self._new_files(path)
        conflicts: list[str] = []
        while names := list(islice(files, PATHS_AT_ONCE)):
            found = hinted_schema(self.spark, [exactly(n) for n in names], format, self.hints if known is None else {}, options)
            wider = found if known is None else common_type(known, found, conflicts=conflicts)
            if wider != known:
                self.save(wider)
                known = wider
            self.spark.createDataFrame([(n,) for n in names], "path string").write.mode("append").parquet(self.seen)
        if known is None:
            raise FileNotFoundError(path)
        if first is not None and known != first:
            raise SchemaWidened(f"{first.simpleString()} became {known.simpleString()}")
        return known


def _quoted(name: str) -> str:
    if "'" in name:
        raise ValueError(f"a field name with a quote: {name}")
    return f"['{name}']"


def read_widened(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text as the schema's columns and ``_rescued_data``: text of every field that does not fit, by its dotted place.

    Struct fields are taken one by one, so one bad leaf leaves its neighbours. Fields that the schema does not have
    are rescued at the top level. A line that is no JSON object is kept whole under ``_line``; null lines stay null.
    """
    rows = lines.withColumn("__v", F.try_parse_json(F.col(column)))
    misfits: list[Column] = []

    def rescue(place: str, text: Column, lost: Column) -> None:
        misfits.append(F.when(lost, F.struct(F.lit(place).alias("key"), text.alias("value"))))

    def take(kind: T.DataType, path: str, place: str) -> Column:
        here = F.try_variant_get("__v", path, "variant")
        text = F.try_variant_get("__v", path, "string")
        given = here.isNotNull() & ~F.is_variant_null(here)
        if isinstance(kind, T.StructType):
            rescue(place, text, given & ~F.schema_of_variant(here).startswith("OBJECT"))
            inner = F.struct(*[take(f.dataType, path + _quoted(f.name), f"{place}.{f.name}").alias(f.name) for f in kind.fields])
            return F.when(given & F.schema_of_variant(here).startswith("OBJECT"), inner)
        value = F.try_variant_get("__v", path, kind.simpleString())
        rescue(place, text, given & value.isNull())
        return value

    columns = [take(f.dataType, "$" + _quoted(f.name), f.name).alias(f.name) for f in schema.fields]
    raw = F.from_json(F.col(column), "map<string,string>")
    known = F.array(*[F.lit(n) for n in schema.names]).cast("array<string>")
    stray = F.map_filter(raw, lambda k, v: v.isNotNull() & ~F.array_contains(known, k))
    lost = F.map_from_entries(F.filter(F.array(*misfits), lambda m: m.isNotNull())) if misfits else F.create_map().cast("map<string,string>")
    kept = F.map_concat(lost, stray)
    is_object = F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False))
    rescued = F.when(F.col(column).isNull(), None).when(~is_object, F.to_json(F.struct(F.col(column).alias("_line")))).when(F.size(kept) > 0, F.to_json(kept))
    return rows.select(*columns, rescued.alias(RESCUED))
