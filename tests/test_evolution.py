"""Schemas that widen: laws of the least common type, one inference per file, nothing lost on reading."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import evolution

PLAIN = st.sampled_from([T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.NullType()])


def structs(inner):
    # a name always holds the same kind (plain, struct or list), so nothing is in conflict
    names = {"p": PLAIN, "q": PLAIN, "s": inner, "l": st.builds(T.ArrayType, PLAIN)}
    return st.fixed_dictionaries({}, optional=names).map(lambda d: T.StructType([T.StructField(n, t) for n, t in d.items()]))


SCHEMAS = structs(structs(structs(PLAIN.map(lambda t: T.StructType([T.StructField("x", t)])))))


def shape(t):
    """A schema without the order of its fields."""
    if isinstance(t, T.StructType):
        return tuple(sorted((f.name, shape(f.dataType)) for f in t.fields))
    return ("list", shape(t.elementType)) if isinstance(t, T.ArrayType) else t.simpleString()


@settings(max_examples=200, deadline=None)
@given(SCHEMAS, SCHEMAS, SCHEMAS)
def test_least_common_type_is_combinable(a, b, c):
    join = evolution.common_type
    assert join(a, a) == a
    assert shape(join(a, b)) == shape(join(b, a))
    assert shape(join(join(a, b), c)) == shape(join(a, join(b, c)))
    assert shape(join(join(a, b), b)) == shape(join(a, b))


def test_chain_and_conflicts(spark):
    join = evolution.common_type
    chain = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()]
    for i, low in enumerate(chain):
        for high in chain[i:]:
            assert join(low, high) == high == join(high, low)
    known = T._parse_datatype_string("a struct<x: int>, b int")
    places = []
    assert join(known, T._parse_datatype_string("a string, b struct<y: int>"), conflicts=places) == known and places == ["a", "b"]
    assert join(T.BooleanType(), T.IntegerType()) == T.StringType() and join(T.DateType(), T.TimestampType()) == T.TimestampType()


def write(spark, path, objects):
    spark.createDataFrame([(json.dumps(o),) for o in objects], "value string").coalesce(1).write.mode("append").text(path)


def test_each_file_is_inferred_once(spark, tmp_path, monkeypatch):
    src, read = f"{tmp_path}/in", []
    infer = evolution.hinted_schema
    monkeypatch.setattr(evolution, "hinted_schema", lambda s, names, *rest: read.extend(names) or infer(s, names, *rest))
    monkeypatch.setattr(evolution, "PATHS_AT_ONCE", 1)
    kept = evolution.WideningSchema(spark, f"{tmp_path}/schema", {"n": "int"})
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        kept.resolve(src)
    write(spark, src, [{"n": 1}, {"n": 2}])
    assert kept.resolve(src).simpleString() == "struct<n:int>"
    for value, wanted in ((2**40, "bigint"), (0.5, "double"), ("x", "string")):
        write(spark, src, [{"n": value}])
        with pytest.raises(evolution.SchemaWidened, match=wanted):
            kept.resolve(src)
        assert kept.resolve(src).simpleString() == f"struct<n:{wanted}>"
    write(spark, src, [{"n": 7}])  # fits already
    assert kept.resolve(src).simpleString() == "struct<n:string>"
    assert len(read) == len(set(read)) == 5
    # the list of files is lost (a crash before it was written): inferred again, nothing changes
    kept.__class__ = type("Lost", (evolution.WideningSchema,), {"seen": property(lambda self: f"{self.location}-other")})
    assert kept.resolve(src).simpleString() == "struct<n:string>" and len(read) == 10


LINES = [
    '{"id": 1, "who": {"age": 30, "home": {"zip": "01", "no": 4}}, "tags": [1, 2]}',
    '{"id": 9999999999999, "who": {"age": "old", "home": {"zip": 7, "no": "b"}}}',
    '{"id": "x", "who": "just a name", "tags": "one"}',
    '{"id": null, "who": null, "more": {"deep": [1]}, "none": null}',
    '{"id": 5, "who": {"home": "nowhere"}}', "not json", "[1, 2]", "", "{}", None,
]


def test_reading_rescues_leaf_by_leaf(spark):
    schema = T._parse_datatype_string("id int, who struct<age: int, home: struct<zip: string, no: int>>, tags array<int>")
    rows = spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1)
    got = [r.asDict(recursive=True) for r in evolution.read_widened(rows, schema).collect()]
    rescued = [None if r["_rescued_data"] is None else json.loads(r["_rescued_data"]) for r in got]
    assert got[0] == {"id": 1, "who": {"age": 30, "home": {"zip": "01", "no": 4}}, "tags": [1, 2], "_rescued_data": None}
    assert got[1]["who"] == {"age": None, "home": {"zip": "7", "no": None}} and rescued[1] == {"id": "9999999999999", "who.age": "old", "who.home.no": "b"}
    assert got[2]["who"] is None and rescued[2] == {"id": "x", "who": "just a name", "tags": "one"}
    assert rescued[3] == {"more": '{"deep":[1]}'} and got[3]["who"] is None
    assert got[4]["who"] == {"age": None, "home": None} and rescued[4] == {"who.home": "nowhere"}
    assert rescued[5:8] == [{"_line": x} for x in LINES[5:8]] and rescued[8] is None and rescued[9] is None
    assert evolution.read_widened(rows.where("value IS NULL AND value = ''"), schema).count() == 0


def test_reading_all_fields_of_the_widened_schema_rescues_nothing(spark, tmp_path):
    src, kept = f"{tmp_path}/in", evolution.WideningSchema(spark, f"{tmp_path}/schema")
    write(spark, src, [{"a": 1, "s": {"x": 1}}])
    kept.resolve(src)
    write(spark, src, [{"a": 1.5, "s": {"x": "t", "y": [1]}}, {"b": True}])
    with pytest.raises(evolution.SchemaWidened):
        kept.resolve(src)
    rows = evolution.read_widened(spark.read.text(src), kept.resolve(src))
    assert rows.where(F.col("_rescued_data").isNotNull()).isEmpty() and rows.count() == 3
    assert {(r.a, r.s.x if r.s else None, r.b) for r in rows.collect()} == {(1.0, "1", None), (1.5, "t", None), (None, None, True)}
