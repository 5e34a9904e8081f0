import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text as tx
from millrace.functions.columns import flatten, mask_tail
from millrace.operators import monitor, policy, vectors
from millrace.sources import files, fixtures
from millrace.sources.copying import fingerprint


def test_rescue_keeps_everything(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.IntegerType())])
    lines = spark.createDataFrame([('{"id": 1, "age": 30}',), ('{"id": "x", "age": 5, "more": {"a": 1}}',), ("not json",), ('{"age": null, "id": 7}',)], "value string")
    got = [tuple(r) for r in files.rescue_json(lines, schema).collect()]
    assert got[0] == (1, 30, None) and got[3] == (7, None, None) and got[2] == (None, None, '{"_line":"not json"}')
    assert got[1][:2] == (None, 5) and '"id":"x"' in got[1][2] and "more" in got[1][2]


def test_hints_and_formats(spark, tmp_path):
    p = f"{tmp_path}/users"
    spark.createDataFrame([(0, "007"), (5, "12")], "id long, code string").coalesce(1).write.option("header", "true").csv(p)
    assert files.sniff_format(spark, p) == "csv"
    got = files.read_files(spark, p, hints={"code": "string", "extra": "double"})
    assert got.schema.simpleString() == "struct<id:int,code:string,extra:double>" and got.where("code = '007'").count() == 1
    with pytest.raises(FileNotFoundError):
        files.sniff_format(spark, f"{tmp_path}/nothing")


def test_schema_evolution_stops_once(spark, tmp_path):
    src, kept = f"{tmp_path}/in", files.EvolvingSchema(spark, f"{tmp_path}/schema", {"id": "long"})
    spark.createDataFrame([(1,)], "id long").write.json(src)
    assert kept.resolve(src, "json").names == ["id"]
    spark.createDataFrame([(2, "x")], "id long, name string").write.mode("append").json(src)
    with pytest.raises(files.UnknownColumns, match="name"):
        kept.resolve(src, "json")
    assert kept.resolve(src, "json").names == ["id", "name"]


def test_copy_into_loads_once(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.range(5).write.parquet(src)
    assert files.copy_into(spark, src, out, "parquet", "id long") > 0
    assert files.copy_into(spark, src, out, "parquet", "id long") == 0
    spark.range(5, 8).write.mode("append").parquet(src)
    files.copy_into(spark, src, out, "parquet", "id long")
    # an uncommitted load (a crash before the log) stays invisible
    spark.range(100, 101).write.parquet(f"{out}/load=crashed")
    assert sorted(r["id"] for r in files.loaded(spark, out).collect()) == list(range(8))


def test_export_by_key_splits(spark, tmp_path):
    df = spark.range(200).withColumn("k", F.when(F.col("id") % 10 == 0, "b").otherwise("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny parts would be joined again
    manifest = files.export_by_key(df, "k", f"{tmp_path}/x", "csv", files_per_key=3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {(r["key"], r["sum(rows)"]) for r in manifest.groupBy("key").sum("rows").collect()}
    assert got == {("a", 180), ("b", 20)} and manifest.where("key = 'a'").count() > 1


def test_images(spark, tmp_path):
    for label in ("cat", "dog"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "1.img").write_bytes(bytes([1, 2, 3]))
    rows = files.image_rows(spark, str(tmp_path), "*.img")
    out = files.transform_images(rows, lambda: lambda content: content[::-1])
    assert {(r["label"], bytes(r["content"])) for r in out.collect()} == {("cat", b"\x03\x02\x01"), ("dog", b"\x03\x02\x01")}


def test_kafka_shape(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b'{"a":1}'))], "key binary, value binary")
    assert files.key_value(df).first().asDict() == {"key": "k", "value": '{"a":1}'}


def test_fixtures_are_stable(spark):
    cols = {"kind": fixtures.pick(F.col("id"), "kind", ["a", "b", "c"]), "x": fixtures.number(F.col("id"), "x", 5, 6)}
    a, b = fixtures.generate(spark, 500, cols), fixtures.generate(spark, 500, cols).repartition(7)
    assert fingerprint(a).first() == fingerprint(b).first()
    assert a.select("kind").distinct().count() == 3 and a.where("x < 5 OR x >= 6").isEmpty()
    assert fingerprint(a).first() != fingerprint(a.limit(499)).first()


def test_policies(spark):
    df = spark.createDataFrame([(1, "ann@x.org", "fr"), (2, "bob", "de")], "id long, mail string, country string")
    tagged = policy.tag(df, {"mail": {"pii": "mail"}})
    assert policy.tagged_columns(tagged, "pii") == ["mail"]
    masked = policy.apply_tag_masks(tagged, {("pii", "mail"): mask_tail}, ["analysts"], ["stewards"])
    assert [r["mail"] for r in masked.orderBy("id").collect()] == ["*****.org", "bob"]
    assert policy.apply_tag_masks(tagged, {("pii", "mail"): mask_tail}, ["stewards"], ["stewards"]).first()["mail"] == "ann@x.org"
    assert policy.RowFilter("country = 'fr'", ["admins"]).apply(df, ["admins"]).count() == 2
    assert policy.filter_by_mapping(df, spark.createDataFrame([("g", ["fr", "fr"]), ("g", ["fr"])], "member_of string, values array<string>"), ["g"], "country").count() == 1


def test_flatten(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1), 'd', 2) AS a, 3 AS e")
    assert flatten(df).first().asDict() == {"a_b_c": 1, "a_d": 2, "e": 3}


def chunks_by_hand(words, size, overlap):
    out, i = [], 0
    while True:
        out.append(" ".join(words[i:i + size]))
        if i + size >= len(words):
            return out
        i += size - overlap


def test_word_chunks_against_loop(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 9, 10, 11, 16, 17, 50)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["c"] for r in df.select(tx.word_chunks(F.col("t"), 10, 4).alias("c")).collect()]
    assert got == [chunks_by_hand(t.split(), 10, 4) for t in texts]


def test_section_chunks_cover_the_page(spark):
    html = "<h1>Top words here</h1>" + "".join(f"<p>{' '.join(f'p{i}w{j}' for j in range(n))}</p>" for i, n in enumerate((3, 4, 30, 2, 12))) + "<script>no()</script>"
    got = spark.createDataFrame([(html,)], "h string").select(tx.section_chunks(F.col("h"), 12, 1).alias("c")).first()["c"]
    text = spark.createDataFrame([(html,)], "h string").select(tx.strip_markup(F.col("h")).alias("t")).first()["t"]
    assert " ".join(got).split() == text.split() and max(len(c.split()) for c in got) <= 12 and "no()" not in text
    short = spark.createDataFrame([(html,)], "h string").select(tx.section_chunks(F.col("h"), 12, 5).alias("c")).first()["c"]
    assert [c for c in got if len(c.split()) >= 5] == short


def test_nearest_against_numpy(spark):
    import numpy as np

    m = np.random.default_rng(3).standard_normal((300, 8))
    items = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<double>")
    asks = items.where("id < 5").select(F.col("id").alias("q"), F.col("v").alias("qv"))
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = unit[:5] @ unit.T
    want = {(q, int(i)) for q in range(5) for i in np.argsort(-sims[q])[:7]}
    got = {(r["q"], r["id"]) for r in vectors.nearest(items, "id", "v", asks, "q", "qv", 7).collect()}
    assert got == want
    approx = {(r["q"], r["id"]) for r in vectors.nearest_approx(items, "id", "v", asks.withColumnRenamed("qv", "v"), "q", 7, 8, tables=12, bits=4).collect()}
    assert len(approx & want) >= 0.9 * len(want)


def test_index_keeps_its_recall_at_the_bits_of_large_tables(spark):
    import numpy as np

    for items in (500, 10**6, 17 * 10**6, 10**9):
        bits = vectors.index_bits(items)
        tables, radius = vectors.index_shape(bits)
        assert 1 - (1 - vectors.table_chance(bits, radius)) ** tables >= vectors.RECALL and tables <= vectors.MOST_TABLES
    rng = np.random.default_rng(5)
    unit = lambda m: m / np.linalg.norm(m, axis=-1, keepdims=True)
    asks = unit(rng.standard_normal((3, 64)))
    # around each query 300 items of cosine 0.71 to 0.8
    cos = rng.uniform(0.71, 0.8, (3, 300, 1))
    off = rng.standard_normal((3, 300, 64))
    off = unit(off - (off * asks[:, None]).sum(-1, keepdims=True) * asks[:, None])
    m = (cos * asks[:, None] + np.sqrt(1 - cos**2) * off).reshape(-1, 64)
    items = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<double>")
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(asks)], "q long, v array<double>")
    sims = asks @ unit(m).T
    want = {(q, int(i)) for q in range(3) for i in np.argsort(-sims[q])[:10]}
    got = {(r["q"], r["id"]) for r in vectors.nearest_approx(items, "id", "v", queries, "q", 10, 64, bits=vectors.index_bits(10**9)).collect()}
    assert len(got) == 30 and len(got & want) >= 0.9 * len(want)


def test_chi_squared_tail(spark):
    df = spark.createDataFrame([(3.841458820694124, 1.0), (11.070497693516351, 5.0), (0.0, 3.0)], "x double, k double")
    p = [r["p"] for r in df.select(monitor.chi_squared_p("x", "k").alias("p")).collect()]
    assert p[0] == pytest.approx(0.05, abs=1e-6) and p[1] == pytest.approx(0.05, abs=1e-6) and p[2] == 1.0


def test_copy_into_odd_file_names(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    names = ["a b.json", "100%.json", "ü+x[1].json", "c.json", "{y}*.json", "p%20q.json"]
    for i, name in enumerate(names):
        (source / name).write_text(f'{{"id": {i}}}\n')
    from millrace.sources.files import copy_into, loaded

    assert copy_into(spark, str(source), target, "json", "id int") == len(names)
    assert sorted(r.id for r in loaded(spark, target).collect()) == list(range(len(names)))
    assert copy_into(spark, str(source), target, "json", "id int") == 0
    (source / "new one.json").write_text('{"id": 99}\n')
    for name in names:  # old files are not opened again
        (source / name).write_text('{"id": -1}\n')
    assert copy_into(spark, str(source), target, "json", "id int") == 1
    assert sorted(r.id for r in loaded(spark, target).collect()) == [*range(len(names)), 99]
    assert loaded(spark, target).columns == ["id"]
