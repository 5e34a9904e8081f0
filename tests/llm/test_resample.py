"""Importance resampling against a plain count of every text."""

import collections
import hashlib
import math
import re
import zlib

from millrace.llm import resample
from tests.llm.conftest import SCHEMA

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in [*words, *map(" ".join, zip(words, words[1:]))]]


def plain(rows, target, percent=25, least=20):
    cut = [(i, *plain_features(t)) for i, t in rows]
    s, t = (collections.Counter(b for fs in some for b in fs) for some in ([c[2] for c in cut], [plain_features(x)[1] for x in target]))
    n_s, n_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in s}
    made = []
    for i, n, fs in cut:
        weight = sum(gain[b] for b in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        made.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((m for m in made if m[5] >= least), key=lambda m: (-m[3], m[0] is not None, m[0]))
    for k, m in enumerate(able[:percent * len(able) // 100]):
        m[4] = k + 1
    return sorted((m[:5] for m in made), key=str)


def check(spark, df, target, **settings):
    made = resample.importance_scores(df, spark.createDataFrame([(t,) for t in target], "text string"), **settings)
    got = sorted(([r.doc_id, r.n_features, r.weight, r.score, r["rank"]] for r in made.collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], target, settings.get("percent", 25), settings.get("least_words", 20))


def test_odd_documents(spark, odd):
    check(spark, odd, ["some words of the text", None, "", "W1X1 w2x2"], percent=60, least_words=1)


def test_no_documents_and_no_target(spark, odd, none):
    check(spark, none, ["a b"])
    check(spark, odd, [])


def test_repeated_lines_and_bridges(spark, table, monkeypatch):
    lines = ["The Same line here", "", "other words", "  ", "ünï codé 漢字", "x", "the same LINE here"]
    rows = [(i, "\n".join(lines[(i * j + j) % 7] for j in range(i % 11)), "a") for i in range(120)]
    for one_in in (2, 20, 1000):  # lines that are hot, or not
        monkeypatch.setattr(resample, "HOT_ONE_IN", one_in)
        check(spark, table(rows), ["the same line here x", "words other"], percent=40, least_words=5)


def test_a_distinct_line_is_counted_once(spark, table):
    lines = resample.distinct_lines(table([(i, "One line\nanother\nONE, line", "a") for i in range(50)]).select("text"))
    assert sorted((r.times, r.texts, len(r.buckets) // 2) for r in lines.collect()) == [(50, 50, 1), (100, 50, 3)]


def test_drawn_rows_keep_their_columns(spark, odd):
    target = spark.createDataFrame([("a plain text",)], "text string")
    drawn = resample.resample(odd, target, percent=50, least_words=1)
    assert set(drawn.columns) == {*odd.columns, "rank"} and drawn.count() == odd.where("text is not null and trim(text) <> '' and trim(text) <> '\t\n\n'").count() // 2
    assert drawn.schema["doc_id"] == spark.createDataFrame([], SCHEMA).schema["doc_id"]
