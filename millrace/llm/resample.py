"""Resampling documents towards a target distribution, with the features of every distinct line counted once.

Features are runs of one or two words, hashed to buckets. Newlines separate words, so a text falls into lines whose
features depend on the line alone: equal lines are brought together, their features are counted once and multiplied by
how often they occur. Two-word runs that cross a line's end are counted apart, as bridges.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, raw_texts, with_text
from millrace.operators.ordered import global_numbers
from millrace.session import materialize

BUCKETS = 10_000
#: A line in more than one of so many (document, line) pairs is hot; there are fewer of them than this.
HOT_ONE_IN = 1_000
#: Bytes of no word become blanks, line ends stay, A-Z becomes a-z; other bytes of UTF-8 belong to words.
TABLE = bytes(b if b == 10 or 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def word_lines(text: bytes) -> list[list[bytes]]:
    """Words of every line that has any."""
    return [words for words in map(bytes.split, text.translate(TABLE).split(b"\n")) if words]


def line_buckets(words: list[bytes]) -> np.ndarray:
    """Buckets of the words and of the pairs inside one line."""
    ones = [zlib.crc32(w) for w in words]
    # a checksum can be carried on, so a pair needs only its second word
    twos = [zlib.crc32(b" " + w, c) for w, c in zip(words[1:], ones)]
    return (np.array(ones + twos, dtype=np.int64) % BUCKETS).astype(np.uint16)


def bridge_buckets(lines: list[list[bytes]]) -> np.ndarray:
    """Buckets of the pairs made of a line's last and the next line's first word."""
    return np.array([zlib.crc32(a[-1] + b" " + b[0]) % BUCKETS for a, b in zip(lines, lines[1:])], dtype=np.uint16)


def cut_documents(documents: DataFrame, row: str) -> DataFrame:
    """Per document: row, doc_id, n_words, its distinct lines (digest, times) and its bridges."""

    def cut(batch: pa.RecordBatch) -> dict:
        n_words, keys, times, bridges = [], [], [], []
        for text in raw_texts(batch):
            lines = word_lines(text)
            seen = Counter(sha256(b" ".join(words)).digest() for words in lines)
            n_words.append(sum(map(len, lines)))
            keys.append(list(seen))
            times.append(list(seen.values()))
            bridges.append(bridge_buckets(lines).tobytes())
        return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "keys": pa.array(keys, pa.list_(pa.binary())),
                "times": pa.array(times, pa.list_(pa.int64())), "bridges": pa.array(bridges, pa.binary())}

    kind = documents.schema["doc_id"].dataType.simpleString()
    given = documents.select(F.col(row).alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_slices(given, cut, f"row long, doc_id {kind}, n_words long, keys array<binary>, times array<long>, bridges binary")


def distinct_lines(texts: DataFrame) -> DataFrame:
    """Every distinct line once: key, times (occurrences), texts (how many have it) and the buckets of its features."""

    def lines_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [(line, n) for text in raw_texts(batch) for line, n in Counter(map(b" ".join, word_lines(text))).items()]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int64())], ["line", "times"])

    def features(batch: pa.RecordBatch) -> dict:
        lines = batch.column("line").to_pylist()
        return {"key": pa.array([sha256(x).digest() for x in lines], pa.binary()), "times": batch.column("times"), "texts": batch.column("texts"),
                "buckets": pa.array([line_buckets(x.split()).tobytes() for x in lines], pa.binary())}

    found = map_slices(texts, lines_of, "line binary, times long").groupBy("line").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("texts"))
    return map_slices(found, features, "key binary, times long, texts long, buckets binary")


def bucket_totals(features: DataFrame) -> DataFrame:
    """bucket, n: features per bucket from (buckets, times), one vector of bounded size for each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            packed = batch.column("buckets").to_pylist()
            times = np.repeat(batch.column("times").to_numpy(zero_copy_only=False), [len(p) // 2 for p in packed])
            np.add.at(total, np.frombuffer(b"".join(packed), dtype=np.uint16), times)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": full, "n": total[full]})

    return features.select("buckets", "times").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def all_features(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Features of distinct lines times their occurrences, and the bridges."""
    return lines.select("buckets", "times").unionByName(documents.select(F.col("bridges").alias("buckets"), F.lit(1).cast("long").alias("times")))


def gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight: 1000 times the log of the smoothed shares' ratio, floored."""
    spark = source.sparkSession
    both = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    both = materialize(both.select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t")), "bucket-totals")
    n_source, n_target = both.agg(F.sum("s"), F.sum("t")).first()
    ratio = (F.col("t") + 1) * F.lit(n_source + BUCKETS) / ((F.col("s") + 1) * F.lit(n_target + BUCKETS))
    found = np.zeros(BUCKETS, dtype=np.int64)
    for r in both.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain")).collect():  # BUCKETS rows
        found[r.bucket] = r.gain
    return found


def summed_gains(features: DataFrame, gain: np.ndarray, kept: list[str]) -> DataFrame:
    """The ``kept`` columns with gain and n_features, summed over the buckets of a row."""

    def add(batch: pa.RecordBatch) -> dict:
        packed = batch.column("buckets").to_pylist()
        ends = np.cumsum([0, *[len(p) // 2 for p in packed]])
        upto = np.concatenate([[0], np.cumsum(gain[np.frombuffer(b"".join(packed), dtype=np.uint16)])]).astype(np.int64)
        return {c: batch.column(c) for c in kept} | {"gain": upto[ends[1:]] - upto[ends[:-1]], "n_features": np.diff(ends)}

    schema = ", ".join(f"{c} {features.schema[c].dataType.simpleString()}" for c in kept)
    return map_slices(features.select(*kept, "buckets"), add, f"{schema}, gain long, n_features long")


def importance_scores(documents: DataFrame, target: DataFrame, *, percent: int = 25, least_words: int = 20, seed: int = 7, row: str | None = None) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document, and ``row``.

    ``weight`` is the floored mean gain of the document's features towards ``target`` (0 without any); ``score`` adds
    noise made from a hash of the id (Gumbel, in thousandths), so that the highest scores are a sample weighted by
    importance. Of documents with ``least_words`` words or more the highest ``percent`` are drawn and ranked from 1.

    Null and empty texts have no features and are never drawn; a null id hashes as the word null; repeated rows are
    scored and ranked one by one; of equal scores the smaller id goes first (null ids before all). Long texts count
    whole. Empty tables give no rows; an empty target gives all buckets smoothed counts. Other columns are left behind.
    ``row`` names a column that tells rows apart; without it rows are numbered here.

    Lines are shuffled once, by content, after counting inside each task. Their sums meet the documents by digest;
    lines in more than one of ``HOT_ONE_IN`` places are few and joined by broadcast, so no task gets all places of one.
    """
    spark = documents.sparkSession
    rows = documents if row else documents.select("doc_id", "text", F.monotonically_increasing_id().alias("__row"))
    docs = materialize(cut_documents(rows, row or "__row"), "cut-documents")  # numbers are kept from here on
    lines = materialize(distinct_lines(with_text(documents).select("text")), "distinct-lines")
    wanted = target.select(F.lit(0).cast("long").alias("__row"), F.lit(0).alias("doc_id"), "text")
    aimed = all_features(distinct_lines(with_text(wanted).select("text")), cut_documents(wanted, "__row"))
    gain = gains(bucket_totals(all_features(lines, docs)), bucket_totals(aimed))

    scored = materialize(summed_gains(lines, gain, ["key", "texts"]), "line-gains")
    places = scored.agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
    hot = F.col("texts") * HOT_ONE_IN > places
    inside = docs.select("row", "doc_id", F.explode(F.arrays_zip("keys", "times")).alias("line")).select("row", "doc_id", F.col("line.keys").alias("key"), F.col("line.times").alias("times"))
    often = F.broadcast(scored.where(hot).drop("texts"))  # fewer than HOT_ONE_IN rows
    found = inside.join(often, "key").unionByName(inside.join(often, "key", "left_anti").join(scored.where(~hot).drop("texts"), "key"))
    found = found.select("row", "doc_id", F.lit(0).cast("long").alias("n_words"), (F.col("gain") * F.col("times")).alias("gain"), (F.col("n_features") * F.col("times")).alias("n_features"))
    bridges = summed_gains(docs.withColumnRenamed("bridges", "buckets"), gain, ["row", "doc_id", "n_words"])  # one row for each document
    sums = found.unionByName(bridges).groupBy("row", "doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("gain").alias("gain"), F.sum("n_features").alias("n_features"))

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    weight = F.when(F.col("n_features") > 0, F.floor(F.col("gain") / F.col("n_features"))).otherwise(F.lit(0)).cast("long")
    whole = sums.select("row", "doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + F.floor(-1000 * F.ln(-F.ln(uniform))))
    whole = materialize(whole.withColumn("__down", -F.col("score")), "importance")
    able = F.col("n_words") >= least_words
    quota = percent * whole.where(able).count() // 100
    ranked = global_numbers(whole.where(able), ["__down", "doc_id", "row"], "rank").withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    every = ranked.unionByName(whole.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return every.select("doc_id", "n_features", "weight", "score", "rank", F.col("row").alias(row or "row"))


def resample(documents: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``documents`` with all their columns (``rank`` replaced), as :func:`importance_scores` ranks them."""
    rows = materialize(documents.drop("rank").withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")
    ranks = importance_scores(rows, target, row="__row", **settings).where("rank IS NOT NULL").select("__row", "rank")
    return rows.join(ranks, "__row").drop("__row")


# Plain SQL for the same rows; the checksum is the usual table-driven one over UTF-8 bytes.
ORACLE_SQL = r"""
WITH RECURSIVE steps AS (SELECT range AS b, range AS c, 0 AS k FROM range(256) UNION ALL
 SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
split AS (SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
feats AS MATERIALIZED (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM split),
sums AS (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(1, octet_length(encode(f)) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT f FROM feats), tab),
placed AS MATERIALIZED (SELECT side, r, bucket FROM feats JOIN sums USING (f)),
n AS (SELECT count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 'b')::DOUBLE AS t FROM placed),
per AS (SELECT bucket, count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 'b')::DOUBLE AS t FROM placed GROUP BY 1),
gain AS (SELECT bucket, floor(1000 * ln(((per.t + 1) * (n.s + 10000)) / ((per.s + 1) * (n.t + 10000)))) AS g FROM per, n),
mean AS (SELECT r, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY 1),
scored AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM split LEFT JOIN mean USING (r) WHERE side = 'd'),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS quota FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= quota THEN place END AS rank FROM scored LEFT JOIN ranked USING (r)"""
