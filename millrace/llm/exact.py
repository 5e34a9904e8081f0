"""Exact duplicates by composable polynomial fingerprints, confirmed by streaming comparison.

A text's bytes are cut into chunks. A chunk's fingerprint is the polynomial
``sum((byte + 1) * base ** (n - 1 - i))`` modulo a prime; those of neighbouring chunks combine by
``H(a + b) = H(a) * base ** len(b) + H(b)``, so chunks can be hashed apart and joined in any grouping.
Two primes and the length make the key. Equal keys prove nothing, so the texts under a shared key are
compared chunk by chunk; a key under which texts differ is split by the texts themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, with_text
from millrace.session import materialize

#: Two primes below 2**31: products of a power and a byte, summed over a chunk, stay within 64 bits.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 69_069_069)
CHUNK_BYTES = 1 << 16
KEY = ["h1", "h2", "n_bytes"]


class Polynomial:
    """Fingerprints modulo one prime, for chunks of up to ``chunk`` bytes."""

    def __init__(self, prime: int, base: int, chunk: int = CHUNK_BYTES):
        self.prime, self.base = prime, base % prime
        powers = np.empty(chunk, np.uint64)
        value = 1
        for i in range(chunk - 1, -1, -1):
            powers[i] = value
            value = value * self.base % prime
        self.powers = powers

    def of_chunk(self, data: np.ndarray) -> int:
        powers = self.powers[len(self.powers) - len(data):]
        return int((np.dot(data.astype(np.uint64), powers) + powers.sum()) % self.prime)

    def combine(self, left: int, right: int, right_bytes: int) -> int:
        """Fingerprint of a text from those of its two parts."""
        return (left * pow(self.base, right_bytes, self.prime) + right) % self.prime

    def of_text(self, data: np.ndarray) -> int:
        step, whole = len(self.powers), 0
        for at in range(0, len(data), step):
            part = data[at:at + step]
            whole = self.combine(whole, self.of_chunk(part), len(part))
        return whole


def fold_chunks(parts: Iterable[tuple[int, int]], poly: Polynomial) -> tuple[int, int]:
    """(fingerprint, length) of a text from the (fingerprint, length) of its parts in order."""
    whole, size = 0, 0
    for value, n in parts:
        whole, size = poly.combine(whole, value, n), size + n
    return whole, size


def _byte_views(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of a batch, in place."""
    col = batch.column("text")
    ends = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    for a, b in zip(ends[:-1], ends[1:]):
        yield data[a:b]


def fingerprints(documents: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """doc_id, h1, h2, n_bytes, sha (binary) of every text; null counts as empty."""

    def work(batch: pa.RecordBatch, made=[]) -> dict:
        first, second = made or [Polynomial(p, b) for p, b in zip(primes, BASES)]
        made[:] = first, second
        texts = list(_byte_views(batch))
        return {"doc_id": batch.column("doc_id"),
                "h1": pa.array([first.of_text(x) for x in texts], pa.int64()),
                "h2": pa.array([second.of_text(x) for x in texts], pa.int64()),
                "n_bytes": pa.array([len(x) for x in texts], pa.int64()),
                "sha": pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary())}

    return map_slices(with_text(documents), work, "doc_id long, h1 long, h2 long, n_bytes long, sha binary")


def _chunks(documents: DataFrame, primes: tuple[int, int]) -> DataFrame:
    """Chunks of texts under their fingerprints: h1, h2, n_bytes, no, part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = (Polynomial(p, b) for p, b in zip(primes, BASES))
        for batch in batches:
            for data in _byte_views(batch):
                key = first.of_text(data), second.of_text(data), len(data)
                parts = [data[at:at + CHUNK_BYTES].tobytes() for at in range(0, len(data), CHUNK_BYTES)]
                if parts:
                    yield pa.RecordBatch.from_pydict({
                        **{k: pa.array([v] * len(parts), pa.int64()) for k, v in zip(KEY, key)},
                        "no": pa.array(range(len(parts)), pa.int64()), "part": pa.array(parts, pa.binary())})

    return with_text(documents).mapInArrow(run, "h1 long, h2 long, n_bytes long, no long, part binary")


def exact_duplicates(documents: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256 (hex).

    Texts are equal when their bytes are; null is read as empty, and empty texts are equal. Of a group,
    the row with the largest doc_id stays (a null id is smaller than any; of repeated rows one stays).
    An empty table gives an empty result; other columns are not read.

    Keys are counted with map-side combination, so a group with a third of all rows sends one row per task.
    Only texts under a shared key are read again, and their chunks meet as a combinable minimum and
    maximum: they are equal if and only if all texts of the key are.
    """
    prints = materialize(fingerprints(documents, primes).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    groups = prints.groupBy(*KEY).agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    groups = materialize(groups, "fingerprint-groups")
    shared = groups.where((F.col("group_size") > 1) & (F.col("n_bytes") > 0))
    ids = prints.join(shared.select(*KEY), KEY, "left_semi").select("doc_id").distinct()
    again = with_text(documents).join(ids.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    parts = _chunks(again, primes).groupBy(*KEY, "no").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    mixed = materialize(parts.where(F.col("low") != F.col("high")).select(*KEY).distinct(), "mixed-fingerprints")
    columns = ["doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
               (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")]
    if mixed.isEmpty():
        return prints.join(groups, KEY).select(*columns)
    # Texts that differ under one key are told apart by themselves.
    plain = prints.join(groups.join(mixed, KEY, "left_anti"), KEY).select(*columns)
    ids = prints.join(mixed, KEY, "left_semi").select("doc_id").distinct().withColumnRenamed("doc_id", "_id")
    rest = materialize(with_text(documents).join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
                       .withColumn("row", F.monotonically_increasing_id()).withColumn("sha", F.unhex(F.sha2("text", 256))), "mixed-texts")
    rest = rest.join(prints.join(mixed, KEY, "left_semi").select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha")).distinct(),
                     F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left_semi")
    own = rest.groupBy("text").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    return plain.unionByName(rest.join(own, "text").select(*columns))


def drop_exact_duplicates(documents: DataFrame) -> DataFrame:
    """``documents`` without the rows that :func:`exact_duplicates` drops; all columns stay."""
    stay = exact_duplicates(documents).where("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    rows = documents.join(stay, F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("__kept_sha")), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"]) if _repeats(documents) else rows


def _repeats(documents: DataFrame) -> bool:
    """Whether any id occurs twice (then repeated rows must be told from the one that stays)."""
    return not documents.groupBy("doc_id").count().where("count > 1").isEmpty()
