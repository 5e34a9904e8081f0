"""Approximate neighbours by an inverted file with product-quantised residuals.

Items lie in cells around k-means centres. Inside a cell an item is a short code: its difference from the centre, cut
into sub-vectors, each replaced by the number of its nearest code word. A query reads the cells nearest to it and adds up
distances from a table of (sub-vector, code word), and the best of those are compared exactly. How many cells a query
reads is set by measuring the recall on some queries. All vectors are scaled to length one, so the order is that of cosines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sampling import top_per_group
from millrace.operators.vectors import nearest
from millrace.session import materialize

#: Centres and code words are fitted on at most so many vectors, chosen by hash; every item is coded.
FIT_ROWS = 100_000
MOST_CELLS, WORDS, ROUNDS = 4_096, 256, 5
#: Items and queries of a cell that meet in one task at once; larger cells are cut.
BLOCK_ITEMS, BLOCK_QUERIES = 20_000, 1_000
#: Candidates a query keeps for each neighbour wanted, before the exact comparison.
KEPT = 16
#: Queries on which recall is measured, and by how much it has to exceed the wanted one there.
TRIAL_QUERIES, MARGIN = 500, 0.02


def unit(column: pd.Series, dim: int) -> np.ndarray:
    m = np.array(column.tolist(), dtype=np.float64).reshape(-1, dim)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def closest(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Number of the nearest point of every row."""
    return np.argmin((points**2).sum(1) - 2 * rows @ points.T, axis=1)


def lloyd(sample: DataFrame, dim: int, start: np.ndarray, centres: np.ndarray | None = None) -> np.ndarray:
    """k-means in every sub-space at once from ``start`` (sub-spaces x points x width), each round one pass of partial sums.

    With ``centres`` the differences of vectors from their nearest centre are clustered instead of the vectors.
    """
    points = start
    parts, k, width = start.shape
    for _ in range(ROUNDS):
        sent = sample.sparkSession.sparkContext.broadcast(points)

        def add(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            sums, counts = np.zeros((parts, k, width)), np.zeros((parts, k))
            for batch in batches:
                rows = unit(batch["v"], dim)
                if centres is not None:
                    rows = rows - centres[closest(rows, centres)]
                for p in range(parts):
                    own = rows[:, p * width:(p + 1) * width]
                    near = closest(own, sent.value[p])
                    np.add.at(sums[p], near, own)
                    counts[p] += np.bincount(near, minlength=k)
            at = np.nonzero(counts)
            if len(at[0]):
                yield pd.DataFrame({"part": at[0], "point": at[1], "n": counts[at], "total": sums[at].tolist()})

        moved = sample.select("v").mapInPandas(add, "part int, point int, n double, total array<double>")
        total = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
        points = points.copy()
        for r in moved.groupBy("part", "point").agg(F.sum("n").alias("n"), *total).collect():  # parts x points rows
            points[r.part, r.point] = [r[f"t{i}"] / r.n for i in range(width)]
        sent.unpersist()
    return points


@dataclass
class VectorIndex:
    """Coded items by cell, with the centres (cells x dim) and the code words (parts x words x dim / parts)."""

    items: DataFrame  # id, cell, block, code, v
    cells: DataFrame  # cell, size
    centres: np.ndarray
    words: np.ndarray
    n: int

    @classmethod
    def build(cls, items: DataFrame, item_id: str, vector: str, dim: int, parts: int = 16, cells: int | None = None) -> VectorIndex:
        """Index every row of ``items`` (null vectors left out). ``dim`` must be a multiple of ``parts``."""
        rows = materialize(items.where(F.col(vector).isNotNull()).select(F.col(item_id).alias("id"), F.col(vector).alias("v")), "vectors")
        n = rows.count()
        # by hash, so that the sample does not follow the order of the table
        share = min(1.0, FIT_ROWS / max(1, n))
        sample = materialize(rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)), "fit-vectors")
        first = sample.orderBy(F.xxhash64("id", F.lit(1)), "id").select("v").limit(max(MOST_CELLS, WORDS)).toPandas()  # bounded
        seeds = unit(first["v"], dim) if len(first) else np.zeros((1, dim))
        k = min(len(seeds), cells or max(1, min(MOST_CELLS, round(n**0.5))))
        centres = lloyd(sample, dim, seeds[None, :k])[0]
        rest = seeds[:WORDS] - centres[closest(seeds[:WORDS], centres)]
        words = lloyd(sample, dim, np.ascontiguousarray(rest.reshape(len(rest), parts, -1).transpose(1, 0, 2)), centres)
        width = dim // parts

        def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = unit(batch["v"], dim)
                cell = closest(own, centres)
                rest = own - centres[cell]
                codes = np.stack([closest(rest[:, p * width:(p + 1) * width], words[p]) for p in range(parts)], axis=1).astype(np.uint8)
                yield batch.assign(cell=cell.astype("int32"), code=[c.tobytes() for c in codes])

        kind = rows.schema["id"].dataType.simpleString()
        coded = materialize(rows.mapInPandas(code, f"id {kind}, v {rows.schema['v'].dataType.simpleString()}, cell int, code binary"), "coded-vectors")
        sizes = materialize(coded.groupBy("cell").count().withColumnRenamed("count", "size"), "cells")
        return cls(coded, sizes, centres, words, n)

    def search(self, queries: DataFrame, query_id: str, vector: str, k: int, probes: int) -> DataFrame:
        """``query_id``, id, similarity of the ``k`` best found, and ``touched``: the items whose codes the query compared.

        A cell with many items or queries is cut into blocks of bounded size; every block of items meets every block
        of queries of its cell in one task, which sends the best of them alone. Of equal similarities the smaller id wins.
        """
        dim, parts, centres, words = self.centres.shape[1], len(self.words), self.centres, self.words
        width, kept, probes = dim // parts, KEPT * k, min(probes, len(self.centres))
        kind, key = self.items.schema["id"].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = unit(batch["v"], dim)
                far = (centres**2).sum(1) - 2 * own @ centres.T
                near = np.argpartition(far, probes - 1, axis=1)[:, :probes]
                yield pd.DataFrame({"q": np.repeat(batch["q"].to_numpy(), probes), "cell": near.ravel().astype("int32"), "qv": [v.tolist() for v in np.repeat(own, probes, axis=0)]})

        asked = queries.where(F.col(vector).isNotNull()).select(F.col(query_id).alias("q"), F.col(vector).alias("v"))
        asked = materialize(asked.mapInPandas(probe, f"q {key}, cell int, qv array<double>"), "probes")
        load = asked.groupBy("cell").count().withColumnRenamed("count", "asks").join(self.cells, "cell").select(
            "cell", F.ceil(F.col("size") / BLOCK_ITEMS).cast("int").alias("item_blocks"), F.ceil(F.col("asks") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
        load = F.broadcast(materialize(load, "loads"))  # at most MOST_CELLS rows
        others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        spread = lambda name, n: F.pmod(F.xxhash64(name, F.lit(3)), F.col(n)).cast("int")
        left = self.items.select("id", "cell", "code").join(load, "cell").select("id", "cell", "code", spread("id", "item_blocks").alias("ib"), others("query_blocks").alias("qb"))
        right = asked.join(load, "cell").select("q", "cell", "qv", spread("q", "query_blocks").alias("qb"), others("item_blocks").alias("ib"))

        def compare(items: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
            if not len(items) or not len(asks):
                return pd.DataFrame({"q": asks["q"].iloc[:0], "id": items["id"].iloc[:0], "far": pd.Series(dtype="float64"), "touched": pd.Series(dtype="int64")})
            codes = np.frombuffer(b"".join(items["code"]), np.uint8).reshape(-1, parts)
            rest = np.array(asks["qv"].tolist()) - centres[asks["cell"].iloc[0]]
            far = np.zeros((len(asks), len(items)))
            for p in range(parts):
                table = ((rest[:, None, p * width:(p + 1) * width] - words[p][None]) ** 2).sum(2)
                far += table[:, codes[:, p]]
            best = np.argpartition(far, kept - 1, axis=1)[:, :kept] if far.shape[1] > kept else np.broadcast_to(np.arange(far.shape[1]), far.shape)
            return pd.DataFrame({"q": np.repeat(asks["q"].to_numpy(), best.shape[1]), "id": items["id"].to_numpy()[best.ravel()], "far": np.take_along_axis(far, best, 1).ravel(),
                                 "touched": np.where(np.arange(best.size) % best.shape[1] == 0, len(items), 0)})

        met = left.groupBy("cell", "ib", "qb").cogroup(right.groupBy("cell", "ib", "qb")).applyInPandas(compare, f"q {key}, id {kind}, far double, touched long")
        met = materialize(met, "compared")
        touched = met.groupBy("q").agg(F.sum("touched").alias("touched"))
        chosen = top_per_group(met.select("q", "id", "far"), ["q"], [F.asc("far"), F.asc("id")], kept)

        @F.pandas_udf("double")
        def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series((unit(a, dim) * unit(b, dim)).sum(axis=1))

        vectors = self.items.select("id", F.col("v").alias("iv"))
        asked_for = queries.select(F.col(query_id).alias("q"), F.col(vector).alias("v"))
        # merged, as a broadcast would bring the vectors of all items to the driver, once a search
        exact = chosen.join(vectors.hint("merge"), "id").join(asked_for.hint("merge"), "q")
        top = top_per_group(exact.select("q", "id", cosine("v", "iv").alias("similarity")), ["q"], [F.desc("similarity"), F.asc("id")], k)
        return top.join(touched, "q").withColumnRenamed("q", query_id)

    def probes_for(self, queries: DataFrame, query_id: str, vector: str, k: int, recall: float) -> tuple[int, float]:
        """A number of cells (an eighth of all, half as many more as long as needed) at which the recall measured on a bounded trial exceeds the wanted one, and that recall."""
        trial = queries.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(query_id), query_id).limit(TRIAL_QUERIES)
        trial = materialize(trial.select(query_id, vector), "trial-queries")
        true = materialize(nearest(self.items.select("id", "v"), "id", "v", trial, query_id, vector, k).select(query_id, "id"), "trial-answers")
        wanted, probes = true.count(), max(1, len(self.centres) // 8)
        while True:
            found = self.search(trial, query_id, vector, k, probes).join(true, [query_id, "id"], "left_semi").count()
            got = found / wanted if wanted else 1.0
            if got >= min(1.0, recall + MARGIN) or probes >= len(self.centres):
                return probes, got
            probes = min(max(probes + 1, probes * 3 // 2), len(self.centres))


def recall_of(found: DataFrame, exact: DataFrame, keys: list[str]) -> float:
    """Share of the exact answer's rows that were found."""
    wanted = exact.count()
    return found.join(exact, keys, "left_semi").count() / wanted if wanted else 1.0
