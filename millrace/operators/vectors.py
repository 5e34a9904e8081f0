"""Nearest neighbours: exact by batched products, approximate by random hyperplanes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sampling import top_per_group
from millrace.session import materialize

#: Query vectors that one pass over the items compares; more queries take more passes.
QUERIES_AT_ONCE = 10_000
#: Rows times queries of one product, which bounds its memory.
PRODUCT_CELLS = 4_000_000


def query_blocks(queries: DataFrame, key: str, vector: str) -> Iterator[tuple[list, np.ndarray]]:
    """Query keys and unit vectors, a bounded block at a time on the driver."""
    held: list = []

    def block() -> tuple[list, np.ndarray]:
        m = np.array([r[1] for r in held], dtype="float64")
        return [r[0] for r in held], m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

    for row in queries.select(key, vector).orderBy(key).toLocalIterator():
        held.append(row)
        if len(held) == QUERIES_AT_ONCE:
            yield block()
            held = []
    if held:
        yield block()


def nearest(items: DataFrame, item_id: str, vector: str, queries: DataFrame, query_id: str, query_vector: str, k: int) -> DataFrame:
    """Exact ``k`` most similar items (cosine) per query; of equal ones the smaller ids.

    Queries go to the tasks in blocks of bounded size. A task keeps the best ``k`` per query over all of its
    items and sends them once, at its end; batches are cut so that no product exceeds ``PRODUCT_CELLS``.
    """
    schema = T.StructType([T.StructField(query_id, queries.schema[query_id].dataType), T.StructField(item_id, items.schema[item_id].dataType),
                           T.StructField("similarity", T.DoubleType())])

    def search(keys: list, matrix: np.ndarray) -> DataFrame:
        step = max(1, PRODUCT_CELLS // len(keys))

        def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, sims = None, np.full((len(keys), 0), -np.inf)
            for b in batches:
                for at in range(0, len(b), step):
                    part = b.iloc[at:at + step]
                    v = np.stack(part[vector].to_numpy()).astype("float64")
                    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                    new = np.broadcast_to(part[item_id].to_numpy(), (len(keys), len(part)))
                    ids = new if ids is None else np.concatenate([ids, new], 1)
                    sims = np.concatenate([sims, matrix @ v.T], 1)
                    if sims.shape[1] > k:
                        # all ties of the k-th value stay until ids decide
                        edge = -np.partition(-sims, k - 1, axis=1)[:, k - 1:k]
                        keep = max(k, int((sims >= edge).sum(1).max()))
                        if keep < sims.shape[1]:
                            top = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
                            ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
            if ids is not None:
                order = np.lexsort((ids, -sims), axis=1)[:, :k]
                ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
                yield pd.DataFrame({query_id: np.repeat(np.array(keys), ids.shape[1]), item_id: ids.ravel(), "similarity": sims.ravel()})

        return items.select(item_id, vector).mapInPandas(best, schema)

    found = [search(*block) for block in query_blocks(queries, query_id, query_vector)]
    if not found:
        return items.sparkSession.createDataFrame([], schema)
    scored = found[0]
    for more in found[1:]:
        scored = scored.unionByName(more)
    return top_per_group(scored, [query_id], [F.desc("similarity"), F.asc(item_id)], k)


def hyperplanes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def signatures(df: DataFrame, vector: str, dim: int, tables: int = 8, bits: int = 12, seed: int = 7) -> DataFrame:
    """One row per (row, table) with the sign pattern of the vector as ``bucket``: the index."""
    planes = hyperplanes(dim, tables, bits, seed)
    powers = 1 << np.arange(bits)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def sign_codes(v: pd.Series) -> pd.Series:
        m = np.stack(v.to_numpy()).astype("float64")
        codes = ((np.einsum("tbd,nd->ntb", planes, m) > 0) * powers).sum(axis=2).astype("int32")
        return pd.Series(list(codes))

    return df.select("*", F.posexplode(sign_codes(vector)).alias("table", "bucket"))


#: Items that a bucket of the index should hold on average.
BUCKET_ITEMS = 64


def index_bits(items: int) -> int:
    """Bits of a sign pattern so that buckets keep their size however many items there are."""
    return min(30, max(3, round(math.log2(max(1, items) / BUCKET_ITEMS))))


#: Chance with which a neighbour of at least this similarity is a candidate; tables of the index at most.
RECALL, SIMILARITY, MOST_TABLES = 0.99, 0.7, 32


def table_chance(bits: int, radius: int, similarity: float = SIMILARITY) -> float:
    """Chance that the sign patterns of a pair of this cosine differ in at most ``radius`` of ``bits`` places."""
    differ = math.acos(similarity) / math.pi
    return sum(math.comb(bits, r) * differ**r * (1 - differ) ** (bits - r) for r in range(radius + 1))


def index_shape(bits: int, recall: float = RECALL, similarity: float = SIMILARITY, tables: int | None = None) -> tuple[int, int]:
    """Tables and probe radius that find a pair of this cosine with the chance ``recall``.

    The hyperplanes of a pair's tables are independent. The least radius is taken that needs no more than ``tables``
    (kept if given) or MOST_TABLES.
    """
    for radius in range(bits):
        chance = table_chance(bits, radius, similarity)
        needed = 1 if chance >= recall else math.ceil(math.log(1 - recall) / math.log(1 - chance))
        if needed <= (tables or MOST_TABLES):
            return tables or needed, radius
    return tables or 1, bits


def nearest_approx(items: DataFrame, item_id: str, vector: str, queries: DataFrame, query_id: str, k: int, dim: int,
                   tables: int | None = None, bits: int | None = None, seed: int = 7, recall: float = RECALL, similarity: float = SIMILARITY) -> DataFrame:
    """Approximate neighbours: rescore exactly the items sharing a bucket with the query, ``k`` for each query.

    ``bits`` follows the number of items unless given; tables and the number of bits that a probed bucket may be away follow
    from ``bits``, so that an item of cosine ``similarity`` or more is found with the chance ``recall`` at any size. Only ids and
    bucket numbers meet in the join, which splits hot buckets; vectors join the distinct pairs afterwards. Queries
    that find fewer than ``k`` items of that cosine have neighbours for which the index is not set, and are searched exactly.
    """
    bits = bits or index_bits(items.count())
    tables, radius = index_shape(bits, recall, similarity, tables)
    q = signatures(queries.select(F.col(query_id), F.col(vector).alias("qv")), "qv", dim, tables, bits, seed).drop("qv")
    masks = [(sum(1 << b for b in at),) for r in range(radius + 1) for at in combinations(range(bits), r)]
    flips = items.sparkSession.createDataFrame(masks, "flip int")
    probes = q.crossJoin(F.broadcast(flips)).withColumn("bucket", F.col("bucket").bitwiseXOR(F.col("flip"))).drop("flip")
    index = signatures(items.select(item_id, F.col(vector).alias("iv")), "iv", dim, tables, bits, seed).drop("iv")
    pairs = index.join(probes, ["table", "bucket"]).select(query_id, item_id).distinct()
    pairs = pairs.join(items.select(item_id, F.col(vector).alias("iv")), item_id).join(queries.select(query_id, F.col(vector).alias("qv")), query_id)

    @F.pandas_udf(T.DoubleType())
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = np.stack(a.to_numpy()).astype("float64"), np.stack(b.to_numpy()).astype("float64")
        return pd.Series((x * y).sum(axis=1) / np.maximum(np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1), 1e-300))

    scored = pairs.select(query_id, item_id, cosine("qv", "iv").alias("similarity"))
    top = materialize(top_per_group(scored, [query_id], [F.desc("similarity"), F.asc(item_id)], k), "neighbours")
    full = top.where(F.col("similarity") >= similarity).groupBy(query_id).count().where(F.col("count") >= k)
    short = queries.join(full, query_id, "left_anti")
    if short.isEmpty():
        return top
    return top.join(full, query_id, "left_semi").unionByName(nearest(items, item_id, vector, short, query_id, vector, k))


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group: means per (group, position) combine map-side."""
    means = df.select(group, F.posexplode(vector).alias("pos", "x")).groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # at most one value per position
    return means.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("center"))
