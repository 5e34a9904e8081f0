"""Centroid clustering in whole numbers, with a vantage-point tree over the centroids.

Every round builds the tree anew and broadcasts it. A vector walks the tree best first: the open node with the least
possible distance is next, and a node is left out only if that exceeds the best distance found. Distances are whole
numbers; ties go to the smaller centroid number, so equal bounds are still followed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices
from millrace.session import materialize

#: Components are turned into floor(SCALE * x).
SCALE = 256
#: Largest whole component, so that a squared distance over DIMENSIONS of them fits a long.
LARGEST = 1 << 27
LEAF = 4
#: Bounds come from square roots; this much is added so that rounding never closes a node.
SLACK = 1e-9


@dataclass
class Node:
    """A ball around ``point`` split at ``radius``, or a leaf with the numbers of its centroids."""

    members: np.ndarray
    point: int = -1
    radius: float = 0.0
    inside: int = -1
    outside: int = -1


def squared(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all points."""
    out = np.empty((len(rows), len(points)), dtype=np.int64)
    for i, p in enumerate(points):
        apart = rows - p
        out[:, i] = np.einsum("ij,ij->i", apart, apart)
    return out


def build_tree(points: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Vantage-point tree: a node's point is the member farthest from the members' mean; the median distance splits the rest."""
    tree: list[Node] = []

    def grow(members: np.ndarray) -> int:
        at = len(tree)
        tree.append(Node(members))
        if len(members) > leaf:
            own = points[members].astype(np.float64)
            top = members[int(np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1)))]
            rest = members[members != top]
            far = squared(points[rest], points[top:top + 1])[:, 0]
            cut = int(np.median(far))
            near = far <= cut
            if not near.all():  # all at one distance: no ball tells them apart
                tree[at] = Node(members[:0], int(top), float(np.sqrt(cut)))
                tree[at].inside = grow(rest[near])
                tree[at].outside = grow(rest[~near])
        return at

    grow(np.arange(len(points)))
    return tree


def nearest_centroids(rows: np.ndarray, points: np.ndarray, tree: list[Node]) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of every row, the squared distance, and how many distances were computed.

    All rows walk together, each by its own order: in a step every row takes its open node with the least bound.
    """
    n = len(rows)
    best, distance = np.full(n, len(points), dtype=np.int64), np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
    bounds = np.full((n, len(tree)), np.inf)
    bounds[:, 0] = 0.0
    computed = 0

    def offer(who: np.ndarray, number: np.ndarray, far: np.ndarray) -> None:
        better = (far < distance[who]) | ((far == distance[who]) & (number < best[who]))
        best[who[better]], distance[who[better]] = number[better], far[better]

    active = np.arange(n)
    while len(active):
        turn = np.argmin(bounds[active], axis=1)
        low = bounds[active, turn]
        # inclusive: a node that can only tie may hold a smaller number
        go = low <= np.sqrt(distance[active].astype(np.float64)) * (1 + SLACK) + SLACK
        go &= np.isfinite(low)
        active, turn, low = active[go], turn[go], low[go]
        bounds[active, turn] = np.inf
        for at in np.unique(turn):
            who, floor, node = active[turn == at], low[turn == at], tree[at]
            if node.point < 0:
                far = squared(rows[who], points[node.members])
                computed += far.size
                for i, number in enumerate(node.members):
                    offer(who, np.full(len(who), number), far[:, i])
                continue
            far = squared(rows[who], points[node.point:node.point + 1])[:, 0]
            computed += len(who)
            offer(who, np.full(len(who), node.point), far)
            root = np.sqrt(far.astype(np.float64))
            bounds[who, node.inside] = np.maximum(floor, (root - node.radius) * (1 - SLACK) - SLACK)
            bounds[who, node.outside] = np.maximum(floor, (node.radius - root) * (1 - SLACK) - SLACK)
    return best, distance, computed


def whole_vectors(embeddings: DataFrame, dimensions: int) -> DataFrame:
    """vec_id and v, the vector in whole numbers, of the rows whose vector is complete and finite."""
    x = F.col("embedding")
    fits = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * SCALE) < LARGEST))
    kept = embeddings.where((F.size(x) == dimensions) & fits)
    return kept.select("vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("int")).alias("v"))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def first_centroids(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors whose hash of the id is smallest, in that order; of equal hashes the smaller vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return np.array([r.v for r in vectors.orderBy(digest, "v").select("v").limit(count).collect()], dtype=np.int64)  # count rows


def cluster_sums(vectors: DataFrame, points: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Vectors per cluster and their sums by component; a task sends one row for each cluster."""
    k, dimensions = points.shape
    shared = vectors.sparkSession.sparkContext.broadcast((points, build_tree(points)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, tree = shared.value
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column("v"), dimensions)
            best, _, _ = nearest_centroids(rows, centers, tree)
            count += np.bincount(best, minlength=k)
            np.add.at(sums, best, rows)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": full, "n": count[full], "sums": pa.array(sums[full].tolist(), pa.list_(pa.int64()))})

    parts = vectors.select("v").mapInArrow(add, "cluster long, n long, sums array<long>")
    by_place = parts.select("cluster", "n", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in by_place.collect():  # count of centroids times dimensions
        found.setdefault(r.cluster, (r.n, [0] * dimensions))[1][r.place] = r.x
    shared.unpersist()
    return found


def cluster_vectors(embeddings: DataFrame, *, count: int = 40, rounds: int = 5, dimensions: int = 64, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept row of (vec_id, embedding).

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite; also left out are those with a
    component of 2**19 or more in size, whose squared distances no long can hold. Centroids start as the vectors with
    the smallest hashes; each round moves every non-empty one to the exact floored mean of its vectors.

    Fewer vectors than ``count`` give as many centroids; none give no rows. Repeated rows and ids are rows of their own;
    a null id hashes as the word null; equal centroids leave all but the smallest number empty. Further columns are left
    behind. The centroids (count x dimensions numbers) are all that passes through the driver; a cluster of any size
    reaches the shuffle as one row for each task.
    """
    spark = embeddings.sparkSession
    vectors = materialize(whole_vectors(embeddings, dimensions), "whole-vectors")
    schema = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    points = first_centroids(vectors, count, seed)
    if not len(points):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        for cluster, (n, sums) in cluster_sums(vectors, points).items():
            points[cluster] = [x // n for x in sums]
    shared = spark.sparkContext.broadcast((points, build_tree(points)))

    def assign(batch: pa.RecordBatch) -> dict:
        best, distance, _ = nearest_centroids(matrix(batch.column("v"), dimensions), *shared.value)
        return {"vec_id": batch.column("vec_id"), "cluster": best.astype(np.int32), "distance": distance}

    found = materialize(map_slices(vectors, assign, schema, rows=8_192), "assigned")
    names = spark.createDataFrame([(i, sha256(",".join(map(str, p)).encode()).hexdigest()) for i, p in enumerate(points.tolist())], "cluster int, centroid_sha256 string")
    sums = materialize(found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(names, "cluster"), "inertia")
    total = sums.agg(F.sum("cluster_inertia")).first()[0]
    return found.join(F.broadcast(sums.withColumn("inertia", F.lit(total).cast("long"))), "cluster").select(  # at most ``count`` rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(count: int = 40, rounds: int = 5) -> str:
    nearest = """SELECT id, cluster, distance, v FROM (SELECT w.id, w.v, c.n AS cluster, list_sum(list_transform(list_zip(w.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
 FROM w, {c} c) QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1"""
    parts = []
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({nearest.format(c=f'c{r}')})")
        parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT o.n, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS v FROM
 (SELECT cluster, i, (sum(v[i]) // count(*) - (sum(v[i]) % count(*) < 0)::INT)::BIGINT AS x FROM a{r}, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1) m ON m.cluster = o.n)""")
    return f"""
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v FROM embeddings
 WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS n, v FROM w QUALIFY n < {count}),
{', '.join(parts)},
last AS MATERIALIZED ({nearest.format(c=f'c{rounds}')})
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
 sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM last JOIN w USING (id) JOIN c{rounds} c ON c.n = cluster"""


ORACLE_SQL = _oracle()
