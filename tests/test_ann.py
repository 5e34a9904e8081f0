"""The vector index against all cosines."""

import numpy as np

from millrace.operators import ann

DIM, K = 8, 5


def rows_around(n, groups, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, DIM)) * 3
    # group 0 holds a third of all rows
    group = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, groups, n))
    return [(i, v.tolist()) for i, v in enumerate(centres[group] + 0.4 * rng.standard_normal((n, DIM)))]


def best(rows, query):
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-300)
    return sorted((-round(float(unit(v) @ unit(query)), 9), i) for i, v in rows if v is not None)[:K]


def test_index_finds_neighbours_and_reads_a_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ITEMS", 60)  # the large cell is cut
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    rows = rows_around(600, 12, 5)
    rows += [(1000 + i, rows[0][1]) for i in range(3)] + [(2000, None), (2001, [0.0] * DIM)]
    table = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    index = ann.VectorIndex.build(table, "id", "v", DIM, parts=4)
    assert index.n == index.items.count() == len(rows) - 1 and index.cells.count() > 10
    asks = table.where("id % 20 = 0").withColumnRenamed("id", "q")
    probes, recall = index.probes_for(asks, "q", "v", K, 0.9)
    made = index.search(asks, "q", "v", K, probes).collect()
    vectors = dict(rows)
    wanted = {(q, i) for q, v in rows if q % 20 == 0 and v is not None for _, i in best(rows, v)}
    found = {(r.q, r.id) for r in made}
    assert recall >= 0.9 and len(found & wanted) >= 0.9 * len(wanted) and len(found) == len(wanted)
    assert sum(r.touched for r in made) / len(made) < 0.6 * index.n
    for r in made[:50]:
        a, b = np.array(vectors[r.q]), np.array(vectors[r.id])
        assert abs(r.similarity - a @ b / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-300)) < 1e-9
    # with every cell read and few enough items in a block, nothing is missed
    everything = index.search(asks.where("q = 0"), "q", "v", K, 10_000).collect()
    assert sorted((-round(r.similarity, 9), r.id) for r in everything) == best(rows, vectors[0])


def test_empty_table_and_few_items(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(1, [1.0] * DIM)], "id long, v array<double>")
    asks = one.withColumnRenamed("id", "q")
    assert ann.VectorIndex.build(none, "id", "v", DIM, parts=2).search(asks, "q", "v", K, 3).count() == 0
    assert [r.id for r in ann.VectorIndex.build(one, "id", "v", DIM, parts=2).search(asks, "q", "v", K, 3).collect()] == [1]
