"""Similarity links against comparing every pair."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import similar

SHAPE = "id long, w array<string>"


def rows_of(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    often = [f"the{i}" for i in range(6)]
    out = []
    for _ in range(n):
        base = rng.sample(vocabulary, rng.randrange(3, 25)) + rng.sample(often, 3)
        out.append(base)
        for _ in range(rng.choice([0, 0, 1, 3])):  # near copies at many distances
            out.append([rng.choice(vocabulary) if rng.random() < rng.choice([0.1, 0.2, 0.3]) else w for w in base])
    family = rng.sample(vocabulary, 20)
    out += [family[:i] + [f"own{i}"] + family[i + 1:] for i in range(20) for _ in range(2)]  # a family with copies
    out += [out[0]] * (len(out) // 3)  # a third of all rows is one text
    out += [None, [], [], ["one"], ["one", "one"], [None, "one"]]
    return list(enumerate(out))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def brute(rows, likeness, least):
    return {i: sum(j != i and likeness(x, y) >= least - 1e-9 for j, y in rows) for i, x in rows}


@pytest.mark.parametrize("block", [4096, 7])
@pytest.mark.parametrize("least", [0.6, 0.85])
def test_set_links(spark, monkeypatch, block, least):
    monkeypatch.setattr(similar, "BLOCK", block)
    rows = rows_of(1)
    made = similar.set_links(spark.createDataFrame(rows, SHAPE).repartition(4), ["id"], "w", least).collect()
    sets = [(i, {x for x in w or [] if x is not None}) for i, w in rows]
    wanted = brute(sets, jaccard, least)
    assert {r.id: r.links for r in made} == wanted and len(made) == len(rows)
    sizes = Counter(frozenset(s) for _, s in sets)
    assert {r.id: r.copies for r in made} == {i: sizes[frozenset(s)] for i, s in sets}
    assert len({r.class_id for r in made}) == len(sizes) and sum(wanted.values()) > 500


@pytest.mark.parametrize("block", [4096, 7])
@pytest.mark.parametrize("least", [0.3, 0.6])
def test_cosine_links(spark, monkeypatch, block, least):
    monkeypatch.setattr(similar, "BLOCK", block)
    rows = rows_of(2, 100)
    bags = [(i, Counter(x for x in w or [] if x is not None)) for i, w in rows]
    held = Counter(w for _, b in bags for w in b)

    def unit(bag):
        v = {w: n * (math.log(len(rows) / held[w]) + 1) for w, n in bag.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = [(i, unit(b)) for i, b in bags]
    wanted = brute(vectors, lambda a, b: sum(x * b.get(w, 0.0) for w, x in a.items()), least)
    made = similar.cosine_links(spark.createDataFrame(rows, SHAPE).repartition(4), ["id"], "w", least).collect()
    assert {r.id: r.links for r in made} == wanted and sum(wanted.values()) > 500


def test_empty_table_and_repeated_keys(spark):
    none = spark.createDataFrame([], SHAPE)
    assert similar.set_links(none, ["id"], "w").count() == 0 and similar.cosine_links(none, ["id"], "w").count() == 0
    twice = spark.createDataFrame([(1, ["a", "b"]), (1, ["a", "b"]), (1, ["c"])], SHAPE)
    assert sorted(r.links for r in similar.set_links(twice, ["id"], "w").collect()) == [0, 1, 1]


def test_no_product_in_the_plan(spark):
    made = similar._meet(spark.createDataFrame([("x", "w", 3)], "class_id string, word string, n int"), lambda a, b: F.lit(True))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
