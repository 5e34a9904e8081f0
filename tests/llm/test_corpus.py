"""Mixing, exact and near duplicates, and the pipeline against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import exact, mixing, near
from tests.oracle import duck, normal

SF = "/root/testdata/sf0.001"


# ---- mixing


def test_rates_reach_the_weights(table):
    rows = [(i, "x" * (5 + i % 7), "big" if i % 10 else "small") for i in range(6000)]
    made = mixing.mix_sources(table(rows), weights={"big": 1.0, "small": 1.0}, ratio=2.0).groupBy("source").agg({"n_chars": "count", "*": "count"})
    size = {r.source: r["count(1)"] for r in made.collect()}
    assert abs(size["big"] - 6000) < 300 and abs(size["small"] - 6000) < 300


def test_salted_join_gives_the_same(monkeypatch, table):
    rows = [(i, "x" * (i % 9), f"s{i % 5}" if i % 3 else None) for i in range(500)]
    want = sorted(map(tuple, mixing.mix_sources(table(rows)).collect()), key=str)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(map(tuple, mixing.mix_sources(table(rows)).collect()), key=str) == want


def test_poisson_inversion(spark):
    from pyspark.sql import functions as F

    for rate in (0.01, 1.0, 30.0, 2000.0):
        cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(rate)).alias("c")).first().c
        assert all(a <= b for a, b in zip(cdf, cdf[1:])) and abs(cdf[-1] - 1) < 1e-9
        assert abs(sum(1 - c for c in cdf) - rate) < 1e-6 * max(1, rate) * 10


def test_mix_is_native(spark):
    plan = mixing.mix_sources(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_mix_odd_rows(odd, none):
    made = mixing.mix_sources(odd, ratio=3.0)
    assert set(made.columns) == {*odd.columns, "copy_no", "mix_order"} and made.count() > 0
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(odd, weights={}).count() == 0
    twice = made.where("doc_id = 5").groupBy("copy_no").count().collect()
    assert all(r["count"] == 2 for r in twice)


# ---- exact duplicates


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    return sorted(((r.doc_id, max((i for i in groups[r.text or ""] if i is not None), default=None), len(groups[r.text or ""]),
                    hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows), key=str)


@pytest.mark.parametrize("primes", [exact.PRIMES, (2, 3), (101, 103)])
def test_exact_groups_even_when_fingerprints_collide(table, primes):
    rng = random.Random(3)
    texts = [rng.choice("ab") * rng.randint(0, 3) + rng.choice("cd") for _ in range(60)] + ["y" * 200_000, "y" * 199_999 + "z", "y" * 200_000]
    df = table([(i, t, "a") for i, t in enumerate(texts)])
    made = exact.exact_duplicates(df, primes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in made), key=str) == brute_exact(df.collect())
    assert all(r.kept == (r.doc_id == r.keep_id) for r in made)


def test_fingerprints_combine_in_any_grouping():
    poly = exact.Polynomial(exact.PRIMES[0], exact.BASES[0], 16)
    data = np.random.default_rng(1).integers(0, 256, 100).astype(np.uint8)
    value = 0
    for b in data.tolist():
        value = (value * poly.base + b + 1) % poly.prime
    assert poly.of_text(data) == value
    parts = [(poly.of_text(p), len(p)) for p in (data[:7], data[7:60], data[60:60], data[60:])]
    assert exact.fold_chunks(parts, poly) == (value, 100)
    right = exact.fold_chunks(parts[1:], poly)
    assert exact.fold_chunks([parts[0], right], poly) == (value, 100)


def test_exact_odd_rows(odd, none):
    made = exact.exact_duplicates(odd).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in made), key=str) == brute_exact(odd.collect())
    assert sum(r.kept for r in made) == odd.select("text").na.fill("").distinct().count()
    left = exact.drop_exact_duplicates(odd)
    assert left.columns == odd.columns and left.count() == sum(r.kept for r in made)
    assert exact.exact_duplicates(none).count() == 0 and exact.drop_exact_duplicates(none).count() == 0


# ---- near duplicates


def brute_near(rows):
    shingler = near.Shingler()
    sets = {r.doc_id: set(shingler.shingles(r.text or "").tolist()) for r in rows}
    links, parent = collections.Counter(), {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= near.THRESHOLD * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return sorted((i, top(i), links[i]) for i in sets)


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randint(0, 999)}" for w in words)


def test_near_groups_with_a_hot_passage_and_large_groups(table):
    rng = random.Random(12)
    base = [f"b{i}" for i in range(150)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, edited(rng, base, 0.01), "a") for i in range(120)]
    rows += [(200 + i, passage + " " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(40)), "a") for i in range(120)]
    rows += [(400 + i, "same words in every copy of this text", "a") for i in range(50)] + [(500, "few words", "a"), (501, "few words", "b"), (502, "", "a")]
    df = table(rows)
    want = brute_near(df.collect())
    # small limits, so that buckets are split and large ones compared in blocks
    made = near.near_duplicates(df, leaf_rows=16, block_rows=16).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in made) == want
    assert sum(r.stays for r in made) == len({c for _, c, _ in want})


def test_runs_reach_the_recall_over_shared_tokens():
    shared = np.random.default_rng(3).binomial(near.TOKENS, near.THRESHOLD, 400_000)
    chance = np.array([near.meeting_chance(m / near.TOKENS, near.LEVELS) for m in range(near.TOKENS + 1)])[shared]
    missed = np.where(shared < near.MIN_AGREE, 1.0, (1 - chance) ** near.runs_needed())
    assert missed.mean() < 1.3 * (1 - near.RECALL)


def test_runs_reach_the_recall():
    assert near.meeting_chance(0.8, 1) == pytest.approx(0.75 * 0.8 + 0.25 * 0.96)
    runs = near.runs_needed(0.99, 3)
    assert 1 - (1 - near.meeting_chance(0.8, 3)) ** runs >= 0.99


def test_near_odd_rows(odd, none):
    made = near.near_duplicates(odd).collect()
    assert len(made) == odd.count()
    by_id = collections.defaultdict(list)
    for r in made:
        by_id[r.doc_id].append(r)
    assert [r.n_links for r in by_id[1]] == [2] and [r.n_links for r in by_id[5]] == [2, 2] and by_id[5][0].class_id == 1
    assert [r.n_links for i in (2, 3, 6, None) for r in by_id[i]] == [0, 0, 0, 0]
    left = near.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.count() == sum(r.stays for r in made)
    assert near.near_duplicates(none).count() == 0 and near.drop_near_duplicates(none).count() == 0


# ---- pipeline


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := f"{corpus_pipeline.materialize(docs.limit(0), name).inputFiles()[0].rsplit('/', 1)[0]}-stage")
        docs = spark.read.parquet(path)
        seen[name] = before.count(), docs.count()
        if name != "encode":
            assert docs.columns == columns
        if name == "exact_dedup":
            assert seen[name][1] == before.select("text").distinct().count()
        if name == "near_dedup":
            want = brute_near(before.collect())
            assert sorted(r.doc_id for r in docs.collect()) == sorted({c for _, c, _ in want})
        if name == "mix_sources":
            con = duck(SF)
            con.register("kept", before.toPandas())
            sql = con.execute(mixing.ORACLE_SQL.replace("FROM documents", "FROM kept")).fetchdf()
            assert sorted(docs.toPandas().doc_id) == sorted(sql.doc_id)
    assert seen["quality_filter"][1] < seen["quality_filter"][0] and seen["encode"][0] == seen["encode"][1]


def test_run_gives_the_last_stage(spark):
    made = corpus_pipeline.run(spark, SF)
    assert made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and made.count() > 0
    assert normal([tuple(r) for r in made.drop("ids").collect()], made.drop("ids").columns) == normal(
        [tuple(r) for r in corpus_pipeline.run(spark, SF).drop("ids").collect()], made.drop("ids").columns)
