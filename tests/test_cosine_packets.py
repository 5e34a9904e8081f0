"""Packets of vectors that meet: every cut, list, tile and batch against all pairs, and how few pairs are multiplied in full."""

import numpy as np
import pytest

from millrace.operators import similar


def vectors(n, seed, vocabulary=400, own=0):
    """Texts of words that are rare and frequent by turns, near copies among them; some hold frequent words only, some nothing."""
    rng = np.random.default_rng(seed)
    texts = []
    for i in range(n):
        words = (rng.random(rng.integers(0, 30)) ** 4 * vocabulary).astype(int) + own * (i % 2) * vocabulary
        texts.append(words if i % 11 else words[words < 4])
        if i % 5 == 0 and len(words):
            texts.append(np.where(rng.random(len(words)) < rng.choice([0.1, 0.4]), rng.integers(0, vocabulary, len(words)), words))
    return texts


def packed(texts, parts):
    """The packets of the texts dealt to ``parts``, with ids by text and copies 1, 2, 3, and the matrix of unit vectors."""
    words, code = np.unique(np.concatenate(texts), return_inverse=True)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    times = np.zeros((len(texts), len(words)))
    np.add.at(times, (row, code), 1)
    copies = np.arange(len(texts)) % 3 + 1
    held, idf = (times > 0).sum(axis=0), np.log(copies.sum() / (copies @ (times > 0))) + 1
    packets = []
    for part in range(parts):
        ids = np.arange(part, len(texts), parts)
        r, c = np.nonzero(times[ids])
        used, place = np.unique(c, return_inverse=True)
        numbers = 7 * len(words) - 7 * used  # words are numbered in another order than they are listed
        body = similar._weighed(ids, copies[ids], r, place, times[ids][r, c].astype("int32"), numbers, held[used], idf[used], len(texts))
        packets.append(similar._Packet(body))
    x = times * idf
    return packets, x / np.maximum(np.sqrt((x * x).sum(axis=1)), 1e-300)[:, None], copies


def links(packets, n, least):
    made = np.zeros(n, "int64")
    for i, a in enumerate(packets):
        for b in packets[i:]:
            np.add.at(made, *similar._count_links(a, b, a is b, least - 1e-9))
    return made


@pytest.mark.parametrize("cuts", [(1 / 4, 1 / 16, 1 / 64), (1.0,), (1e-9,)])
@pytest.mark.parametrize("least", [0.02, 0.3, 0.7])
@pytest.mark.parametrize("cells, width, many", [(524_288, 8192, 1 / 64), (64, 16, 1.0), (100, 40, 1e-9)])
def test_packets_against_all_pairs(monkeypatch, cuts, least, cells, width, many):
    for name, value in {"CUTS": cuts, "TILE_CELLS": cells, "TILE_WIDTH": width, "_MANY": many, "OFTEN": 5, "FULL_ROWS": 7}.items():
        monkeypatch.setattr(similar, name, value)
    texts = vectors(150, 1) + [np.array([], int), np.array([7000])]
    packets, x, copies = packed(texts, 3)
    alike = x @ x.T >= least - 1e-9
    np.fill_diagonal(alike, False)
    assert (links(packets, len(texts), least) == alike @ copies).all() and alike.sum() > 50


def test_few_pairs_are_multiplied_in_full(monkeypatch):
    full, made = [], similar._products
    monkeypatch.setattr(similar, "_products", lambda a, b, to, i, j: full.append(len(i)) or made(a, b, to, i, j))
    rng = np.random.default_rng(2)
    texts = [(rng.random(40) ** 3 * 20_000).astype(int) for _ in range(3000)]
    packets, x, copies = packed(texts, 2)
    alike = x @ x.T >= 0.3 - 1e-9
    np.fill_diagonal(alike, False)
    assert (links(packets, len(texts), 0.3) == alike @ copies).all()
    assert sum(full) < len(texts) ** 2 / 2 / 100


def test_packets_are_not_copied_for_their_meetings(spark, monkeypatch):
    monkeypatch.setattr(similar, "PACKET_WORDS", 20)
    plans, linked = [], similar._linked
    monkeypatch.setattr(similar, "_linked", lambda rows, keys, classes, partners: plans.append(partners._jdf.queryExecution().executedPlan().toString()) or linked(rows, keys, classes, partners))
    rows = [(i, [f"w{i % 7}", f"w{i % 5}", f"own{i}"]) for i in range(60)]
    made = {r.id: r.links for r in similar.cosine_links(spark.createDataFrame(rows, "id long, w array<string>"), ["id"], "w", 0.01).collect()}
    sets = [{f"w{i % 7}", f"w{i % 5}"} for i in range(60)]
    assert made == {i: sum(j != i and bool(sets[i] & sets[j]) for j in range(60)) for i in range(60)}
    assert "Generate" not in plans[0]  # each block was sent once for every other one before
