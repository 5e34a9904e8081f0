"""Classifiers and the language model: held-out accuracy, exact identities, gradients and brute-force counts."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import labelled, lm, quality, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    good = labels.sum()
    return (rank[labels == 1].sum() - good * (good - 1) / 2) / (good * (len(labels) - good))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("score, label, folds, fold", [(toxicity.score_toxicity, "toxic", 4, 2), (quality.score_quality, "quality", 5, 0)])
def test_held_out_accuracy(tables, score, label, folds, fold):
    documents, labels = tables
    made = score(documents, labels).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", label).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % folds == fold) for i, h in zip(made.doc_id, made.held_out))
    held = made[made.held_out]
    assert len(held) > 300 and auc(held.score.values, held[label].values) > 0.95
    assert (held.predicted == held[label]).mean() > 0.97
    assert ((made.score >= 0.3) == (made.predicted == 1)).all()


@pytest.mark.parametrize("score, label, folds, fold", [(toxicity.score_toxicity, "toxic", 4, 2), (quality.score_quality, "quality", 5, 0)])
def test_held_out_labels_are_not_read(tables, score, label, folds, fold):
    documents, labels = tables
    small = labels.where("doc_id < 1500")
    held = f"crc32(cast(cast(doc_id as string) as binary)) % {folds} = {fold}"
    flipped = small.selectExpr("doc_id", f"if({held}, 1 - {label}, {label}) as {label}")
    assert small.where(held).count() > 50
    first, second = (score(documents.where("doc_id < 300"), x).orderBy("doc_id").toPandas() for x in (small, flipped))
    assert first.equals(second)


def test_misspellings_share_vectors():
    rng = random.Random(2)
    plain = ["the", "of", "and", "garden", "river", "stone", "light", "house"]
    sample = []
    for i in range(400):
        words = [rng.choice(plain) + rng.choice(["", "s", "en"]) for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["worthless", "horrible"]) + rng.choice(["", "er", "ish", "ly"])
        sample.append((" ".join(words), int(i % 4 == 0)))
    scorer = toxicity.Scorer(*toxicity.train(sample, epochs=20))
    bad, good, empty = scorer.scores(["the garden of worthles stone and light", "the garden of the stones and lights", ""])
    assert bad > 0.5 > 0.3 > good and 0 < empty < 0.5


def test_factorisation_identity():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(quality.WORD_BUCKETS + quality.STATISTICS, 1 + quality.FACTORS))
    machine = quality.Machine(0.3, rows, np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    words = [np.array([5, 9, 700]), np.empty(0, np.int64), np.array([1])]
    stats = rng.normal(size=(3, quality.STATISTICS))
    for text, z, got in zip(words, stats, machine.logits(words, stats)):
        x = np.concatenate([np.full(len(text), 1 / math.sqrt(max(1, len(text)))), np.clip(z, -5, 5)])
        v = rows[np.concatenate([text, np.arange(quality.WORD_BUCKETS, len(rows))])]
        pairs = sum(x[i] * x[j] * (v[i, 1:] @ v[j, 1:]) for i in range(len(x)) for j in range(i))
        assert got == pytest.approx(0.3 + x @ v[:, 0] + pairs)


def test_sample_is_bounded_and_whole(table):
    df = table([(i, "x" * (10 + i), "a") for i in range(50)])
    labels = df.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    from pyspark.sql import functions as F

    made = labelled.labelled_sample(df, labels, "toxic", F.lit(True), max_rows=20, max_chars=400)
    assert 0 < len(made) <= 20 and sum(len(t) for t, _ in made) <= 400
    assert all((len(t) - 10) % 2 == y for t, y in made)
    assert made == labelled.labelled_sample(df, labels.union(labels), "toxic", F.lit(True), max_rows=20, max_chars=400)


@pytest.mark.parametrize("score, label", [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_classifiers_odd_rows(odd, none, score, label):
    labels = odd.selectExpr("doc_id", f"cast(if(doc_id = 7, null, doc_id % 2) as int) as {label}", "'x' as text")
    made = score(odd, labels).collect()
    assert len(made) == odd.count() and all(0 <= r.score <= 1 for r in made)
    assert not any(r.held_out for r in made if r.doc_id is None)
    assert score(none, labels).count() == 0
    assert score(odd, labels.where("false")).count() == len(made)


def test_keep_good_drops_only_rejected(tables):
    documents, labels = tables
    part = documents.where("doc_id < 3000")
    scored = {r.doc_id: r.predicted for r in quality.score_quality(part, labels).collect()}
    kept = quality.keep_good(part, labels)
    assert kept.schema == part.schema
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i, p in scored.items() if p)


# ---- language model


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def test_base_scores_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = lm.score_texts(docs, RANKS, public_tokenizers.PATTERN, head_words=300).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = collections.Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    for r in made.itertuples():
        own = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own))
        assert r.score < 0
    # the model has learnt: better than any id alike, by far
    assert made.score.sum() / made.n_ids.sum() > -2.6 > -math.log10(50_257)


@pytest.fixture(scope="module")
def small():
    """Classes of a tiny vocabulary with random weights."""
    rng = np.random.default_rng(6)

    class Vocab:
        starts_word = rng.random(301) < 0.3

    counts = rng.integers(0, 50, 301).astype(float)
    classes = lm.Classes(Vocab, counts)
    pairs = rng.integers(0, 5, (lm.CLASSES + 1, classes.rows)).astype(float)
    classes.group_rare(np.concatenate([pairs[:lm.SINGLE_CLASSES + 1], pairs[-1:]]))
    weights = lm.start_weights(classes)
    weights["out"] = rng.normal(0, 1, weights["out"].shape).astype(np.float32)
    weights["distance"] = rng.normal(0, 1, lm.LENGTH).astype(np.float32)
    return classes, lm.Model(weights, classes.class_of, classes.starts_word, classes.within(pairs))


def naive(model, inputs, goal, at):
    """log10 probability of one goal, written plainly for the text that ``inputs`` holds."""
    w = model.weights
    first = max(0, at - at % lm.STRIDE - lm.BACK)
    e = w["ids"][inputs[first:at + 1]].astype(float)
    n = len(e)
    s = e[:, 8:16] @ e[-1, :8] + w["distance"][np.arange(n - 1, -1, -1)]
    a = np.exp(s - s.max())
    z = np.concatenate([a / a.sum() @ e[:, 16:24], e[-1, 24:]]) @ w["out"] + w["bias"]
    p = np.exp(z - z.max())
    line = model.before[goal] if model.before[goal] >= 0 else model.class_of[inputs[at]]
    return math.log10(p[model.class_of[goal]] / p.sum()) + model.within[line, goal]


def test_windows_score_each_id_once_as_the_plain_formula(small):
    classes, model = small
    rng = np.random.default_rng(1)
    sizes = np.array([1, 5, 24, 25, 70])
    inputs, goals = (rng.integers(0, classes.rows, sizes.sum()).astype(np.int32) for _ in range(2))
    made = model.log10(inputs, goals, sizes, batch=3)
    at = 0
    for size in sizes:
        for i in range(size):
            assert made[at + i] == pytest.approx(naive(model, inputs[at:at + size], goals[at + i], i), abs=1e-4)
        at += size


def test_within_class_probabilities_sum_to_one(small):
    classes, model = small
    for line in range(lm.CLASSES + 1):
        mass = np.bincount(classes.class_of, 10.0 ** model.within[line].astype(float) * np.where(np.arange(classes.rows) == classes.rows - 1, classes.rest, 1), lm.CLASSES)
        used = np.bincount(classes.class_of, minlength=lm.CLASSES) > 0
        assert np.allclose(mass[used], 1, atol=1e-4)


def test_ids_without_a_row_keep_their_counts(monkeypatch):
    monkeypatch.setattr(lm, "OWN_IDS", 150)

    class Vocab:
        starts_word = np.zeros(301, bool)

    counts = np.random.default_rng(7).integers(0, 50, 301).astype(float)
    classes = lm.Classes(Vocab, counts)
    others = classes.row_of == classes.rows - 1
    assert others.sum() == classes.rest == 151 and not classes.uneven[~others].any()
    # the shares of the rest sum to one, and follow the counts
    share = 10.0 ** classes.uneven[others].astype(float) / classes.rest
    assert share.sum() == pytest.approx(1, abs=1e-5) and share == pytest.approx((counts[others] + 0.5) / (counts[others] + 0.5).sum(), abs=1e-6)


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_WINDOWS", 600)  # several parts
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.where("doc_id < 40"))
    made = []
    for table in (docs.coalesce(1), docs.repartition(7, F.xxhash64("text"))):
        made.append(sorted((r.doc_id, r.n_ids, r.score) for r in lm.score_texts(table, RANKS, public_tokenizers.PATTERN).collect()))
    one, other = made
    assert [r[:2] for r in one] == [r[:2] for r in other] and len(one) == docs.count()
    assert [r[2] for r in one] == pytest.approx([r[2] for r in other], rel=1e-3)


def test_training_lowers_the_loss(small):
    classes, model = small
    rng = np.random.default_rng(2)
    pattern = rng.integers(0, classes.rows, 40)
    windows = np.array([np.resize(np.roll(pattern, -rng.integers(40)), lm.LENGTH + 1) for _ in range(200)], np.int32)
    windows[:, 30:][::5] = -1
    start = lm.start_weights(classes)
    made = lm.train_windows(start, windows, classes.class_of, 1, steps=400)

    def loss(weights):
        m = lm.Model(weights, classes.class_of, classes.starts_word, model.within * 0)
        inputs, goals = windows[1, :-1].copy(), windows[1, 1:].copy()
        return -m.log10(inputs, goals, np.array([len(inputs)])).mean()

    assert loss(made) < 0.3 * loss(start)


def test_lm_odd_rows(odd, none):
    made = lm.score_texts(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert len(made) == odd.count() and all(r.score < 0 and r.base_score < 0 for r in made)
    assert all(r.n_tokens == 1 for r in made if r.doc_id in (2, 3, 6))
    assert lm.score_texts(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_frequent_words_stay_within_the_bound(spark):
    words = spark.createDataFrame([(f"w{i}", 1 + (i % 7) * 10 ** (i % 5)) for i in range(300)], "word string, n long")
    for most in (0, 1, 5, 40, 150, 1000):
        made = {r.word: r.n for r in lm.frequent_words(words, most).collect()}
        assert len(made) <= most
        rest = [r.n for r in words.collect() if r.word not in made]
        assert not made or not rest or min(made.values()) > max(rest)
    assert lm.frequent_words(words, 1000).count() == 300


def test_every_id_and_the_end_is_a_training_goal_once(spark):
    vocab = lm.vocabulary(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    texts = ["", "one", " ".join(f"word{i}" for i in range(20)), " ".join(f"w{i % 50}x" for i in range(3_000)), " ".join(["the"] * (lm.LENGTH - 1))]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    rows = np.arange(vocab.end + 1, dtype=np.int32) % 8_000
    send = spark.sparkContext.broadcast
    made = lm.training_windows(docs, send(open(RANKS, "rb").read()), public_tokenizers.PATTERN, send(rows)).collect()
    windows = [np.frombuffer(r.window, np.int16) for r in made]
    goals = [i for w in windows for i in w[1:] if i >= 0]
    whole = [[*[i for word in t.encode().split() for i in vocab.ids(word)], vocab.end] for t in texts]
    assert goals == [rows[i] for ids in whole for i in ids]
    first = [rows[i] for ids in whole for i in [vocab.end, *ids][:-1][::lm.LENGTH]]
    assert [w[0] for w in windows] == first and all(len(w) == lm.LENGTH + 1 for w in windows)


def test_streamed_training_sees_every_window(small, monkeypatch):
    classes, _ = small
    seen = collections.Counter()
    step = lm.Trainer.step
    monkeypatch.setattr(lm.Trainer, "step", lambda self, part: (seen.update(part[:, 0].tolist()), step(self, part)))
    groups = np.arange(5 * 100).reshape(5, 100, 1).repeat(lm.LENGTH + 1, 2) % classes.rows
    lm.Trainer(lm.start_weights(classes), classes.class_of).stream(iter(groups.astype(np.int32)), np.random.default_rng(1))
    assert seen == collections.Counter((np.arange(500) % classes.rows).tolist())


def test_texts_are_encoded_once_for_training_and_scoring(spark, odd):
    send = spark.sparkContext.broadcast
    ranks, head = send(open(RANKS, "rb").read()), lm.Head({b"text": -1.5, b"one": -2.0, b"a": -0.5})
    vocab = lm.vocabulary(ranks.value, public_tokenizers.PATTERN)
    texts = odd.selectExpr("doc_id", "coalesce(text, '') text").coalesce(1)
    coded = lm.encode_texts(texts, ranks, public_tokenizers.PATTERN, send((head, (-3.0, 1)))).cache()
    for given, made in zip(texts.collect(), coded.collect(), strict=True):
        own = tokens(given.text)[:-1]
        assert given.doc_id == made.doc_id and made.n_tokens == len(own) + 1
        assert np.frombuffer(made.ids, vocab.kind).tolist() == [i for w in own for i in vocab.ids(w)]
        assert {r.word.encode(): r.times for r in made.rest} == collections.Counter(w for w in own if w not in head)
        assert made.known == 1 + sum(w in head for w in own)
        assert made.base == pytest.approx(-3 + sum(head[w] for w in own if w in head))
    rows = send(np.arange(vocab.end + 1, dtype=np.int32) % 8_000)
    one, other = (lm.training_windows(t, ranks, public_tokenizers.PATTERN, rows).collect() for t in (coded, texts))
    assert one == other and len({r.at for r in one}) == len(one) - sum(-(-(len(made.ids) // 2 + 1) // lm.LENGTH) for made in coded.where("doc_id = 5").limit(1).collect())


def test_a_step_follows_the_plain_gradient(small):
    classes, model = small
    rng = np.random.default_rng(3)
    part = rng.integers(0, classes.rows, (11, lm.LENGTH + 1)).astype(np.int32)
    part[2, 9:] = part[7, 1:] = -1
    start = {k: v.astype(float) for k, v in model.weights.items()}

    def loss(w):
        total = 0.0
        for window in part:
            for at in np.flatnonzero(window[1:] >= 0):
                e = w["ids"][window[:at + 1]]
                a = np.exp(e[:, 8:16] @ e[-1, :8] + w["distance"][np.arange(at, -1, -1)])
                z = np.concatenate([a / a.sum() @ e[:, 16:24], e[-1, 24:]]) @ w["out"] + w["bias"]
                total += np.log(np.exp(z).sum()) - z[classes.class_of[window[at + 1]]]
        return total / (part[:, 1:] >= 0).sum()

    trainer = lm.Trainer(model.weights, classes.class_of)
    trainer.step(np.repeat(part, 3, 0))  # a larger batch first, so that the next one is a part of the room it made
    fresh = lm.Trainer(model.weights, classes.class_of)
    trainer.weights, trainer.seen = fresh.weights, fresh.seen
    trainer.step(part)
    for name, rate in (("ids", lm.RATE), ("out", 0.5 * lm.RATE), ("bias", 0.5 * lm.RATE), ("distance", 0.5 * lm.RATE)):
        moved = (trainer.weights[name] - model.weights[name]) / -rate
        for _ in range(6):
            where = (part[rng.integers(0, 2), rng.integers(0, 8)], rng.integers(0, lm.WIDTH)) if name == "ids" else tuple(rng.integers(0, n) for n in start[name].shape)
            sides = []
            for change in (1e-5, -1e-5):
                w = {k: v.copy() for k, v in start.items()}
                w[name][where] += change
                sides.append(loss(w))
            g = (sides[0] - sides[1]) / 2e-5
            assert moved[where] == pytest.approx(g / math.sqrt(1e-4 + g * g), rel=2e-2, abs=2e-4)
