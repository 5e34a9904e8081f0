"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with a begin and an end mark), hashed to buckets that hold small
vectors; the bag is averaged (over WINDOW neighbouring words, one by default) and a linear softmax turns it into log odds. A text's
log odds are the log mean of the exponentials over its windows, so some bad words count in a long text too.
A misspelling shares most n-grams, and so most of the vector, with the word it comes from.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_fold, map_slices, with_text, worker_state
from millrace.llm.labelled import MAX_CHARS, MAX_ROWS, labelled_sample

BUCKETS, WIDTH, NGRAMS, WINDOW = 1 << 18, 8, (3, 4, 5), 1
EPOCHS, BATCH, RATE = 8, 32, 0.5
#: Distinct words whose log odds a worker keeps.
MAX_WORDS = 200_000
FOLDS, HELD_OUT_FOLD = 4, 2

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words, and the number of the word each belongs to."""
    codes = np.frombuffer("".join([f"\n{w}\r" for w in words]).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.cumsum(codes == 10) - 1
    buckets, owners = [], []
    for n in NGRAMS:
        if len(codes) < n:
            continue
        inside = owner[:len(codes) - n + 1] == owner[n - 1:]
        value = np.full(len(codes) - n + 1, 14695981039346656037 + n, np.uint64)
        for i in range(n):
            value = (value ^ codes[i:len(codes) - n + 1 + i]) * np.uint64(1099511628211)
        value = value[inside]
        buckets.append(((value ^ (value >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[:len(codes) - n + 1][inside])
    return (np.concatenate(buckets), np.concatenate(owners)) if buckets else (np.empty(0, np.int64), np.empty(0, np.int64))


def _window_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window over texts of these word counts, and the number of windows per text."""
    counts = -(-sizes // WINDOW)
    first = np.repeat(np.cumsum(sizes) - sizes, counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + nth * WINDOW, counts


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Log odds per bucket and the bias: embeddings times softmax weights after joint training with Adagrad."""
    rng = np.random.default_rng(seed)
    rate = np.clip(np.mean([y for _, y in sample]) if sample else 0.5, 0.001, 0.999)
    bias = np.array([0.0, np.log(rate / (1 - rate))], np.float64)
    table = rng.uniform(-1, 1, (BUCKETS, WIDTH)).astype(np.float32) / WIDTH
    soft = np.zeros((WIDTH, 2), np.float32)
    soft[:, 1] = rng.normal(0, 1 / np.sqrt(WIDTH), WIDTH)
    numbers: dict[str, int] = {}
    texts = [(np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int64), y) for t, y in sample]
    texts = [(ids, y) for ids, y in texts if len(ids)]
    grams, owner = word_grams(list(numbers))
    order = np.argsort(owner, kind="stable")
    grams, per_word = grams[order], np.bincount(owner, minlength=len(numbers))
    begin = np.cumsum(per_word) - per_word
    sum_table, sum_soft, sum_bias = np.full(BUCKETS, 1e-6, np.float32), np.full((WIDTH, 2), 1e-6), np.full(2, 1e-6)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            if not len(part):
                continue
            sizes = np.array([len(texts[i][0]) for i in part])
            y = np.array([texts[i][1] for i in part], np.float64)
            words, inverse = np.unique(np.concatenate([texts[i][0] for i in part]), return_inverse=True)
            count = per_word[words]
            starts = np.cumsum(count) - count
            own = grams[np.repeat(begin[words] - starts, count) + np.arange(count.sum())]
            vectors = np.add.reduceat(table[own], starts) / count[:, None]
            at, windows = _window_starts(sizes)
            width = np.diff(np.append(at, sizes.sum()))
            means = np.add.reduceat(vectors[inverse], at) / width[:, None]
            odds = (means @ (soft[:, 1] - soft[:, 0])).astype(np.float64)
            first = np.cumsum(windows) - windows
            top = np.maximum.reduceat(odds, first)
            weight = np.exp(odds - np.repeat(top, windows))
            total = np.add.reduceat(weight, first)
            p = 1 / (1 + np.exp(-(top + np.log(total / windows) + bias[1] - bias[0])))
            off = np.where(np.abs(p - y) < 0.01, 0, p - y)
            if not off.any():
                continue
            slope = (np.repeat(off / total, windows) * weight)
            # softmax weights and bias: the two classes' gradients are opposite
            g = means.T @ slope
            both = np.stack([-g, g], 1)
            sum_soft += both**2
            back = np.outer(slope, soft[:, 1] - soft[:, 0]).astype(np.float32)
            soft -= (0.1 * RATE * both / np.sqrt(sum_soft)).astype(np.float32)
            gb = np.array([-off.sum(), off.sum()])
            sum_bias += gb**2
            bias -= 0.1 * RATE * gb / np.sqrt(sum_bias)
            live = np.flatnonzero(np.abs(slope) > 1e-5)
            pos = np.concatenate([np.arange(at[k], at[k] + width[k]) for k in live]) if len(live) else np.empty(0, np.int64)
            to_word = inverse[pos]
            from_window = np.repeat(back[live] / width[live, None], width[live], axis=0)
            hit, which = np.unique(to_word, return_inverse=True)
            word_grad = np.stack([np.bincount(which, from_window[:, k], len(hit)) for k in range(WIDTH)], 1) / count[hit, None]
            ids = np.concatenate([own[starts[h]:starts[h] + count[h]] for h in hit]) if len(hit) else np.empty(0, np.int64)
            spread = np.repeat(word_grad, count[hit], axis=0)
            buckets, which = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(which, spread[:, k], len(buckets)) for k in range(WIDTH)], 1)
            sum_table[buckets] += (grad**2).mean(1)
            table[buckets] -= (RATE * grad / np.sqrt(sum_table[buckets])[:, None]).astype(np.float32)
    return (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


class Scorer:
    """Probabilities of texts, with the log odds of known words kept."""

    def __init__(self, bucket_odds: np.ndarray, bias: float):
        self.bucket_odds, self.bias = bucket_odds, bias
        self.word_odds: dict[str, float] = {}

    def learn_words(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.word_odds]
        if new:
            grams, owner = word_grams(new)
            count = np.maximum(np.bincount(owner, minlength=len(new)), 1)
            self.word_odds.update(zip(new, (np.bincount(owner, self.bucket_odds[grams], len(new)) / count).tolist()))

    def scores(self, texts: list[str]) -> list[float]:
        if len(self.word_odds) > MAX_WORDS:
            self.word_odds.clear()
        split = [words_of(t) for t in texts]
        self.learn_words({w for words in split for w in words})
        get, made = self.word_odds.__getitem__, []
        for words in split:
            odds = 0.0
            if words:
                values = np.fromiter(map(get, words), np.float64, len(words))
                at = np.arange(0, len(words), WINDOW)
                means = np.add.reduceat(values, at) / np.minimum(WINDOW, len(words) - at)
                top = means.max()
                odds = top + np.log(np.exp(means - top).mean())
            made.append(float(1 / (1 + np.exp(-(odds + self.bias)))))
        return made


def score_toxicity(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT_FOLD, threshold: float = 0.3,
                   max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per row: doc_id, held_out, score (probability of label ``toxic`` = 1), predicted (1 from ``threshold`` on).

    Fitted on at most ``max_rows`` labelled texts of ``max_chars`` characters in all, whose id is not held out. A null
    or empty text, or one without words, scores the learnt base rate; without labels all score alike at 0.5 or so.
    Repeated rows score alike; a null id is not held out; an empty table gives no rows; only doc_id and text are read.
    """
    bucket_odds, bias = train(labelled_sample(documents, labels, "toxic", ~in_fold("doc_id", folds, held_out), max_rows, max_chars))
    sent = documents.sparkSession.sparkContext.broadcast((bucket_odds, bias))  # one float per bucket
    key = ("toxicity", sent.value[1], float(bucket_odds.sum()), float(np.abs(bucket_odds).sum()))

    def work(batch: pa.RecordBatch) -> dict:
        scorer = worker_state(key, lambda: Scorer(*sent.value))
        return {"doc_id": batch.column("doc_id"), "score": pa.array(scorer.scores(batch.column("text").to_pylist()), pa.float64())}

    scored = map_slices(with_text(documents), work, "doc_id long, score double")
    return scored.select("doc_id", in_fold("doc_id", folds, held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
