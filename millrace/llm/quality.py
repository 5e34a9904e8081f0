"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a feature vector x is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``. Pairs are never formed: for
each factor their sum is ``((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2``, linear in the number of features.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_fold, map_slices, with_text, worker_state
from millrace.llm.labelled import MAX_CHARS, MAX_ROWS, labelled_sample

WORD_BUCKETS, FACTORS = 1 << 16, 8
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.1, 1e-5
#: Distinct words whose buckets a worker keeps.
MAX_WORDS = 200_000
FOLDS, HELD_OUT_FOLD = 5, 0

#: Shares of a text's bytes that each of these classes holds.
BYTE_CLASSES = [b" \t", b"\n", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b".,;:?", b"!", b"#*$%&|<>", b"|", b"(){}[]\"'", bytes(range(128, 256))]
_CLASS_OF = np.array([[float(b in group) for group in BYTE_CLASSES] for b in range(256)])
STATISTICS = len(BYTE_CLASSES) + 9
_END = re.compile(r"[.!?:;\"')\]…”»][ \t\r]*$", re.M)


def statistics(text: str, words: list[str]) -> list[float]:
    """Structure of a text and, last, its size: what stands for metadata."""
    data = np.frombuffer(text.encode(), np.uint8)
    shares = np.bincount(data, minlength=256) @ _CLASS_OF / max(1, len(data))
    lines = [x for x in text.split("\n") if x.strip()]
    n, n_lines = max(1, len(words)), max(1, len(lines))
    return [*shares, len(set(words)) / n, sum(map(eq, words, words[1:])) / n, sum(map(len, words)) / n / 10, len(_END.findall(text)) / n_lines,
            1 - len(set(lines)) / n_lines, len(words) / n_lines / 50, max(map(len, lines), default=0) / max(1, len(text)), np.log1p(n_lines) / 5,
            np.log1p(len(text)) / 10]


@dataclass
class Machine:
    """Weights and factors: one row per word bucket, then one per statistic; factors follow the weight in a row."""

    bias: float
    rows: np.ndarray  # (WORD_BUCKETS + STATISTICS, 1 + FACTORS)
    mean: np.ndarray
    scale: np.ndarray

    def logits(self, words: list[np.ndarray], stats: np.ndarray) -> np.ndarray:
        """Scores of texts from the buckets of their distinct words and their statistics."""
        sizes = np.array([len(w) for w in words])
        x = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)[:, None]
        # a zero row at the end of every text keeps empty texts in place
        values = np.zeros((sizes.sum() + len(words), 1 + FACTORS))
        starts = np.cumsum(sizes + 1) - sizes - 1
        if sizes.sum():
            at = np.arange(sizes.sum()) + np.repeat(np.arange(len(words)), sizes)
            values[at] = self.rows[np.concatenate(words)] * x
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        tail = self.rows[WORD_BUCKETS:]
        total = np.add.reduceat(values, starts) + z @ tail
        squares = np.add.reduceat(values**2, starts) + z**2 @ tail**2
        return self.bias + total[:, 0] + (total[:, 1:] ** 2 - squares[:, 1:]).sum(1) / 2


def bucket(word: str) -> int:
    return crc32(word.encode()) % WORD_BUCKETS


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss by Adagrad over shuffled batches."""
    rng = np.random.default_rng(seed)
    rate = np.clip(np.mean([y for _, y in sample]) if sample else 0.5, 0.001, 0.999)
    rows = np.zeros((WORD_BUCKETS + STATISTICS, 1 + FACTORS))
    rows[:, 1:] = rng.normal(0, 0.05, (len(rows), FACTORS))
    if not sample:
        rows[:, 1:] = 0
        return Machine(0.0, rows, np.zeros(STATISTICS), np.ones(STATISTICS))
    split = [t.split() for t, _ in sample]
    stats = np.array([statistics(t, w) for (t, _), w in zip(sample, split)])
    machine = Machine(float(np.log(rate / (1 - rate))), rows, stats.mean(0), stats.std(0) + 1e-3)
    buckets = [np.array([bucket(w) for w in set(ws)], np.int64) for ws in split]
    labels = np.array([y for _, y in sample], np.float64)
    z_all = np.clip((stats - machine.mean) / machine.scale, -5, 5)
    seen, seen_bias = np.full((len(rows), 1), 1e-3), 1e-3
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(sample)), max(1, len(sample) // BATCH)):
            words = [buckets[i] for i in part]
            off = 1 / (1 + np.exp(-machine.logits(words, stats[part]))) - labels[part]
            sizes = np.array([len(w) for w in words])
            owner = np.repeat(np.arange(len(part)), sizes)
            ids = np.concatenate(words)
            x = (1 / np.sqrt(np.maximum(sizes, 1)))[owner][:, None]
            z, tail = z_all[part], rows[WORD_BUCKETS:]
            vx = rows[ids, 1:] * x
            total = np.stack([np.bincount(owner, vx[:, k], len(part)) for k in range(FACTORS)], 1) + z @ tail[:, 1:]
            # gradient of a row: x for the weight, x * (total - v x) for the factors
            grad = np.hstack([x, x * (total[owner] - vx)]) * off[owner][:, None]
            hit, which = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(which, grad[:, k], len(hit)) for k in range(1 + FACTORS)], 1) / len(part)
            zo = z * off[:, None]
            grad_tail = np.hstack([zo.sum(0)[:, None], zo.T @ total - (z**2 * off[:, None]).sum(0)[:, None] * tail[:, 1:]]) / len(part)
            for at, g in ((hit, grad), (np.arange(WORD_BUCKETS, len(rows)), grad_tail)):
                g += DECAY * rows[at]
                seen[at] += (g**2).mean(1, keepdims=True)
                rows[at] -= RATE * g / np.sqrt(seen[at])
            seen_bias += off.mean() ** 2
            machine.bias -= RATE * off.mean() / np.sqrt(seen_bias)
    machine.rows = rows.astype(np.float32)
    return machine


class Scorer:
    def __init__(self, machine: Machine):
        self.machine = machine
        self.buckets: dict[str, int] = {}

    def scores(self, texts: list[str]) -> list[float]:
        if len(self.buckets) > MAX_WORDS:
            self.buckets.clear()
        split = [t.split() for t in texts]
        sets = [set(words) for words in split]
        self.buckets.update({w: bucket(w) for words in sets for w in words if w not in self.buckets})
        get = self.buckets.__getitem__
        words = [np.fromiter(map(get, s), np.int64, len(s)) for s in sets]
        logits = self.machine.logits(words, np.array([statistics(t, w) for t, w in zip(texts, split)]))
        return (1 / (1 + np.exp(-np.clip(logits, -500, 500)))).tolist()


def _fitted(documents: DataFrame, labels: DataFrame, folds: int, held_out: int, max_rows: int, max_chars: int):
    """A function from texts to scores that travels to the tasks with the broadcast machine."""
    machine = train(labelled_sample(documents, labels, "quality", ~in_fold("doc_id", folds, held_out), max_rows, max_chars))
    sent = documents.sparkSession.sparkContext.broadcast(machine)  # its size is fixed by the buckets
    key = ("quality", machine.bias, float(machine.rows.sum()), float(machine.mean.sum()))
    return lambda texts: worker_state(key, lambda: Scorer(sent.value)).scores(texts)


def score_quality(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT_FOLD, threshold: float = 0.3,
                  max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per row: doc_id, held_out, score (probability of label ``quality`` = 1), predicted (1 from ``threshold`` on).

    Fitted on at most ``max_rows`` labelled texts of ``max_chars`` characters in all, whose id is not held out. Empty and
    null texts are scored by their statistics alone; without labels every score is 0.5. Repeated rows score alike; a null
    id is not held out; an empty table gives no rows; only doc_id and text are read.
    """
    scores = _fitted(documents, labels, folds, held_out, max_rows, max_chars)

    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": pa.array(scores(batch.column("text").to_pylist()), pa.float64())}

    scored = map_slices(with_text(documents), work, "doc_id long, score double")
    return scored.select("doc_id", in_fold("doc_id", folds, held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = FOLDS, held_out: int = HELD_OUT_FOLD,
              max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """``documents`` without the rows that score under ``threshold``: every column stays as it is, nothing is shuffled."""
    scores = _fitted(documents, labels, folds, held_out, max_rows, max_chars)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [s >= threshold for s in scores([t or "" for t in batch.column("text").to_pylist()])]
        return batch.filter(pa.array(good, pa.bool_()))

    return map_slices(documents, work, documents.schema)
