"""Language-model scores: causal self-attention over subword ids, trained in numpy.

Words are cut into ids of a public byte-level vocabulary. Each id has a query, a key, a value and an embedding; one
head of attention with learnt distance weights looks back over the window, and a softmax over classes of ids
follows from what it gathers and from the last id. Within a class, ids have smoothed corpus probabilities given
the class before; ids without vectors of their own share one and are told apart by their smoothed counts. A text is scored in windows that overlap: every id is predicted once, with eight to 31 ids before
its own predecessor in view, and many windows go through one masked batch.

What is gathered from the corpus grows with it: word counts, id pairs and classes cover all training texts; the
attention is trained on consecutive windows that make every id of its texts, the end included, a goal once a round.
Windows are dealt to parts of about PART_WINDOWS by a hash of text, id and place, and sorted there, so that training is
the same however the table is laid out; the parts' weights are averaged over a tree, some rounds in a row.
"""

from __future__ import annotations

import base64
import hashlib
import math
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_fold, raw_texts, with_text, worker_state
from millrace.session import materialize

FOLDS, HELD_OUT_FOLD = 7, 2
#: Most frequent words whose probabilities every task holds; the others meet their counts by a join.
HEAD_WORDS = 200_000
#: Ids with vectors of their own (the rest share one), classes of one frequent id each, classes of similar rarer ids.
OWN_IDS, SINGLE_CLASSES, SHARED_CLASSES = 8_191, 96, 32
CLASSES = SINGLE_CLASSES + SHARED_CLASSES
#: Width of queries, keys and values; of embeddings; ids a window predicts when scoring, and ids it only looks back to.
HEAD_WIDTH, LAST_WIDTH, STRIDE, BACK = 8, 16, 24, 8
LENGTH = STRIDE + BACK
WIDTH = 3 * HEAD_WIDTH + LAST_WIDTH
#: Windows that a task sends at once while it cuts texts.
SENT_WINDOWS = 8_192
ROUNDS, BATCH, RATE = 2, 64, 0.1
#: Windows that one task trains on in a round, on average.
PART_WINDOWS = 65_536
#: Words whose ids a worker keeps, ids that are counted at once, bytes of text that are cut into words at once (one text at least).
MAX_WORDS, FLUSH_IDS, BLOCK_BYTES = 300_000, 1_000_000, 1 << 21
MASKED = np.float32(-1e9)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of batches with about BLOCK_BYTES in a column, or one longer text."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case (A-Z) words of texts between ASCII white space, text after text, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, at = lists.flatten(), lists.offsets.to_numpy()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end of a text leaves an empty one
    before = np.append(0, np.cumsum(real))
    return words.filter(pa.array(real)), np.diff(before[at])


# ---- counts of words and of pairs of ids ----------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all texts; tasks count slices for themselves first, and Spark adds these up before it sends them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            counts = pc.value_counts(split_words(part.column("text"))[0])
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, as many whole classes of frequency as make up to ``most`` words.

    Classes are the counts themselves up to 1024, then 64 to each doubling: a histogram of bounded size finds the least
    frequency, and no task sorts or gathers the words of the corpus.
    """
    n = F.col("n")
    level = F.when(n < 1024, n).otherwise(1024 + F.floor(F.log2(n / 1024) * 64)).cast("long")
    left, least = most, None
    for row in sorted(words.groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        left -= row["count"]
        if left < 0:
            break
        least = row.level
    return words.where(F.lit(False) if least is None else level >= least)


class Vocabulary:
    """Ids of words by a public tokenizer: a word is encoded with a space before it. The last id ends a text."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.kind = np.dtype(np.uint16 if self.end < 1 << 16 else np.int32)
        self.starts_word = np.zeros(self.end + 1, bool)
        self.starts_word[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.starts_word[self.end] = True

    def ids(self, word: bytes) -> list[int]:
        return self.encoding.encode_ordinary(" " + word.decode())


def vocabulary(ranks_file: bytes, pattern: str) -> Vocabulary:
    return worker_state(("words", hashlib.sha256(ranks_file).digest(), pattern), lambda: Vocabulary(ranks_file, pattern))


def pair_counts(words: DataFrame, ranks, pattern: str) -> DataFrame:
    """before, id, n: how often an id follows another within a word (before is -1 at its start), over all counted words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, keys, times, held = vocabulary(ranks.value, pattern), [], [], 0
        base = vocab.end + 1

        def flush() -> pa.RecordBatch:
            key, which = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, which, np.concatenate(times))
            return pa.RecordBatch.from_pydict({"before": (key // base - 1).astype(np.int32), "id": (key % base).astype(np.int32), "n": n})

        for batch in batches:
            lists = list(map(vocab.ids, raw_texts(batch, "word")))
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int64, sizes.sum())
            before = np.append(0, ids[:-1] + 1)[:len(ids)]
            before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
            keys.append(before * base + ids)
            times.append(np.repeat(batch.column("n").to_numpy(), sizes))
            held += len(ids)
            if held > FLUSH_IDS:
                yield flush()
                keys, times, held = [], [], 0
        if keys:
            yield flush()

    return words.mapInArrow(run, "before int, id int, n long").groupBy("before", "id").agg(F.sum("n").alias("n"))


class Classes:
    """Rows (ids with vectors of their own, one for the rest), their classes, and log10 probabilities within a class."""

    def __init__(self, vocab: Vocabulary, counts: np.ndarray):
        """``counts``: of each id in all training texts, the end of a text included."""
        self.size = len(counts)
        order = np.argsort(-counts, kind="stable")
        order = order[counts[order] > 0][:OWN_IDS]
        self.rows = len(order) + 1
        self.row_of = np.full(self.size, self.rows - 1, np.int32)
        self.row_of[order] = np.arange(len(order))
        self.row_counts = np.append(counts[order], counts.sum() - counts[order].sum()).astype(np.float64)
        self.rest = max(1, self.size - len(order))
        others = np.where(self.row_of == self.rows - 1, counts + 0.5, 0)
        #: log10 of how much likelier an id without a row is than the average one of them, by corpus counts; 0 for all others.
        self.uneven = np.where(others > 0, np.log10(np.maximum(others, 0.5) * self.rest / max(others.sum(), 0.5)), 0).astype(np.float32)
        self.starts_word = np.append(vocab.starts_word[order], False)
        self.class_of = np.minimum(np.arange(self.rows), SINGLE_CLASSES).astype(np.int32)
        self.class_of[-1] = CLASSES - 1

    def group_rare(self, pairs: np.ndarray) -> None:
        """Put rarer ids that follow the same classes together: k-means on shares of the class before, by row."""
        rare = np.arange(SINGLE_CLASSES, self.rows - 1)
        groups = SHARED_CLASSES - 1  # the last class is for ids without a row
        if not len(rare):
            return
        shares = pairs[:SINGLE_CLASSES + 2, rare].T + 0.1
        shares = np.sqrt(shares / shares.sum(1, keepdims=True))
        weight = self.row_counts[rare] + 1
        centres = shares[np.linspace(0, len(rare) - 1, groups).astype(int)]
        for _ in range(15):
            near = np.argmax(shares @ centres.T - 0.5 * (centres**2).sum(1), axis=1)
            for g in range(groups):
                if (near == g).any():
                    centres[g] = np.average(shares[near == g], axis=0, weights=weight[near == g])
        self.class_of[rare] = SINGLE_CLASSES + near

    def within(self, pairs: np.ndarray) -> np.ndarray:
        """log10 probability of a row within its class, given the class before (the last line: at the start of a word)."""
        one = self.row_counts + 0.5
        mass = np.bincount(self.class_of, one, CLASSES)
        alone = one / mass[self.class_of]
        by_class = np.stack([np.bincount(self.class_of, line, CLASSES) for line in pairs])
        both = (pairs + 20 * alone) / (by_class[:, self.class_of] + 20)
        made = np.log10(both)
        made[:, -1] -= math.log10(self.rest)
        return made.astype(np.float32)


# ---- the attention model ------------------------------------------------------------------------------------------


def start_weights(classes: Classes, seed: int = 9) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    mass = np.bincount(classes.class_of, classes.row_counts + 0.5, CLASSES) + 0.5
    return {"ids": rng.normal(0, 0.3, (classes.rows, WIDTH)).astype(np.float32), "distance": np.zeros(LENGTH, np.float32),
            "out": rng.normal(0, 0.05, (HEAD_WIDTH + LAST_WIDTH, CLASSES)).astype(np.float32), "bias": np.log(mass / mass.sum()).astype(np.float32)}


def flatten(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unflatten(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    made, at = {}, 0
    for name, w in like.items():
        made[name] = flat[at:at + w.size].reshape(w.shape).astype(np.float32)
        at += w.size
    return made


def places_back(queries: int, keys: int) -> np.ndarray:
    """How far back a key is from a query; -1 for what comes later."""
    return np.maximum((np.arange(queries)[:, None] + keys - queries) - np.arange(keys), -1)


def causal(distance: np.ndarray, back: np.ndarray) -> np.ndarray:
    """What is added to attention scores: the weight of the distance back, or a mask for what comes later."""
    return np.append(distance, MASKED).astype(np.float32)[back]


_Q, _K, _V, _L = slice(0, HEAD_WIDTH), slice(HEAD_WIDTH, 2 * HEAD_WIDTH), slice(2 * HEAD_WIDTH, 3 * HEAD_WIDTH), slice(3 * HEAD_WIDTH, WIDTH)


class Trainer:
    """Adagrad over batches of windows of LENGTH + 1 rows (-1 pads): each row but the first is predicted from those before.

    Exponentials stay without their sums: what divides by them, or weighs the goals, goes to the narrow factors of a
    product instead of the wide one. The wide arrays of a step are made once and used again by the next.
    """

    def __init__(self, weights: dict[str, np.ndarray], class_of: np.ndarray):
        self.weights, self.class_of = {k: v.copy() for k, v in weights.items()}, class_of
        self.seen = {k: np.full(v.shape, 1e-4, np.float32) for k, v in weights.items()}
        self.steps = 0
        self.back = places_back(LENGTH, LENGTH)
        self.below = np.flatnonzero(self.back >= 0)
        self.room: dict[str, np.ndarray] = {}

    def _room(self, windows: int) -> Iterator[np.ndarray]:
        """Attention of places to places, its gradients, features (the last one stays 1), classes, gradients of ids."""
        if not self.room or len(self.room["a"]) < windows:
            shapes = {"a": LENGTH, "ds": LENGTH, "f": HEAD_WIDTH + LAST_WIDTH + 1, "p": CLASSES, "de": WIDTH}
            self.room = {k: np.ones((windows, LENGTH, v), np.float32) for k, v in shapes.items()}
        return (v[:windows] for v in self.room.values())

    def step(self, part: np.ndarray) -> None:
        w, seen, n = self.weights, self.seen, len(part) * LENGTH
        a, ds, f, p, de = self._room(len(part))
        real = part[:, 1:].ravel() >= 0
        rows, goal = np.maximum(part[:, :-1], 0), self.class_of.take(np.maximum(part[:, 1:], 0).ravel())
        e = w["ids"].take(rows, axis=0)
        q, k, v, h = e[..., _Q], e[..., _K], e[..., _V], f[..., :HEAD_WIDTH]
        keys, added, out = k.transpose(0, 2, 1), causal(w["distance"], self.back), np.vstack([w["out"], w["bias"]])
        a_total = _exp_rows(lambda: np.add(np.matmul(q, keys, out=a), added, out=a), a.reshape(n, LENGTH)).reshape(-1, LENGTH, 1)
        np.divide(np.matmul(a, v), a_total, out=h)
        f[..., HEAD_WIDTH:-1] = e[..., _L]
        flat = p.reshape(n, CLASSES)
        total = _exp_rows(lambda: np.matmul(f, out, out=p), flat)
        flat.reshape(-1)[np.arange(0, n * CLASSES, CLASSES) + goal] -= total
        weight = (real / (total * np.float32(max(1, real.sum())))).reshape(-1, LENGTH, 1)
        g = _outer(f * weight, p)
        grad = {"out": g[:-1], "bias": g[-1]}
        df = np.matmul(flat, w["out"].T).reshape(-1, LENGTH, HEAD_WIDTH + LAST_WIDTH)
        np.multiply(df[..., HEAD_WIDTH:], weight, out=de[..., _L])
        dh = df[..., :HEAD_WIDTH] * (weight / a_total)
        np.matmul(dh, v.transpose(0, 2, 1), out=ds)
        ds -= np.einsum("bqd,bqd->bq", dh, h)[..., None]
        ds *= a
        np.matmul(ds, k, out=de[..., _Q])
        np.matmul(ds.transpose(0, 2, 1), q, out=de[..., _K])
        np.matmul(a.transpose(0, 2, 1), dh, out=de[..., _V])
        grad["distance"] = np.bincount(self.back.take(self.below), ds.sum(0).take(self.below), LENGTH).astype(np.float32)
        for name, g in grad.items():
            seen[name] += g * g
            w[name] -= 0.5 * RATE * g / np.sqrt(seen[name])
        by = np.argsort(rows.astype(np.uint16), axis=None, kind="stable")  # at most OWN_IDS + 1 rows
        ordered = rows.ravel().take(by)
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        hit = ordered.take(first)
        # numbers are added in pairs, as complex ones
        g = np.add.reduceat(de.reshape(n, WIDTH).take(by, axis=0).view(np.complex64), first).view(np.float32)
        more = seen["ids"].take(hit, axis=0)
        more += g * g
        seen["ids"][hit] = more
        g /= np.sqrt(more, out=more)
        g *= RATE
        w["ids"][hit] -= g
        self.steps += 1

    def passes(self, windows: np.ndarray, rng: np.random.Generator, steps: int) -> None:
        """So many more steps over shuffled windows, which are all seen before one is seen again."""
        order = np.empty(0, np.int64)
        for _ in range(steps):
            if len(order) < min(BATCH, len(windows)):
                order = np.concatenate([order, rng.permutation(len(windows))])
            self.step(windows[order[:BATCH]])
            order = order[BATCH:]

    def stream(self, groups: Iterator[np.ndarray], rng: np.random.Generator) -> None:
        """One pass over groups of windows, each shuffled, without holding more than a group."""
        left = np.empty((0, LENGTH + 1), np.int32)
        for group in groups:
            left = np.concatenate([left, group[rng.permutation(len(group))]])
            whole = len(left) // BATCH * BATCH
            for at in range(0, whole, BATCH):
                self.step(left[at:at + BATCH])
            left = left[whole:]
        if len(left):
            self.step(left)


def train_windows(weights: dict[str, np.ndarray], windows: np.ndarray, class_of: np.ndarray, seed: int, steps: int | None = None) -> dict[str, np.ndarray]:
    """Weights after steps (a pass unless given) over shuffled windows that are all at hand."""
    trainer, rng = Trainer(weights, class_of), np.random.default_rng(seed)
    trainer.passes(windows, rng, math.ceil(len(windows) / BATCH) if steps is None else steps)
    return trainer.weights


class Model:
    """Scores sequences of rows. ``within`` as in :class:`Classes`."""

    def __init__(self, weights: dict[str, np.ndarray], class_of: np.ndarray, starts_word: np.ndarray, within: np.ndarray):
        self.weights, self.class_of, self.within = weights, class_of, within
        self.before = np.where(starts_word, CLASSES, -1)
        self.added = causal(weights["distance"], places_back(STRIDE, LENGTH))

    def log10(self, inputs: np.ndarray, goals: np.ndarray, sizes: np.ndarray, batch: int = 96) -> np.ndarray:
        """log10 probability of each goal given the inputs up to its place; texts of these sizes follow each other.

        A batch of windows is small enough that its scores and logits stay in the cache of a core.
        """
        w = self.weights
        out = np.vstack([w["out"], w["bias"]])
        starts = np.cumsum(sizes) - sizes
        blocks = -(-sizes // STRIDE)
        nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        base = np.repeat(starts, blocks) + nth * STRIDE
        stop = np.repeat(starts + sizes, blocks)
        goal_class = self.class_of[goals]
        made = np.empty(len(goals), np.float64)
        reach = np.arange(-BACK, STRIDE)
        # the last feature stays 1, for the bias
        a, features, classes = (np.ones((batch, STRIDE, width), np.float32) for width in (LENGTH, len(out), CLASSES))
        for at in range(0, len(base), batch):
            b = base[at:at + batch]
            place = b[:, None] + reach
            e = w["ids"].take(inputs.take(place, mode="clip"), axis=0)
            q, k, first = e[:, BACK:, _Q], e[..., _K].transpose(0, 2, 1), np.flatnonzero(nth[at:at + batch] == 0)
            s, f, p = a[:len(b)], features[:len(b)], classes[:len(b)]

            def scores() -> None:
                np.add(np.matmul(q, k, out=s), self.added, out=s)
                s[first, :, :BACK] = MASKED

            total = _exp_rows(scores, s.reshape(-1, LENGTH))
            np.divide(np.matmul(s, e[..., _V]), total.reshape(-1, STRIDE, 1), out=f[..., :HEAD_WIDTH])
            f[..., HEAD_WIDTH:-1] = e[:, BACK:, _L]
            flat = p.reshape(-1, CLASSES)
            total = _exp_rows(lambda: np.matmul(f, out, out=p), flat)
            place = place[:, BACK:].ravel()
            real = np.flatnonzero(place < np.repeat(stop[at:at + batch], STRIDE))
            place = place[real]
            made[place] = np.log(np.maximum(flat.reshape(-1).take(real * CLASSES + goal_class[place]), 1e-30)) - np.log(total[real])
        made /= math.log(10)
        before = self.before[goals]
        made += self.within[np.where(before < 0, self.class_of[inputs], before), goals]
        return made


def _exp_rows(fill: Callable[[], object], x: np.ndarray) -> np.ndarray:
    """Turns the rows of ``x``, which ``fill`` writes, into their exponentials, each up to a factor of its own; returns their sums.

    The largest of a row is taken off first only where plain exponentials would leave the range of floats.
    """
    ones = np.ones(x.shape[1], np.float32)
    fill()
    if x.max() < 60:
        total = np.exp(x, out=x) @ ones
        if total.min() > 1e-25:
            return total
        fill()
    x -= x.max(1, keepdims=True)
    return np.exp(x, out=x) @ ones


def _outer(x: np.ndarray, y: np.ndarray, block: int = 8) -> np.ndarray:
    """Sum over windows and places of the products of two vectors, in blocks of windows that the cache holds."""
    whole = len(x) // block * block
    made = np.matmul(x[:whole].reshape(-1, block * LENGTH, x.shape[2]).transpose(0, 2, 1), y[:whole].reshape(-1, block * LENGTH, y.shape[2])).sum(0)
    if whole < len(x):
        made += x[whole:].reshape(-1, x.shape[2]).T @ y[whole:].reshape(-1, y.shape[2])
    return made


class Head(dict):
    """log10 probabilities of frequent words; other words are not a number."""

    def __missing__(self, word: bytes) -> float:
        return math.nan


# ---- the jobs ------------------------------------------------------------------------------------------------------


class Words(dict):
    """Packed ids of a word; bounded."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.code = "H" if vocab.kind.itemsize == 2 else "i"

    def __missing__(self, word: bytes) -> bytes:
        made = array(self.code, self.vocab.ids(word)).tobytes()
        if len(self) >= MAX_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = made
        return made


def encode_texts(texts: DataFrame, ranks, pattern: str, counted=None) -> DataFrame:
    """What training and scoring need of every text, so that its words are cut and looked up once: doc_id, held_out (if there), ids, deal, n_tokens, known, base, rest.

    ``ids`` holds the ids of the words, as many bytes each as the vocabulary needs; ``deal`` is a hash of the text and its
    doc_id; ``rest`` has the words that ``counted`` (broadcast: :class:`Head`, log10 probability of the end and whether it
    is known) does not have, and how often each stands in the text; ``base`` sums the values of the others, ``known`` counts
    them. Each distinct word of a slice is looked up once, the rest is done on arrays.
    """
    key = ("window-words", pattern, crc32(ranks.value))
    kept = [c for c in ("doc_id", "held_out") if c in texts.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = worker_state(key, lambda: Words(Vocabulary(ranks.value, pattern)))
        head, end = (Head(), (0.0, 0)) if counted is None else counted.value
        for part in text_slices(batches):
            rows = part.num_rows
            words, n_words = split_words(part.column("text"))
            coded = words.dictionary_encode()
            which, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.binary()).to_pylist()
            own = list(map(packed.__getitem__, distinct))
            at = np.append(0, np.cumsum(n_words))
            # the packed ids of a text are those of its words, one after another
            sizes = np.append(0, np.cumsum(np.fromiter(map(len, own), np.int64, len(own))[which]))[at]
            ids = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(sizes.astype(np.int32).tobytes()), pa.py_buffer(b"".join(map(own.__getitem__, which.tolist())))])
            names = part.column("doc_id").to_pylist() if "doc_id" in kept else [None] * rows
            deal = [crc32(text, crc32(str(name).encode())) for text, name in zip(raw_texts(part), names)]
            value = np.fromiter(map(head.__getitem__, distinct), np.float64, len(distinct))[which]
            text, missing = np.repeat(np.arange(rows), n_words), np.isnan(value)
            base = end[0] + np.bincount(text, np.where(missing, 0, value), rows)
            known = end[1] + np.bincount(text[~missing], minlength=rows)
            one, times = np.unique(text[missing] * len(distinct) + which[missing], return_counts=True)
            text, name = np.divmod(one, max(1, len(distinct)))
            rest = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(name)), pa.array(times)], ["word", "times"])
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in kept} | {
                "ids": ids, "deal": pa.array(deal, pa.int64()), "n_tokens": n_words + 1, "known": known, "base": base,
                "rest": pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(rows + 1)), pa.int32()), rest)})

    types = {"doc_id": "doc_id long, ", "held_out": "held_out boolean, "}
    return texts.select("text", *kept).mapInArrow(run, "".join(types[c] for c in kept) + "ids binary, deal long, n_tokens long, known long, base double, rest array<struct<word:string,times:long>>")


def joined_ids(ids: pa.Array, vocab_end: int, kind: np.dtype, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts one after another, each with so many ends before and after it, and how many each then has."""
    sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // kind.itemsize
    own = np.frombuffer(b"".join(ids.to_pylist()), kind)
    made = np.full(len(own) + (before + after) * len(sizes), vocab_end, np.int32)
    made[np.arange(len(own)) + np.repeat(before + (before + after) * np.arange(len(sizes)), sizes)] = own
    return made, sizes + before + after


def cut_windows(rows: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place in it, and LENGTH + 1 rows of consecutive windows of texts of these sizes, SENT_WINDOWS at a time; -1 after the last row.

    A text has its end before and after it. The last row of a window is the first of the next, so that every row but the
    first is predicted once.
    """
    n = -(-(sizes - 1) // LENGTH)
    first, stop = np.cumsum(n) - n, np.cumsum(sizes)
    for at in range(0, int(n.sum()), SENT_WINDOWS):
        window = np.arange(at, min(at + SENT_WINDOWS, int(n.sum())))
        text = np.searchsorted(first, window, "right") - 1
        nth = window - first[text]
        place = ((stop - sizes)[text] + nth * LENGTH)[:, None] + np.arange(LENGTH + 1)
        yield text, nth, np.where(place < stop[text][:, None], rows.take(place, mode="clip"), rows.dtype.type(-1))


def training_windows(texts: DataFrame, ranks, pattern: str, rows) -> DataFrame:
    """One row per window of :func:`cut_windows` over every whole text: LENGTH + 1 rows of ids as two bytes each.

    ``texts`` may have gone through :func:`encode_texts` before. ``at`` is a hash of the text, its doc_id where there is one,
    and the window's place in it: copies under other ids, and windows of one long text, get other values.
    """
    coded = texts if "ids" in texts.columns else encode_texts(texts, ranks, pattern)
    vocab = vocabulary(ranks.value, pattern)
    end, kind = vocab.end, vocab.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = rows.value.astype(np.int16)  # at most OWN_IDS + 1 rows
        for part in text_slices(batches, "ids"):
            ids, sizes = joined_ids(part.column("ids"), end, kind, 1, 1)
            start = part.column("deal").to_numpy() << 31
            for text, nth, made in cut_windows(row_of.take(ids), sizes):
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * (LENGTH + 1)), len(made), [None, pa.py_buffer(made.tobytes())])
                yield pa.RecordBatch.from_pydict({"at": pa.array(start[text] ^ nth), "window": fixed.cast(pa.binary())})

    return coded.select("ids", "deal").mapInArrow(run, "at long, window binary")


def training_parts(windows: DataFrame, parts: int) -> DataFrame:
    """``part`` and ``windows``: the windows of each of so many parts in an order of their own, SENT_WINDOWS to a row.

    The rows of a part follow each other in one file, which is far smaller than a split, so they reach one task.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        part = None
        for batch in batches:
            if batch.num_rows and part is None:
                part = batch.column("part")[0].as_py()
            held += batch.column("window").to_pylist()
            while len(held) >= SENT_WINDOWS:
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "windows": [b"".join(held[:SENT_WINDOWS])]})
                held = held[SENT_WINDOWS:]
        if held:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "windows": [b"".join(held)]})

    dealt = windows.repartition(parts, "at").sortWithinPartitions("at", "window")
    return dealt.select(F.spark_partition_id().alias("part"), "window").mapInArrow(pack, "part int, windows binary")


def _average(weights: dict[str, np.ndarray], windows: DataFrame, parts: int, class_of: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """One round: each part (:func:`training_parts`) trains on from ``weights``; the results are averaged by windows, in two steps."""
    spark = windows.sparkSession
    sent = spark.sparkContext.broadcast((weights, class_of))
    fan = max(1, math.isqrt(parts))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((part, data) for batch in batches for part, data in zip(batch.column("part").to_pylist(), batch.column("windows").to_pylist()))
        for part, own in groupby(rows, key=lambda row: row[0]):
            n = 0

            def counted() -> Iterator[np.ndarray]:
                nonlocal n
                for _, data in own:
                    group = np.frombuffer(data, np.int16).reshape(-1, LENGTH + 1).astype(np.int32)
                    n += len(group)
                    yield group

            trainer = Trainer(*sent.value)
            trainer.stream(counted(), np.random.default_rng((seed, part)))
            yield pa.RecordBatch.from_pydict({"branch": pa.array([part % fan], pa.int32()), "n": pa.array([float(n)]), "weights": pa.array([flatten(trainer.weights).tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0.0, None
        for batch in batches:
            for more, data in zip(batch.column("n").to_pylist(), batch.column("weights").to_pylist()):
                n, total = n + more, np.frombuffer(data, np.float32).astype(np.float64) * more + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n]), "total": pa.array([total.tobytes()], pa.binary())})

    sums = windows.mapInArrow(fit, "branch int, n double, weights binary").repartition(fan, "branch").select("n", "weights").mapInArrow(add, "n double, total binary")
    n, total = 0.0, 0.0
    for row in sums.toLocalIterator():  # about the root of the number of partitions
        n, total = n + row.n, total + np.frombuffer(row.total)
    return unflatten(total / n, weights) if n else weights


def fit_model(train: DataFrame, words: DataFrame, ranks, pattern: str, n_texts: int) -> tuple[Classes, Model]:
    """Classes from counts over all training texts (encoded or not), then attention by rounds of averaged training."""
    spark = train.sparkSession
    vocab = vocabulary(ranks.value, pattern)
    pairs = materialize(pair_counts(words, ranks, pattern), "id-pairs")
    counts = np.zeros(vocab.end + 1)
    for r in pairs.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        counts[r.id] = r.n
    counts[vocab.end] = n_texts
    classes = Classes(vocab, counts)

    def by_class(class_of: np.ndarray) -> np.ndarray:
        """Counts of (class before, row); collected by class and row, which the vocabulary bounds."""
        names = spark.createDataFrame([(i, int(class_of[r]), int(r)) for i, r in enumerate(classes.row_of.tolist())], "id int, class int, row int")
        joined = (pairs.join(names.select("id", "row"), "id").join(names.select(F.col("id").alias("before"), "class"), "before", "left")
                  .groupBy(F.coalesce("class", F.lit(CLASSES)).alias("class"), "row").agg(F.sum("n").alias("n")))
        made = np.zeros((CLASSES + 1, classes.rows))
        for r in joined.toLocalIterator():
            made[r["class"], r.row] = r.n
        return made

    table = by_class(classes.class_of)
    classes.group_rare(np.concatenate([table[:SINGLE_CLASSES + 1], table[-1:]]))
    within = classes.within(by_class(classes.class_of))
    rows = spark.sparkContext.broadcast(classes.row_of)
    parts = max(1, round(counts.sum() / (LENGTH * PART_WINDOWS)))
    windows = materialize(training_parts(training_windows(train, ranks, pattern, rows), parts), "windows")
    weights = start_weights(classes)
    for turn in range(ROUNDS):
        weights = _average(weights, windows, parts, classes.class_of, turn)
    return classes, Model(weights, classes.class_of, classes.starts_word, within)


def score_texts(documents: DataFrame, ranks_path: str, pattern: str, folds: int = FOLDS, held_out: int = HELD_OUT_FOLD,
                head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_ids.

    Learns from the texts whose id is not held out (a null id is not). Tokens are the words between ASCII white space with
    A-Z lower-cased, then one end. ``base_score`` sums log10 of add-one smoothed training frequencies of the tokens; ``n_known``
    counts the tokens met in training. ``score`` is the attention model's log10 probability of the ids of the words and the end.
    A null or empty text is its end alone. Repeated rows are scored alike; without training texts counts are zero and the
    model is its start; an empty table gives no rows; other columns are not read.

    Frequent words (``head_words``, a bound on what is broadcast) are looked up in the tasks; all others meet their counts in
    a join of (text, word) with the count of the word in the text, so no task needs the whole vocabulary of the corpus.
    """
    spark = documents.sparkSession
    texts = with_text(documents).withColumn("held_out", in_fold("doc_id", folds, held_out))
    train = texts.where("not held_out")
    words = materialize(word_counts(train), "word-counts")
    n_texts = train.count()
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + n_texts, distinct + (n_texts > 0)
    log_all = math.log10(total + distinct + 1)
    with open(ranks_path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())
    head = Head((r.word.encode(), math.log10(r.n + 1) - log_all) for r in frequent_words(words, head_words).toLocalIterator())
    counted = spark.sparkContext.broadcast((head, (math.log10(n_texts + 1) - log_all, int(n_texts > 0))))
    coded = materialize(encode_texts(texts, ranks, pattern, counted).withColumn("row", F.monotonically_increasing_id()), "encoded")
    classes, model = fit_model(coded.where("not held_out"), words, ranks, pattern, n_texts)
    sent = spark.sparkContext.broadcast((classes.row_of, classes.uneven, model))
    vocab = vocabulary(ranks.value, pattern)
    stop, kind = vocab.end, vocab.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, uneven, model = sent.value
        for part in text_slices(batches, "ids"):
            inputs, sizes = joined_ids(part.column("ids"), stop, kind, 1, 0)
            goals, _ = joined_ids(part.column("ids"), stop, kind, 0, 1)
            scores = np.add.reduceat(model.log10(row_of[inputs], row_of[goals], sizes) + uneven[goals], np.cumsum(sizes) - sizes)
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in same} | {"score": scores, "n_ids": sizes})

    same = ("row", "doc_id", "held_out", "n_tokens", "known", "base")
    scored = coded.select(*same, "ids").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, n_ids long")
    scored = materialize(scored, "scored")
    rare = coded.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.times")
    met = (rare.join(words, "word", "left").groupBy("row")
           .agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
                F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - log_all)).alias("more_base")))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score", "n_ids")
