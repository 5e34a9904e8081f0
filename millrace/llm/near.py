"""Near duplicates by a chosen-path similarity join on sets of word shingles.

A text is the set of its runs of five words. Sets that are equal are joined first and stand as one from then on. Each
set is embedded as MinHash tokens: of a pair with Jaccard similarity s, a token is shared with probability s. Buckets of
sets are split on sampled tokens, again and again: a set goes on to one bucket for each sampled position, named by the path
so far and its token there; positions are sampled 1/threshold at a time, by a hash of the path, so similar pairs stay
together in one bucket per level on average. Small buckets are compared by brute force. The whole is run as often as the
wanted recall needs. A large bucket that a split leaves nearly whole, or that is large after the last level, holds sets that are
nearly alike, and every run finds it again; such buckets are joined where they share sets, and each of these
families is compared once and wholly, a pair of blocks at a time.

A group first drops sets whose compact sketches have no likely partner in it; only the rest is compared exactly, on the
shingles of their texts. A pair counts in its family if it has one, else in the bucket with the smallest name of those in which it
meets, so links are counted without ever writing pairs.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, with_text, worker_state
from millrace.session import materialize

SHINGLE_WORDS, THRESHOLD = 5, 0.8
#: MinHash tokens of a set, levels of splitting, largest bucket that is compared as it is, rows of a family's block.
TOKENS, LEVELS, LEAF_ROWS, BLOCK_ROWS = 64, 5, 256, 512
#: A large bucket is not split again once it holds this share of the bucket it came from.
STAYS_WHOLE = 0.7
#: Wanted chance that a pair at the threshold meets in some bucket and is compared.
RECALL = 0.9999
#: Sketch bytes that must agree for a pair to be compared exactly: four deviations under what the threshold gives.
MIN_AGREE = math.floor(TOKENS * THRESHOLD - 4 * math.sqrt(TOKENS * THRESHOLD * (1 - THRESHOLD)))
#: Distinct words whose hashes a worker keeps.
MAX_WORDS = 200_000
KEY = ["k1", "k2", "n_shingles"]

_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Shingle hashes and MinHash tokens; word hashes are kept."""

    def __init__(self):
        self.hashes: dict[str, int] = {}
        rng = np.random.default_rng(11)
        self.multipliers = rng.integers(0, 2**63, TOKENS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = rng.integers(0, 2**63, TOKENS, np.uint64)

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct hashes of the runs of five lower-case words; a shorter text is one run, no words none."""
        words = _WORD.findall(text.lower())
        if not words:
            return np.empty(0, np.uint64)
        if len(self.hashes) > MAX_WORDS:
            self.hashes.clear()
        known = self.hashes
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(ids) - SHINGLE_WORDS + 1)
        run = np.zeros(n, np.uint64)
        for i in range(min(SHINGLE_WORDS, len(ids))):
            run = (run + ids[i:i + n]) * _ODD
            run ^= run >> np.uint64(29)
        return np.unique(_mix(run))

    def tokens(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest hashed shingle under each of the functions, as 32 bits."""
        low = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[at:at + 2048, None] * self.multipliers + self.offsets
            low = np.minimum(low, part.min(0))
        return (_mix(low) >> np.uint64(32)).astype(np.uint32)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def set_key(shingles: np.ndarray) -> tuple[int, int, int]:
    """A key of 128 bits and the size that equal sets share."""
    return _signed(int(shingles.sum(dtype=np.uint64))), _signed(int(_mix(shingles ^ _ODD).sum(dtype=np.uint64))), len(shingles)


def _shingler() -> Shingler:
    return worker_state(("shingler",), Shingler)


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, the key of the shingle set, its MinHash tokens and their low bytes as a sketch."""

    def work(batch: pa.RecordBatch) -> dict:
        shingler = _shingler()
        keys, tokens = [], []
        for text in batch.column("text").to_pylist():
            shingles = shingler.shingles(text)
            keys.append(set_key(shingles))
            tokens.append(shingler.tokens(shingles))
        k1, k2, n = zip(*keys) if keys else ((), (), ())
        return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()),
                "n_shingles": pa.array(n, pa.int64()), "tokens": pa.array([t.view(np.int32) for t in tokens], pa.list_(pa.int32())),
                "sketch": pa.array([t.astype(np.uint8).tobytes() for t in tokens], pa.binary())}

    return map_slices(with_text(documents, F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")), work,
                      "doc_id long, text_key long, k1 long, k2 long, n_shingles long, tokens array<int>, sketch binary")


def meeting_chance(similarity: float, levels: int, threshold: float = THRESHOLD) -> float:
    """Chance that a pair still shares a bucket of one run after so many levels.

    One position is sampled at every node, and a second one with the chance that makes 1/threshold on average.
    """
    second, chance = 1 / threshold - 1, 1.0
    for _ in range(levels):
        one = similarity * chance
        chance = (1 - second) * one + second * (1 - (1 - one) ** 2)
    return chance


def pair_recall(runs: int, levels: int = LEVELS, threshold: float = THRESHOLD) -> float:
    """Chance that a pair at the threshold shares a bucket of some run and is compared.

    All runs split on the same tokens: the number that a pair shares is binomial, and only given that number are runs
    independent. Pairs that share fewer than MIN_AGREE count as missed.
    """
    return sum(math.comb(TOKENS, m) * threshold**m * (1 - threshold) ** (TOKENS - m) * (1 - (1 - meeting_chance(m / TOKENS, levels, threshold)) ** runs)
               for m in range(MIN_AGREE, TOKENS + 1))


def runs_needed(recall: float = RECALL, levels: int = LEVELS, threshold: float = THRESHOLD) -> int:
    if recall > pair_recall(10_000, levels, threshold):
        raise ValueError(f"no number of runs reaches {recall}: too many pairs share fewer than {MIN_AGREE} tokens")
    runs = 1
    while pair_recall(runs, levels, threshold) < recall:
        runs += 1
    return runs


def root_positions(runs: int, seed: int) -> list[tuple[int, int]]:
    """(run, position) of the tokens on which the runs split all sets first."""
    rng = random.Random(seed)
    return [(run, at) for run in range(runs) for at in rng.sample(range(TOKENS), 1 + (rng.random() < 1 / THRESHOLD - 1))]


def _bucketed(rows: DataFrame, label: str) -> DataFrame:
    """path, row, parent, size of the rows whose bucket holds another row too; paths are made once and written."""
    rows = materialize(rows, f"{label}-made")
    sizes = rows.groupBy("path").count().where("count > 1").withColumnRenamed("count", "size")
    return materialize(rows.join(sizes, "path"), label)


def _children(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """The next level's path, row, parent (size of the bucket they come from) of the rows of large buckets."""
    path = F.col("path")
    first = F.pmod(F.xxhash64(path, F.lit("first")), F.lit(TOKENS)).cast("int")
    other = F.pmod(first + 1 + F.pmod(F.xxhash64(path, F.lit("other")), F.lit(TOKENS - 1)).cast("int"), F.lit(TOKENS)).cast("int")
    both = F.pmod(F.xxhash64(path, F.lit("both")), F.lit(1 << 20)) < int((1 / THRESHOLD - 1) * (1 << 20))

    def child(at: Column) -> Column:
        return F.xxhash64(path, at, F.get("tokens", at))

    paths = F.when(both, F.array(child(first), child(other))).otherwise(F.array(child(first)))
    return rows.join(tokens, "row").select(F.explode(paths).alias("path"), "row", F.col("size").alias("parent"))


def find_buckets(sets: DataFrame, runs: int, levels: int, leaf_rows: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(leaf, row) of the small buckets, and (leaf, row) of the large ones that splitting does not take apart."""
    roots = F.array(*[F.xxhash64(F.lit(run), F.lit(at), F.get("tokens", F.lit(at))) for run, at in root_positions(runs, seed)])
    level = _bucketed(sets.select(F.explode(roots).alias("path"), "row", F.lit(None).cast("long").alias("parent")), "paths-1")
    small, whole = [], []
    for depth in range(2, levels + 2):
        small.append(level.where(F.col("size") <= leaf_rows))
        large = level.where(F.col("size") > leaf_rows)
        stays = F.coalesce(F.col("size") >= STAYS_WHOLE * F.col("parent"), F.lit(False)) | F.lit(depth > levels)
        whole.append(large.where(stays))
        split = large.where(~stays)
        if split.isEmpty():
            break
        level = _bucketed(_children(split, sets.select("row", "tokens")), f"paths-{depth}")

    def union(parts: list[DataFrame], label: str) -> DataFrame:
        made = parts[0]
        for more in parts[1:]:
            made = made.unionByName(more)
        return materialize(made.select(F.col("path").alias("leaf"), "row"), label)

    return union(small, "small-buckets"), union(whole, "large-buckets")


def find_families(large: DataFrame) -> DataFrame:
    """row, family: large buckets that share sets belong to one family."""
    if large.isEmpty():
        return large.select("row", F.col("leaf").alias("family"))
    heads = large.groupBy("leaf").agg(F.min("row").alias("v"))
    return components(large.join(heads, "leaf").select(F.col("row").alias("u"), "v").distinct(), loops=True).select("row", F.col("label").alias("family"))


def _groups(small: DataFrame, families: DataFrame, block_rows: int) -> DataFrame:
    """leaf, row, a, b, block: a small bucket is one group (a and b are -1), a family one for each pair of its blocks."""
    whole = small.select("leaf", "row", F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.lit(0).alias("block"))
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("row", F.lit("block")), F.col("blocks")).cast("int")
    dealt = families.join(sizes, "family").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return whole.unionByName(dealt.select(F.col("family").alias("leaf"), "row", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block"))


def _by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by the keys; a table is about a batch, a group is never cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == v
        cut = int(np.argmax(same))  # first row of the last group
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif held and any(held[-1].column(k)[held[-1].num_rows - 1].as_py() != v for k, v in zip(keys, last)):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups begin, and the end."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), n)


GROUP = ["leaf", "a", "b"]


def _likely_pairs(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of each group with any: its bounds, and the pairs whose sketches agree enough and which belong to this bucket."""
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, TOKENS)
    block, a, b = (table.column(k).to_numpy() for k in ("block", "a", "b"))
    leaf, leaves = table.column("leaf").to_numpy(), table.column("leaves").combine_chunks()
    ends, flat, family = leaves.offsets.to_numpy(), leaves.values.to_numpy(), table.column("family").to_numpy()
    bounds = _bounds(table, GROUP)
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    left, right = [], []
    here = np.arange(len(group))
    for step in range(1, int(np.diff(bounds).max())):
        here = here[:np.searchsorted(here, len(group) - step)]
        here = here[group[here] == group[here + step]]
        met = here[(a[here] == b[here]) | (block[here] != block[here + step])]
        agree = np.count_nonzero(sketch[met] == sketch[met + step], axis=1) >= MIN_AGREE
        left.append(met[agree])
        right.append(met[agree] + step)
    if not left:
        return
    left, right = np.concatenate(left), np.concatenate(right)
    order = np.argsort(group[left], kind="stable")
    left, right = left[order], right[order]
    cuts = np.searchsorted(group[left], np.arange(len(bounds)))
    for g in np.unique(group[left]):
        i, j = left[cuts[g]:cuts[g + 1]], right[cuts[g]:cuts[g + 1]]
        own = np.ones(len(i), bool)
        if a[bounds[g]] < 0:
            own = ((family[i] != family[j]) | (family[i] < 0)) & _first_meeting(leaf[bounds[g]], bounds[g], bounds[g + 1], ends, flat, i, j)
        if own.any():
            yield int(bounds[g]), int(bounds[g + 1]), i[own], j[own]


def _first_meeting(leaf: int, low: int, high: int, ends: np.ndarray, flat: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs share no bucket with a smaller name than this one."""
    if len(i) <= 64:
        lists = {r: {x for x in flat[ends[r]:ends[r + 1]].tolist() if x < leaf} for r in {*i.tolist(), *j.tolist()}}
        return np.array([lists[x].isdisjoint(lists[y]) for x, y in zip(i.tolist(), j.tolist())], bool)
    values, owner = flat[ends[low]:ends[high]], np.repeat(np.arange(high - low), np.diff(ends[low:high + 1]))
    owner, values = owner[values < leaf], values[values < leaf]
    names, which, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = np.zeros((high - low, high - low), bool)
    keep = np.flatnonzero(count > 1)
    place = np.full(len(names), -1)
    place[keep] = np.arange(len(keep))
    for at in range(0, len(keep), 1024):
        inside = (place[which] >= at) & (place[which] < at + 1024)
        member = np.zeros((high - low, min(1024, len(keep) - at)), np.float32)
        member[owner[inside], place[which[inside]] - at] = 1
        shared |= member @ member.T > 0
    return ~shared[i - low, j - low]


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """leaf, a, b, row, block of the rows with a likely partner that is theirs to find."""
    columns = ["leaf", "a", "b", "row", "block"]
    for table in _by_group(batches, GROUP):
        keep = [np.concatenate([i, j]) for _, _, i, j in _likely_pairs(table)]
        if keep:
            yield from table.select(columns).take(np.unique(np.concatenate(keep))).to_batches()


def _overlaps(low: int, high: int, shingles: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs' shingle sets."""
    if len(i) < 200:
        return np.array([len(np.intersect1d(shingles[x], shingles[y], True)) for x, y in zip(i.tolist(), j.tolist())], np.int64)
    rows = np.unique(np.concatenate([i, j]))
    place = np.full(high - low, -1)
    place[rows - low] = np.arange(len(rows))
    sizes = [len(shingles[r]) for r in rows]
    names, which, count = np.unique(np.concatenate([shingles[r] for r in rows]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    column = np.cumsum(count > 1) - 1  # shingles of one set alone are in no intersection
    live = count[which] > 1
    owner, column = owner[live], column[which[live]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(rows), len(rows)), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        member = np.zeros((len(rows), width), np.float32)
        member[owner[lo:hi], column[lo:hi] - at] = 1
        both += member @ member.T
    return both[place[i - low], place[j - low]].astype(np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, links, root: documents linked to a set by pairs of this bucket, and a set it is joined to."""
    for table in _by_group(batches, GROUP):
        rows, copies = table.column("row").to_numpy(), table.column("copies").to_numpy()
        lists = table.column("shingles").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        shingles = [flat[x:y] for x, y in zip(ends[:-1], ends[1:])]
        sizes = np.diff(ends)
        links = np.zeros(table.num_rows, np.int64)
        root = np.arange(table.num_rows)

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for low, high, i, j in _likely_pairs(table):
            common = _overlaps(low, high, shingles, i, j)
            near = common >= THRESHOLD * (sizes[i] + sizes[j] - common)
            i, j = i[near], j[near]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist()):
                x, y = top(x), top(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
        hit = np.flatnonzero(links)
        if len(hit):
            yield pa.RecordBatch.from_pydict({"row": pa.array(rows[hit]), "links": pa.array(links[hit]), "root": pa.array(rows[[top(x) for x in hit]])})


def components(edges: DataFrame, loops: bool = False) -> DataFrame:
    """row, label: the smallest row of each connected component of edges (u, v), by least labels and pointer jumping.

    Every round is written to the shared folder; labels that do not change any more end it. Nodes that
    have an edge to themselves alone are left out, unless ``loops`` asks for them.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialize((both if loops else both.where("u <> v")).distinct(), "edges")
    labels = materialize(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("row"), F.least("u", "v").alias("label")), "labels")
    while True:
        near = both.join(labels, both.v == labels.row).groupBy("u").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.row == near.u).select("row", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = materialize(lower, "lower-labels")
        target = lower.select(F.col("row").alias("_row"), F.col("label").alias("_label"))
        labels = materialize(lower.join(target, lower.label == target._row, "left").select("row", F.coalesce("_label", "label").alias("label"), "old"), "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("row", "label")
        labels = labels.drop("old")


def near_duplicates(documents: DataFrame, recall: float = RECALL, levels: int = LEVELS, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS,
                    seed: int = 3) -> DataFrame:
    """One row per row: doc_id, class_id, n_links, class_size, stays; and text_key to find the row again.

    Documents are linked when the Jaccard similarity of their sets of five-word shingles (lower-case words of letters, digits
    and underscores; a shorter text is one shingle) is at least 0.8. n_links counts the other documents linked to one,
    copies included. A class is a connected component; its class_id is its smallest doc_id, and of a class the row with
    that id stays (one of them if repeated; rows without id stay only in classes without ids). Texts without words, null
    ones too, are classes of their own with no links. An empty table gives no rows; other columns are not read.
    """
    drawn = sketches(documents).withColumn("row", F.monotonically_increasing_id())
    drawn = materialize(drawn, "sketches")
    filled = drawn.where("n_shingles > 0")
    sets = filled.groupBy(*KEY).agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("tokens").alias("tokens"),
                                    F.min("sketch").alias("sketch"), F.min_by("doc_id", "row").alias("doc_id"))
    sets = materialize(sets, "shingle-sets")
    small, large = find_buckets(sets, runs_needed(recall, levels), levels, leaf_rows, seed)
    families = find_families(large)
    lists = small.groupBy("row").agg(F.collect_list("leaf").alias("leaves"))  # as many as runs and levels make
    facts = sets.select("row", "copies", "sketch", "doc_id", *KEY).join(lists, "row", "left").join(families, "row", "left").where("leaves is not null or family is not null")
    empty = F.array().cast("array<long>")
    facts = materialize(facts.withColumn("leaves", F.coalesce("leaves", empty)).withColumn("family", F.coalesce("family", F.lit(-1))), "bucketed-sets")
    members = _groups(small, families, block_rows).join(facts.select("row", "sketch", "leaves", "family"), "row")
    dealt = members.repartition(*GROUP).sortWithinPartitions(*GROUP)
    likely = materialize(dealt.select("leaf", "a", "b", "row", "block", "sketch", "leaves", "family")
                         .mapInArrow(_survivors, "leaf long, a int, b int, row long, block int"), "likely-members")
    wanted = materialize(facts.join(likely.select("row").distinct(), "row", "left_semi").select("row", "doc_id", *KEY), "likely-sets")
    joined = likely.join(_shingle_sets(documents, wanted), "row").join(facts.select("row", "copies", "sketch", "leaves", "family"), "row")
    found = joined.repartition(*GROUP).sortWithinPartitions(*GROUP).select("leaf", "a", "b", "row", "block", "sketch", "leaves", "family", "copies", "shingles")
    found = materialize(found.mapInArrow(_links, "row long, links long, root long"), "links")
    labels = components(found.select(F.col("row").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    placed = (sets.select(*KEY, "row", "copies").join(links, "row", "left").join(labels, "row", "left")
              .select(*KEY, "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "row").alias("class")))
    rows = drawn.select("doc_id", "text_key", *KEY, "row").join(placed, KEY, "left").withColumn("class", F.coalesce("class", "row"))
    rows = materialize(rows.select("doc_id", "text_key", "row", "class", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classed")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = rows.groupBy("class").agg(F.min(first).alias("first"), F.count("*").alias("class_size"))
    return rows.join(classes, "class").select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links", "class_size",
                                              (F.col("row") == F.col("first.row")).alias("stays"), "text_key")


def _shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """row, shingles of the wanted sets, made again from the texts of their documents."""
    ids = wanted.select(F.col("doc_id").alias("_id")).distinct()
    texts = with_text(documents).join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def work(batch: pa.RecordBatch) -> dict:
        shingler = _shingler()
        made = [shingler.shingles(t) for t in batch.column("text").to_pylist()]
        keys = [set_key(s) for s in made]
        return {**{name: pa.array([k[at] for k in keys], pa.int64()) for at, name in enumerate(KEY)},
                "shingles": pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))}

    made = map_slices(texts, work, "k1 long, k2 long, n_shingles long, shingles array<long>")
    return made.join(wanted, KEY).groupBy("row").agg(F.first("shingles").alias("shingles"))


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class of near duplicates; all columns stay."""
    stay = near_duplicates(documents).where("stays").select(F.col("doc_id").alias("__kept_id"), F.col("text_key").alias("__kept_key"))
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__kept_key"))
    rows = documents.join(stay, same, "left_semi")
    repeated = not documents.groupBy("doc_id").count().where("count > 1").isEmpty()
    return rows.dropDuplicates(["doc_id", "text"]) if repeated else rows
