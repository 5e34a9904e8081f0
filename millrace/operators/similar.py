"""Links between similar texts by word sets (Jaccard) or TF-IDF vectors (cosine), all rows against all.

Word sets: words are ordered by how few classes hold them. Two texts can only reach the wanted similarity if they
share a word of both their prefixes (the rare words that the rest cannot make up for), so texts meet by
equality on prefix words and never as a product. At a meeting, size, position and word-set signature bound the
similarity from above; what passes is compared exactly. The bounds hold at the first word a pair shares,
where every true pair meets, so none is lost.

Vectors: at a low cosine nearly all words belong to the prefix, and pairs that share one are a share of all
pairs. They are never written: packets of vectors meet in tasks that send counts alone. There the products of
rare words are summed, and what frequent words can add is bounded by norms (Cauchy-Schwarz), so a pair
below the threshold by that is none; what passes is multiplied exactly. Time is quadratic, with a small factor.

Rows with equal words form a class; classes are compared, copies only counted. Words held by very many
prefixes are cut into pairs of blocks, so no task gets a whole posting list.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

#: Postings of one word that meet in one task; longer lists are cut into blocks of this size.
BLOCK = 4096
#: A word or class found in more than one of this many rows is looked up by broadcast (its number is bounded by this times the words of a mean text).
HOT_SHARE = 1000
#: Packets of vectors: words of the least and of the largest, about, and packets that are made before they grow.
PACKET_WORDS, BLOCK_TERMS, LEAST_BLOCKS = 200_000, 3_000_000, 8
#: A word is frequent if more than this share of the classes hold it; the further cuts serve pairs with little weight on frequent words.
CUTS = (1 / 64, 1 / 128, 1 / 256, 1 / 512, 1 / 1024)
#: Groups of frequent words, whose norms are multiplied as a matrix; products held at once, vectors of the other side among them at most, vectors that are multiplied in full together.
OFTEN, TILE_CELLS, TILE_WIDTH, FULL_ROWS = 48, 524_288, 8192, 32
#: Distance from the threshold that a bound by norms alone must leave; share of a tile's pairs above which the products of all its pairs are made in full.
_LEFT, _MANY = 0.03, 1 / 64
_SLACK = 1e-9


def set_links(df: DataFrame, keys: Sequence[str], words: str, least: float = 0.6) -> DataFrame:
    """Per row its class, the rows with the same word set, and the rows whose word set has a Jaccard similarity of ``least`` or more.

    Columns: the keys, ``class_id``, ``copies`` (the row itself included) and ``links`` (itself excluded). Null or empty
    word lists are alike only in being empty: no links. Repeated keys are repeated rows, each with a result. Null words are passed over.
    """
    bag = F.array_sort(F.array_distinct(F.filter(words, lambda w: w.isNotNull())))
    rows, classes, terms, _ = _terms(df, keys, bag)
    per = Window.partitionBy("class_id")
    bits = F.xxhash64("word")
    signature = [F.bit_xor(F.when(F.pmod(bits, F.lit(4)) == i, F.expr("shiftleft(1L, cast(pmod(shiftright(xxhash64(word), 2), 64) as int))")).otherwise(F.lit(0).cast("long"))).over(per).alias(f"s{i}") for i in range(4)]
    ranked = terms.select("class_id", "word", F.count("*").over(per).alias("n"), F.row_number().over(per.orderBy("held", "word")).alias("at"), *signature)
    prefix = ranked.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - _SLACK) + 1)

    def bound(a: str, b: str) -> Column:
        na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
        need = F.ceil((na + nb) * (least / (1 + least)) - _SLACK)
        apart = F.lit(0)
        for i in range(4):
            apart = apart + F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}")))
        return ((F.least(na, nb) >= F.greatest(na, nb) * least - _SLACK) & (F.least(na - F.col(f"{a}.at"), nb - F.col(f"{b}.at")) + 1 >= need)
                & (apart <= na + nb - 2 * need))

    def alike(x: Column, y: Column) -> Column:
        shared = F.size(F.array_intersect(x, y))
        return shared >= (F.size(x) + F.size(y) - shared) * least - _SLACK

    return _links(rows, keys, classes, _meet(prefix, bound), classes.select("class_id", "copies", "bag"), alike)


def cosine_links(df: DataFrame, keys: Sequence[str], words: str, least: float = 0.6) -> DataFrame:
    """As :func:`set_links`, for the cosine of TF-IDF vectors: word count times ``ln(rows / rows with the word) + 1``.

    Rows are alike as a class when they hold the same words equally often. All rows, empty ones too, count in the weights.
    Classes are packed some thousand to a row, with word numbers for words; every packet meets every other in one task,
    which sends counts alone. Neither pairs nor the words of a pair are ever written, and no packet is copied for its meetings.
    """
    bag = F.array_sort(F.filter(words, lambda w: w.isNotNull()))
    rows, classes, total = _classes(df, keys, bag)
    packets, n = _packets(classes, total)
    dealt = packets.repartitionById(n, F.col("packet"))
    other = dealt.select(F.col("packet").alias("other"), F.col("body").alias("other_body"))
    met = dealt.hint("shuffle_replicate_nl").join(other, F.col("packet") <= F.col("other"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, a = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                packet, body, other, other_body = (batch.column(c)[i] for c in ("packet", "body", "other", "other_body"))
                if packet.as_py() != last:
                    last, a = packet.as_py(), _Packet(body.as_py())
                same = other.as_py() == last
                ids, links = _count_links(a, a if same else _Packet(other_body.as_py()), same, least - _SLACK)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], names=["class_id", "n"])

    partners = met.mapInArrow(compare, "class_id long, n long").groupBy("class_id").agg(F.sum("n").alias("others"))
    return _linked(rows, keys, classes, partners)


def _classes(df: DataFrame, keys: Sequence[str], bag: Column) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their class's digest, classes with bag and copies, and the number of rows."""
    bagged = df.select(*keys, F.coalesce(bag, F.array().cast("array<string>")).alias("bag")).withColumn("digest", F.sha2(F.to_json("bag"), 256))
    bagged = materialize(bagged, "bags")
    classes = bagged.groupBy("digest").agg(F.any_value("bag").alias("bag"), F.count("*").alias("copies"))
    # a short number stands for the digest in all tables of words; it holds once the classes are written
    classes = materialize(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    return bagged.select(*keys, "digest"), classes, bagged.count()


def _packets(classes: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Vectors of the classes, packed (``packet, body``; see :class:`_Packet`), and the number of packets, numbered from 0.

    A packet lists its words, each once; these lists, not the words of every class, meet the table of all words.
    """
    n_classes, n_words = classes.agg(F.count("*"), F.coalesce(F.sum(F.size("bag")), F.lit(0))).first()
    n = max(1, -(-n_words // BLOCK_TERMS), min(LEAST_BLOCKS, -(-n_words // PACKET_WORDS)))
    dealt = classes.select(F.pmod("class_id", F.lit(n)).cast("int").alias("packet"), "class_id", "copies", "bag").repartitionById(n, F.col("packet"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet, ids, copies, sizes, coded = None, [], [], [], []
        for batch in batches:  # words become numbers batch by batch, so a packet's texts are never held at once
            if batch.num_rows:
                packet = batch.column("packet")[0].as_py()
                ids.append(batch.column("class_id").to_numpy())
                copies.append(batch.column("copies").to_numpy())
                sizes.append(pc.list_value_length(batch.column("bag")).to_numpy())
                coded.append(batch.column("bag").flatten().dictionary_encode())
        if packet is None:
            return
        coded = pa.chunked_array(coded).unify_dictionaries()
        words = coded.chunk(0).dictionary
        code = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
        copies, sizes = np.concatenate(copies), np.concatenate(sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        new = np.ones(len(code), bool)  # bags are sorted, so equal words are neighbours
        new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
        times = np.diff(np.flatnonzero(np.append(new, True)))
        row, code = row[new], code[new]
        held, rows_with = np.bincount(code, minlength=len(words)), np.bincount(code, copies[row], len(words)).astype("int64")
        body = _zip(np.concatenate(ids), copies, row.astype("int32"), code.astype("int32"), times.astype("int32"))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), x) for x in (words, pa.array(held), pa.array(rows_with))]
        yield pa.RecordBatch.from_arrays([pa.array([packet], pa.int32()), *lists, pa.array([body], pa.binary())], names=["packet", "words", "held", "rows_with", "body"])

    packed = materialize(dealt.mapInArrow(pack, "packet int, words array<string>, held array<long>, rows_with array<long>, body binary"), "packets")
    listed = packed.select("packet", F.posexplode(F.arrays_zip("words", "held", "rows_with")).alias("place", "w")).select("packet", "place", "w.*")
    # a word stands once in a packet, so even a word of every text has no more rows here than there are packets
    known = listed.groupBy("words").agg(F.sum("held").alias("all_held"), F.sum("rows_with").alias("all_rows"))
    known = materialize(known.withColumn("word", F.monotonically_increasing_id()), "words")
    told = listed.select("packet", "place", "words").join(known, "words").groupBy("packet").agg(
        F.sort_array(F.collect_list(F.struct("place", "word", "all_held", "all_rows"))).alias("told"))
    joined = packed.select("packet", "body").join(told, "packet").select("packet", "body", *[F.col(f"told.{c}").alias(c) for c in ("word", "all_held", "all_rows")])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                word, held, rows_with = (batch.column(c)[i].values.to_numpy() for c in ("word", "all_held", "all_rows"))
                body = _weighed(*_unzip(batch.column("body")[i].as_py()), word, held, np.log(max(total, 1) / rows_with) + 1, n_classes)
                yield pa.RecordBatch.from_arrays([batch.column("packet")[i:i + 1], pa.array([body], pa.binary())], names=["packet", "body"])

    return materialize(joined.mapInArrow(tell, "packet int, body binary"), "vectors"), n


def _zip(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, *arrays)
    return out.getvalue()


def _unzip(body: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(body)) as f:
        return [f[name] for name in f.files]


def _weighed(ids, copies, row, place, times, word, held, idf, n_classes) -> bytes:
    """The arrays of a :class:`_Packet`: rows with much weight on frequent words first, words in order of their numbers; words of one class count in norms alone."""
    n = len(ids)
    weight = times * idf[place]
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=n))
    square = (weight / norm[row]) ** 2
    tier = (held[:, None] <= np.array(CUTS) * n_classes).sum(axis=1).astype("int8")
    often = np.sqrt(np.stack([np.bincount(row, square * (tier[place] <= k), minlength=n) for k in range(len(CUTS))], axis=1))
    order = np.argsort(-often[:, 0], kind="stable")
    used = np.flatnonzero(held > 1)
    used = used[np.argsort(word[used])]
    row_to, place_to = np.empty(n, "int64"), np.full(len(word), -1)
    row_to[order], place_to[used] = np.arange(n), np.arange(len(used))
    kept = place_to[place] >= 0
    row, place, times = row_to[row[kept]], place_to[place[kept]], times[kept]
    by = np.argsort(row * (len(used) + 1) + place)
    sizes = np.bincount(row, minlength=n).astype("int32")
    return _zip(ids[order], copies[order], norm[order], often[order].astype("float32"), sizes, place[by].astype("int32"), times[by], word[used], idf[used], tier[used])


class _Packet:
    """Vectors of some classes: terms ``place``, ``x`` by row, ``word`` by place; ``often`` are the norms of what is frequent at each cut.

    A word's ``tier`` is the number of cuts at which it is rare: it counts as frequent at cut k if its tier is k at most.
    """

    def __init__(self, body: bytes):
        self.ids, self.copies, norm, self.often, self.sizes, self.place, times, self.word, idf, self.tier = _unzip(body)
        self.n, self.starts = len(self.ids), np.append(0, np.cumsum(self.sizes))
        self.row = np.repeat(np.arange(self.n), self.sizes)
        self.x = times * idf[self.place] / norm[self.row]

    @cached_property
    def groups(self) -> np.ndarray:
        """Norms of the words frequent at the first cut, in groups by number: their products bound the product of these words."""
        on = self.tier[self.place] == 0
        cell = self.row[on] * OFTEN + self.word[self.place[on]] % OFTEN
        return np.sqrt(np.bincount(cell, self.x[on] ** 2, self.n * OFTEN)).reshape(self.n, OFTEN).astype("float32")

    @cached_property
    def lists(self) -> list[tuple]:
        """For runs of rows, short ones where norms are high: first row and end, the terms by place, where each place's list starts and how long it is, and the lists' rows and values (``i``, ``x``)."""
        made, low, width = [], 0, max(1, TILE_WIDTH // 16)
        while low < self.n:
            high = min(low + width, self.n)
            terms = self.terms(low, high)
            by, long = np.argsort(self.place[terms], kind="stable") + terms.start, np.bincount(self.place[terms], minlength=len(self.word) + 1)
            made.append((low, high, by, (np.cumsum(long) - long).astype("int32"), long.astype("int32"), self.entries(by, low, "float32")))
            low, width = high, min(2 * width, TILE_WIDTH)
        return made

    def entries(self, terms: np.ndarray, low: int, kind: str) -> np.ndarray:
        made = np.empty(len(terms), [("i", "int32"), ("x", kind)])
        made["i"], made["x"] = self.row[terms] - low, self.x[terms]
        return made

    def terms(self, low: int, high: int) -> slice:
        """Where the terms of some rows are."""
        return slice(self.starts[low], self.starts[min(high, self.n)])


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans that start at ``starts``, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of entries with ``TILE_CELLS`` in sum at most, or one entry."""
    upto, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + TILE_CELLS, "right")))
        yield slice(start, stop)
        start = stop


def _add_products(near: np.ndarray, row: np.ndarray, place: np.ndarray, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entries: np.ndarray) -> None:
    """Add to ``near`` the products of terms (``row``, ``place``, ``x``) and the other side's along the lists of their places there."""
    size = sizes[place]
    met = np.flatnonzero(size)
    start, size, row, x, flat = starts[place[met]], size[met], row[met] * near.shape[1], x[met], near.reshape(-1)
    for piece in _pieces(size):
        n = size[piece]
        other = entries[_spans(start[piece], n)]
        np.add.at(flat, np.repeat(row[piece], n) + other["i"], np.repeat(x[piece], n) * other["x"])


def _reaching(near: np.ndarray, enough: float) -> np.ndarray:
    """The cells of ``near``, counted through, that reach ``enough``; eight are looked at together, as few do."""
    hit = (near >= enough).reshape(-1)
    if len(hit) % 8:
        return np.flatnonzero(hit)
    some = np.flatnonzero(hit.view("uint64") != 0)
    at = np.flatnonzero(hit.reshape(-1, 8)[some])
    return some[at // 8] * 8 + at % 8


def _products(a: _Packet, b: _Packet, to: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The products of rows i of ``a`` and j of ``b``, i in order; ``to``: b's places of a's."""
    made, column = np.zeros(len(i)), np.zeros(len(b.word) + 1, "int32")
    rows, which = np.unique(i, return_inverse=True)
    for low in range(0, len(rows), FULL_ROWS):
        own = rows[low:low + FULL_ROWS]
        at = _spans(a.starts[own], a.sizes[own])
        place = to[a.place[at]]
        column[place] = np.arange(1, len(place) + 1)  # one of the places' terms gives the column; 0 is for words that these rows lack
        wide = np.zeros((len(own), len(place) + 1))
        wide[np.repeat(np.arange(len(own)), a.sizes[own]), column[place]] = a.x[at]
        first, last = np.searchsorted(which, (low, low + FULL_ROWS))
        for piece in _pieces(b.sizes[j[first:last]]):
            pairs = slice(first + piece.start, first + piece.stop)
            n, at = b.sizes[j[pairs]], _spans(b.starts[j[pairs]], b.sizes[j[pairs]])
            x = wide.reshape(-1)[np.repeat((which[pairs] - low) * wide.shape[1], n) + column[b.place[at]]] * b.x[at]
            made[pairs] = np.bincount(np.repeat(np.arange(len(n)), n), x, len(n))
        column[place] = 0
    return made


def _count_links(a: _Packet, b: _Packet, same: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the classes of two packets that have partners in the other one, with the partners' copies. ``same``: a packet and itself.

    For each tile of pairs the products of words rare at a cut are summed; what the others add is at most the product of their norms.
    The cut is the last one at which norms alone stay below ``least``; where there is none, norms are multiplied group by group.
    Pairs that reach ``least`` with this bound are multiplied in full.
    """
    to = np.searchsorted(b.word, a.word)  # b's place after the last stands for words that b lacks
    to[np.append(b.word, -1)[to] != a.word] = len(b.word)
    rare = np.flatnonzero((a.tier > 0)[a.place] & (to < len(b.word))[a.place])
    rare_row, rare_place, rare_x, rare_tier = a.row[rare], to[a.place[rare]], a.x[rare].astype("float32"), a.tier[a.place[rare]]
    rare_starts = np.searchsorted(rare, a.starts)
    buffer = np.empty(max(TILE_CELLS, TILE_WIDTH), "float32")
    n_a, n_b = np.zeros(a.n, "int64"), np.zeros(b.n, "int64")
    # sums of floats of 4 bytes, all of them positive: what rounding may take from a bound of ``least``
    safe = np.float32(least - 2.0 ** -22 * (OFTEN + 8 + max(a.sizes.max(initial=0), b.sizes.max(initial=0))))
    found, waiting = [], 0

    def link(i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(n_a, i, b.copies[j])
        np.add.at(n_b, j, a.copies[i])

    def settle() -> None:
        i, j = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(i, kind="stable")
        i, j = i[by], j[by]
        reached = _products(a, b, to, i, j) >= least
        link(i[reached], j[reached])
        found.clear()

    for first, last, by, *lists in b.lists:
        width, often_b = last - first, b.often[first:last]
        most_b, step = often_b.max(axis=0), max(1, TILE_CELLS // (last - first))
        # norms grow from cut to cut: the last cut at which those of a row and of all others here stay low, -1 if there is none
        cuts = (a.often * most_b <= least - _LEFT).sum(axis=1) - 1
        for low in range(0, min(a.n, last) if same else a.n, step):
            high = min(low + step, a.n)
            cut, near = cuts[low:high], buffer[:(high - low) * width].reshape(high - low, width)
            terms = slice(rare_starts[low], rare_starts[high])
            by_norms = cut.min() >= 0
            if not by_norms:
                np.matmul(a.groups[low:high], b.groups[first:last].T, out=near)
            else:
                near[:] = (a.often[np.arange(low, high), cut] * most_b[cut])[:, None]
                if cut.any():
                    terms = terms.start + np.flatnonzero(rare_tier[terms] > cut[rare_row[terms] - low])
            _add_products(near, rare_row[terms] - low, rare_place[terms], rare_x[terms], *lists)
            i, j = np.divmod(_reaching(near, safe), width)
            if by_norms:
                k = cut[i]
                reached = near[i, j] + a.often[low + i, k] * (often_b[j, k] - most_b[k]) >= safe
                i, j = i[reached], j[reached]
            many = len(i) > _MANY * near.size
            if many:
                near, terms = np.zeros(near.shape), a.terms(low, high)
                _add_products(near, a.row[terms] - low, to[a.place[terms]], a.x[terms], *lists[:2], b.entries(by, first, "float64"))
                i, j = np.nonzero(near >= least)
            i, j = i + low, j + first
            if same:  # each pair once; no class with itself
                i, j = i[i < j], j[i < j]
            if many:
                link(i, j)
                continue
            found.append((i, j))
            waiting += len(i)
            if waiting > TILE_CELLS:
                settle()
                waiting = 0
    if found:
        settle()
    ids, n = np.concatenate([a.ids, b.ids]), np.concatenate([n_a, n_b])
    return ids[n > 0], n[n > 0]


def _terms(df: DataFrame, keys: Sequence[str], bag: Column) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Rows with their class, classes with bag and copies, and words per class with the numbers of classes and rows that hold them."""
    rows, classes, total = _classes(df, keys, bag)
    terms = classes.select("class_id", "copies", F.explode("bag").alias("word")).groupBy("class_id", "copies", "word").agg(F.count("*").alias("times"))
    terms = materialize(terms, "terms")
    held = materialize(terms.groupBy("word").agg(F.count("*").alias("held"), F.sum("copies").alias("rows_with")), "words")
    return rows, classes, _look_up(terms, held, "word", F.col("rows_with") > total / HOT_SHARE), total


def _look_up(rows: DataFrame, table: DataFrame, key: str, hot: Column) -> DataFrame:
    """Join each row with its one entry; entries that many rows ask for are broadcast, so these rows stay where they are."""
    asked = F.broadcast(table.where(hot))
    rest = rows.join(asked.select(key), key, "left_anti").join(table.where(~hot), key)
    return rows.join(asked, key).unionByName(rest)


def _meet(prefix: DataFrame, bound) -> DataFrame:
    """Pairs of classes (``a``, ``b``) that share a prefix word and pass the bound there, once each."""
    prefix = materialize(prefix, "prefixes")
    lists = prefix.groupBy("word").agg(F.count("*").alias("held")).where("held > 1").select("word", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"))
    own = prefix.join(lists, "word").withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    own = materialize(own, "postings")
    # the block pair (i, j), i <= j, gets block i from the left and block j from the right
    left = own.withColumn("j", F.explode(F.sequence("own", F.col("blocks") - 1))).withColumn("i", F.col("own")).alias("l")
    right = own.withColumn("i", F.explode(F.sequence(F.lit(0), "own"))).withColumn("j", F.col("own")).alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("word", "i", "j")]
    once = (F.col("l.i") < F.col("l.j")) | (F.col("l.class_id") < F.col("r.class_id"))
    met = left.join(right, [*same, once, bound("l", "r")])
    first, second = F.col("l.class_id"), F.col("r.class_id")
    return met.select(F.least(first, second).alias("a"), F.greatest(first, second).alias("b")).distinct()


def _links(rows: DataFrame, keys: Sequence[str], classes: DataFrame, pairs: DataFrame, bags: DataFrame, alike) -> DataFrame:
    a = bags.select(F.col("class_id").alias("a"), F.col("bag").alias("bag_a"), F.col("copies").alias("copies_a"))
    b = bags.select(F.col("class_id").alias("b"), F.col("bag").alias("bag_b"), F.col("copies").alias("copies_b"))
    true_pairs = pairs.join(a, "a").join(b, "b").where(alike(F.col("bag_a"), F.col("bag_b")))
    ends = F.explode(F.array(F.struct(F.col("a").alias("class_id"), F.col("copies_b").alias("n")), F.struct(F.col("b").alias("class_id"), F.col("copies_a").alias("n"))))
    return _linked(rows, keys, classes, true_pairs.select(ends.alias("e")).select("e.*").groupBy("class_id").agg(F.sum("n").alias("others")))


def _linked(rows: DataFrame, keys: Sequence[str], classes: DataFrame, partners: DataFrame) -> DataFrame:
    """The rows with their class's copies and links; ``partners`` holds the rows of other classes linked to a class."""
    same = F.when(F.size("bag") > 0, F.col("copies") - 1).otherwise(F.lit(0))
    counted = classes.join(partners, "class_id", "left").select("digest", "copies", (same + F.coalesce("others", F.lit(0))).cast("long").alias("links"))
    counted = materialize(counted, "links")
    hot = F.col("copies") > F.lit(rows.count() / HOT_SHARE)
    return _look_up(rows, counted, "digest", hot).select(*keys, F.col("digest").alias("class_id"), "copies", "links")
