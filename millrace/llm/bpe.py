"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

A prefix of a piece has one BPE encoding, so it has one last token; a token may follow another when merging
the two alone gives the two back. A reader therefore needs, at any place, the last tokens of the prefixes that
end where a longer token may still begin. Such a configuration is a state, and it fixes the last token of the
next prefix. Tokens are emitted once the readings up to all open places agree on them, which takes a bounded
number of bytes. States and transitions are made when a text first needs them, in a cache of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.common import map_slices, with_text, worker_state

#: Caches are emptied when they hold this many entries: states, token pairs, distinct pieces (unless told otherwise).
MAX_STATES, MAX_PAIRS, MAX_PIECES = 100_000, 300_000, 400_000
#: Longer pieces are run through the transducer each time instead of being kept.
CACHED_PIECE_BYTES = 48
#: Characters that are split into pieces at once, and tokens that are decoded at once.
BLOCK_CHARS, BLOCK_TOKENS = 1 << 18, 1 << 16


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from lines of base64 token and number."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class State:
    """Text since the earliest open place, and the last token of the prefix that ends at each open place.

    ``last`` has the distance back from the reading head with that token (None at the start of a piece), the farthest
    first; distance 0 is the head itself.
    """

    __slots__ = ("text", "last", "token", "next")

    def __init__(self, text: bytes, last: tuple[tuple[int, int | None], ...]):
        self.text, self.last, self.token = text, last, last[-1][1]
        self.next: dict[int, State] = {}


class Transducer:
    """Encodes single pieces by the ranks, byte by byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.heads = {token[:n] for token in ranks for n in range(1, len(token))} | {b""}
        self.start = State(b"", ((0, None),))
        self.states: dict[tuple, State] = {}
        self.pairs: dict[tuple[int | None, int], bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, piece: bytes, below: int) -> list[bytes]:
        """Parts of a short piece after all merges of ranks under ``below``, the lowest rank first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def made_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes."""
        if token not in self.halves:
            parts = self.merged(self.tokens[token], token)
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def may_follow(self, left: int | None, right: int) -> bool:
        """Whether no merge across the border comes before the merges that make the two tokens."""
        if left is None:
            return True
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        # Undo the later of the two sides' merges, one at a time. The pair that faced each other until then must
        # not have a merge of its own that would have come first (at equal rank, the one further left).
        tokens, ranks = self.tokens, self.ranks
        until = len(ranks) + 1
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < until:
                return False
            parts_l, parts_r = self.made_of(left), self.made_of(right)
            if parts_l and (not parts_r or left > right):
                until, left = left, parts_l[1]
            elif parts_r:
                until, right = right + 1, parts_r[0]
            else:
                return True

    def token_after(self, state: State, byte: int) -> int:
        """The last token when ``byte`` follows: of the tokens from an open place to here, the longest that may stand there."""
        text, ranks = state.text + bytes((byte,)), self.ranks
        end = len(text) - 1
        for back, before in state.last:
            found = ranks.get(text[end - back:])
            if found is not None and self.may_follow(before, found):
                return found
        raise ValueError("ranks without all single bytes, or not from merges")

    def grow(self, state: State, byte: int) -> State:
        """The transition of ``state`` on ``byte``, made on first use."""
        text, heads = state.text + bytes((byte,)), self.heads
        end = len(text) - 1
        token = self.token_after(state, byte)
        known = [(back + 1, before) for back, before in state.last if text[end - back:] in heads]
        text = text[end + 1 - known[0][0]:] if known else b""
        known = (*known, (0, token))
        key = text, known
        made = self.states.get(key)
        if made is None:
            if len(self.states) >= MAX_STATES:
                self.states.clear()
                self.start.next.clear()
            made = self.states[key] = State(text, known)
        state.next[byte] = made
        return made

    def piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, last, out, done, step, end = self.start, [], [], 0, 8 * self.longest, len(piece) - 1
        for at in range(0, end, step):
            for byte in piece[at:min(at + step, end)]:
                state = state.next.get(byte) or self.grow(state, byte)
                last.append(state.token)
            if len(last) < end:
                done = self._emit(last, done, state, out)
        # nothing follows the last byte, so it needs a token but no state
        after = state.next.get(piece[end])
        last.append(after.token if after else self.token_after(state, piece[end]))
        out.extend(self._path(last, done, len(last)))
        return out

    def _path(self, last: list[int], done: int, end: int) -> list[int]:
        """Tokens from the place ``done`` to the place ``end``, read backwards."""
        tokens = []
        while end > done:
            tokens.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        return tokens[::-1]

    def _emit(self, last: list[int], done: int, state: State, out: list[int]) -> int:
        """Emit the tokens on which the readings up to all open places agree; gives the place they reach."""
        paths = [self._path(last, done, len(last) - back) for back, _ in state.last]
        agreed = 0
        while all(len(p) > agreed and p[agreed] == paths[0][agreed] for p in paths):
            agreed += 1
        out.extend(paths[0][:agreed])
        return done + sum(len(self.tokens[t]) for t in paths[0][:agreed])


class Pieces(dict):
    """Packed ids (little-endian, 32 bits) by piece, with a bound on what is kept."""

    def __init__(self, transducer: Transducer, most: int):
        self.transducer, self.most = transducer, most

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        ids = self.transducer.piece(data)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(data) <= CACHED_PIECE_BYTES:
            if len(self) >= self.most:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encoding and decoding of whole texts by one vocabulary and piece pattern."""

    def __init__(self, ranks_file: bytes, pattern: str, kept_pieces: int = MAX_PIECES):
        self.transducer = Transducer(read_ranks(ranks_file))
        self.pieces = Pieces(self.transducer, kept_pieces)
        self.pattern = regex.compile(pattern)
        size = max(self.transducer.tokens) + 1
        self.bytes_of = [self.transducer.tokens.get(i, b"") for i in range(size)]
        self.cut = regex.compile(r"\p{L} (?=\p{L})")

    def blocks(self, text: str) -> Iterator[str]:
        """The text in blocks that begin at a space between letters, where a piece begins whatever stands around."""
        at = 0
        while len(text) - at > BLOCK_CHARS:
            found = self.cut.search(text, at + BLOCK_CHARS)
            if not found:
                break
            yield text[at:found.end() - 1]
            at = found.end() - 1
        yield text[at:] if at else text

    def encode(self, text: str) -> bytes:
        """Ids of the text, packed as little-endian unsigned 32-bit integers."""
        get = self.pieces.__getitem__
        return b"".join([b"".join(map(get, self.pattern.findall(block))) for block in self.blocks(text)])

    def token_bytes(self, packed: bytes) -> Iterator[bytes]:
        """The bytes of the tokens, a block of ids at a time; a block may end within a character."""
        ids = np.frombuffer(packed, "<u4")
        for at in range(0, len(ids), BLOCK_TOKENS):
            yield b"".join(map(self.bytes_of.__getitem__, ids[at:at + BLOCK_TOKENS].tolist()))

    def decode(self, packed: bytes) -> Iterator[str]:
        """The text again, in parts that end between characters."""
        tail = Utf8Tail()
        for data in self.token_bytes(packed):
            yield tail.feed(data)
        yield tail.close()


class Utf8Tail:
    """Incremental UTF-8: the state is the bytes of a character that has not ended yet.

    Bytes that cannot belong to a character come out as the replacement character.
    """

    #: Continuation bytes that a lead byte asks for.
    WANTS = [0] * 0xC2 + [1] * 30 + [2] * 16 + [3] * 5 + [0] * 11

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # the last lead byte
                if self.WANTS[byte] >= back:
                    cut = len(data) - back
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def codec(ranks_file: bytes, pattern: str, kept_pieces: int = MAX_PIECES) -> Codec:
    """The codec of this Python process for a vocabulary and pattern; its caches live on from task to task."""
    return worker_state(("bpe", hashlib.sha256(ranks_file).digest(), pattern, kept_pieces), lambda: Codec(ranks_file, pattern, kept_pieces))


def encode_documents(documents: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False, kept_pieces: int = MAX_PIECES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, and the ids (array of int) if asked for.

    A null text is read as empty: no tokens. Texts of any length are split, encoded and decoded in blocks.
    Repeated rows give repeated results, an empty table none; other columns are not read. The vocabulary file is
    read on the driver and sent once per executor; its size is that of the vocabulary. A worker keeps the ids of up to
    ``kept_pieces`` pieces (some 220 bytes each), which changes no result.
    """
    with open(ranks_path, "rb") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> dict:
        coder = codec(sent.value, pattern, kept_pieces)
        counts, ids_sha, text_sha, ids = [], [], [], []
        for text in batch.column("text").to_pylist():
            packed = coder.encode(text)
            back = hashlib.sha256()
            for part in coder.decode(packed):
                back.update(part.encode())
            counts.append(len(packed) // 4)
            ids_sha.append(hashlib.sha256(packed).hexdigest())
            text_sha.append(back.hexdigest())
            if with_ids:
                ids.append(np.frombuffer(packed, "<i4"))
        made = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        return made | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if with_ids else {})

    return map_slices(with_text(documents), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, text from rows of doc_id and ids; null ids give an empty text, null or unknown single ids nothing."""
    with open(ranks_path, "rb") as file:
        sent = encoded.sparkSession.sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> dict:
        coder = codec(sent.value, pattern)
        known = len(coder.bytes_of)
        texts = []
        for ids in batch.column("ids").to_pylist():
            packed = np.array([i for i in ids or [] if i is not None and 0 <= i < known], "<u4").tobytes()
            texts.append("".join(coder.decode(packed)))
        return {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())}

    return map_slices(encoded.select("doc_id", "ids"), work, "doc_id long, text string")
