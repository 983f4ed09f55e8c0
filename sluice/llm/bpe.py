"""Byte-level BPE by a segment tree over byte positions, and its inverse."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from sluice.llm.common import quoted

#: Pieces a worker remembers before it starts anew; results do not depend on it.
REMEMBERED = 200_000
#: Bytes of text, or of ids, that are handed on at a time.
PART_BYTES = 4 << 20
#: Leaves of the segment trees that are worked on side by side.
LEAVES = 1 << 16
#: Fewer pieces of a size are merged one by one; either way finds the same ids.
SIDE_BY_SIDE = 32


@functools.lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank is merged first, leftmost of equals.

    A leaf per byte position holds the rank of the pair that starts there, with
    the position in its low bits, so the root is the leftmost minimum.  A merge
    changes three leaves, the pair's two and its left neighbour's, each in a
    logarithmic number of steps.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    bits = (n - 1).bit_length()
    size, mask = 1 << bits, (1 << bits) - 1
    none = 1 << 62
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank << bits | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n))

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        while i > 1:
            a, b = tree[i], tree[i ^ 1]
            i >>= 1
            least = a if a < b else b
            if tree[i] == least:
                return
            tree[i] = least

    def pair(i: int) -> int:
        j = after[i]
        rank = ranks.get(piece[i:after[j]]) if j < n else None
        return none if rank is None else rank << bits | i

    while tree[1] != none:
        i = tree[1] & mask
        j = after[i]
        after[i] = k = after[j]
        before[k] = i
        put(j, none)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Merger:
    """Merges many pieces side by side, the segment trees of one size as rows of one array."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no rank for the single bytes {missing}")
        self.ranks, self.width = ranks, max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = rank
        self._place(np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int64))
        left, right = np.divmod(np.arange(1 << 16), 256)
        self.first = self._rank(self.byte_ids[left], self.byte_ids[right]).reshape(256, 256)

    def _place(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """A hash table as two arrays, at most a quarter full; a taken slot sends a key to the next."""
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.merged = np.full(1 << self.bits, -1, dtype=np.int64)
        slots = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            taken, winner = np.unique(slots[free], return_index=True)
            self.keys[taken], self.merged[taken] = keys[free[winner]], merged[free[winner]]
            left = self.keys[slots] != keys
            keys, merged, slots = keys[left], merged[left], (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; -1 where the pair is no token or a side is missing (-1)."""
        # A missing side makes the key -2, which no slot holds.
        keys = np.where((left >= 0) & (right >= 0), left * self.width + right, -2)
        slots = self._slot(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.merged[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0) & (keys >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            held, wanted = self.keys[slots[open_]], keys[open_]
            out[open_] = np.where(held == wanted, self.merged[slots[open_]], -1)
            open_ = open_[(held != wanted) & (held >= 0)]
        return out

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, little-endian unsigned 32-bit, as :func:`merge` finds them."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[at] = whole.to_bytes(4, "little")
            elif piece:
                classes.setdefault((len(piece) - 1).bit_length(), []).append(at)
        for bits, members in classes.items():
            step = max(1, LEAVES >> bits)
            for a in range(0, len(members), step):
                part = members[a:a + step]
                if len(part) < SIDE_BY_SIDE:
                    found = [np.array(merge(pieces[at], self.ranks), dtype="<u4").tobytes() for at in part]
                else:
                    found = self._merge_class([pieces[at] for at in part], bits)
                for at, ids in zip(part, found):
                    out[at] = ids
        return out

    def _merge_class(self, pieces: list[bytes], bits: int) -> list[bytes]:
        """Pieces of at most ``1 << bits`` bytes: one merge in each, all roots at a time."""
        size, mask, none, n = 1 << bits, (1 << bits) - 1, 1 << 62, len(pieces)
        data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        held = np.arange(size) < np.array([len(p) for p in pieces])[:, None]
        # One column more than positions: what follows the last one, and always missing.
        ids = np.full((n, size + 1), -1, dtype=np.int64)
        ids[:, :size] = np.where(held, self.byte_ids[data], -1)
        after = np.tile(np.arange(1, size + 2), (n, 1))
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), none, dtype=np.int64)
        ranks = np.where(held[:, 1:], self.first[data[:, :-1], data[:, 1:]], -1)
        tree[:, size:-1] = np.where(ranks >= 0, ranks << bits | np.arange(size - 1), none)
        at = size >> 1
        while at:
            tree[:, at:2 * at] = np.minimum(tree[:, 2 * at:4 * at:2], tree[:, 2 * at + 1:4 * at:2])
            at >>= 1
        ids, after, before, tree = ids.reshape(-1), after.reshape(-1), before.reshape(-1), tree.reshape(-1)
        rows = np.arange(n)
        while True:
            roots = tree.take(rows * (2 * size) + 1)
            more = roots != none
            rows, roots = rows[more], roots[more]
            if not len(rows):
                break
            base = rows * (size + 1)
            i = roots & mask
            at_i = base + i
            j = after.take(at_i)
            k = after.take(base + j)
            ids[at_i], ids[base + j] = roots >> bits, -1
            after[at_i], before[base + k] = k, i
            h = before.take(at_i)
            # A piece's first token has no left neighbour; the last column is the missing one.
            first = h < 0
            sides = ids.take(np.concatenate([base + np.where(first, size, h), at_i, base + k]))
            ranks = self._rank(sides[:2 * len(rows)], sides[len(rows):])
            starts = np.concatenate([np.where(first, j, h), i])
            nodes = np.concatenate([starts, j]) + size
            trees = np.tile(rows * (2 * size), 3)
            tree[trees + nodes] = none
            tree[trees[:len(starts)] + nodes[:len(starts)]] = np.where(ranks >= 0, ranks << bits | starts, none)
            for _ in range(bits):
                nodes >>= 1
                below = trees + 2 * nodes
                tree[trees + nodes] = np.minimum(tree.take(below), tree.take(below + 1))
        ids = ids.reshape(n, size + 1)
        live = ids >= 0
        ends = (4 * np.cumsum(live.sum(axis=1))).tolist()
        found = ids[live].astype("<u4").tobytes()
        return [found[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Splits texts by the pattern and merges each match on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merger, self.find, self.known = Merger(ranks), regex.compile(pattern).findall, {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.find(t) for t in texts]
        pieces = set().union(*split)
        new = list(pieces.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(pieces)
        self.known.update(zip(new, self.merger.merge_all([p.encode() for p in new])))
        return [b"".join(map(self.known.__getitem__, found)) for found in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str, pattern: str) -> Encoder:
    """One per worker process, so that its tasks share what is known."""
    return Encoder(load_ranks(vocabulary), pattern)


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, dtype="<u4")
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.data[shift + np.arange(len(shift))].tobytes()


@functools.lru_cache(maxsize=2)
def _decoder(vocabulary: str) -> Decoder:
    return Decoder(load_ranks(vocabulary))


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch cut so that ``column`` holds at most ``PART_BYTES`` a slice, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start, total = [], 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > PART_BYTES:
            ends.append((start, row))
            start, total = row, 0
        total += size
    if len(sizes):
        ends.append((start, len(sizes)))
    for a, b in ends:
        yield batch.slice(a, b - a)


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of each whole text, little-endian 32-bit.

    With ``decoded`` also ``bytes``, what the ids stand for, from the same pass.
    Special tokens are ordinary text.  A null text is empty and has no ids.  A
    null id stays null, repeated rows count each, an empty table has no rows,
    and other columns, whatever their names, do not come along.  No row meets
    another, so nothing is shuffled.  Texts are handed on ``PART_BYTES`` at a
    time; a longer one alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(vocabulary, pattern), _decoder(vocabulary) if decoded else None
        for batch in batches:
            for part in _slices(batch, "text"):
                ids = encoder.encode_all([t or "" for t in part.column("text").to_pylist()])
                out = {"doc_id": part.column("doc_id"), "n_tokens": pa.array([len(b) // 4 for b in ids], pa.int64()),
                       "ids": pa.array(ids, pa.binary())}
                if decoder:
                    out["bytes"] = pa.array([decoder.decode(b) for b in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary" + (", bytes binary" if decoded else ""))


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``bytes``, what the ``ids`` stand for, to rows ``doc_id, n_tokens, ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(vocabulary)
        for batch in batches:
            for part in _slices(batch, "ids"):
                yield part.append_column("bytes", pa.array(
                    [decoder.decode(b) for b in part.column("ids").to_pylist()], pa.binary()))

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, bytes binary")
