"""Which windows of a corpus occur more than once: rounds of growing length.

A corpus is a set of documents, each a sequence of symbols (bytes or words).
A *window* is ``width`` consecutive symbols of one document.  The rounds find
every window whose content also starts elsewhere, without shuffling a row per
symbol and without ever forming pairs:

* Every string of the round's length gets a *rank*: the pair of the ranks of
  its two halves, folded into 64 bits.  Equal strings have equal ranks; that
  two different ones share a rank has odds of n^2 / 2^65 for n strings.
* A round of length h < width looks at sampled positions only.  Each live
  window chooses, by content alone, one string of length h inside it (the
  smallest mixed rank, leftmost of equals), so equal windows choose at the same
  place.  A window whose chosen string is unique cannot repeat and dies.
* The last round has h = width: each live window is its own string.

Documents are dealt into *chunks* of bounded size, kept in a bucketed table so
that no round shuffles texts again.  A chunk sends each distinct rank once, to
the bucket of its range: a string that a third of the corpus holds costs one
entry per chunk.  A bucket sorts what it gets and answers one bit per entry.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import fresh_path, materialise, parts_for, quoted, text_bytes

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LAST = np.iinfo(np.int64).max
#: Random 64-bit value of each byte, the same in every task.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Names:
    """Names of substrings: equal content, equal 64-bit name."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def ranks(self, starts: np.ndarray, length: int) -> np.ndarray:
        """The pair of the halves' ranks, folded into one value."""
        half = length // 2
        first = self.of(starts, starts + half)
        second = self.of(starts + half, starts + length)
        return mix(first * _B + second)


@dataclass
class Corpus:
    """The documents of one chunk as one run of symbols."""

    values: np.ndarray       # uint64 per symbol
    offsets: np.ndarray      # where each document begins, and the end
    ids: np.ndarray          # int64 per document


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    if w == 1:
        return x
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1: w - 1 + n])


class Rounds:
    """Replays the rounds on one chunk, given the buckets' answers so far."""

    def __init__(self, corpus: Corpus, width: int, by_id: bool):
        self.width, self.by_id, self.ids = width, by_id, corpus.ids
        self.names = Names(corpus.values)
        sizes = np.diff(corpus.offsets)
        n = len(corpus.values)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        room = np.repeat(corpus.offsets[1:], sizes) - np.arange(n)
        self.starts = np.flatnonzero(room >= width)

    def _chosen(self, length: int) -> np.ndarray:
        """Per live window, the position of its string of this length."""
        if length == self.width or not len(self.starts):
            return self.starts
        places = np.arange(len(self.doc) - length + 1)
        first, last = places[: len(self.doc) - length + 1], np.uint64((1 << 32) - 1)
        ranks = mix(self.names.of(first, first + length) + _A)
        tagged = (ranks & ~last) | first.astype(np.uint64)
        least = _window_min(tagged, self.width - length + 1)
        return (least[self.starts] & last).astype(np.int64)

    def ask(self, length: int, final: bool):
        """Sorted distinct ranks to send, with the smallest id of each."""
        chosen = self._chosen(length)
        places, self._place_of = np.unique(chosen, return_inverse=True)
        ranks = self.names.ranks(places, length)
        keys, self._key_of, counts = np.unique(ranks, return_inverse=True, return_counts=True)
        self._docs = self.ids[self.doc[places]]
        self._counts, self._final = counts, final and self.by_id
        least = None
        if self._final:
            least = np.full(len(keys), _LAST)
            np.minimum.at(least, self._key_of, self._docs)
            self._least = least
        return keys, least

    def answer(self, bits: np.ndarray) -> None:
        """Windows live on where the bucket or the chunk itself has seen their string again."""
        if self._final:
            again = bits[self._key_of] | (self._docs > self._least[self._key_of])
        else:
            again = (bits | (self._counts > 1))[self._key_of]
        self.starts = self.starts[again[self._place_of]]

    def covered(self) -> np.ndarray:
        """Symbols inside a live window, after the last round."""
        edges = np.zeros(len(self.doc) + 1, dtype=np.int32)
        edges[self.starts] += 1
        edges[self.starts + self.width] -= 1
        return np.cumsum(edges[:-1]) > 0


def _pack(x: np.ndarray) -> bytes:
    """Sorted numbers as compressed gaps, byte planes side by side."""
    gaps = np.diff(x, prepend=x.dtype.type(0))
    return zlib.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _resolve(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: sort all chunks' ranks, tell each which of its own others have too."""
    keys = [_unpack(b, np.uint64) for b in pdf["keys"]]
    sizes = [len(k) for k in keys]
    every = np.concatenate(keys)
    if pdf["ids"].iloc[0] is not None:
        ids = np.concatenate([_unpack(b, np.int64) for b in pdf["ids"]])
        order = np.lexsort((ids, every))
        ranks, ids = every[order], ids[order]
        first = np.flatnonzero(np.diff(ranks, prepend=~ranks[:1]) != 0)
        least = np.repeat(ids[first], np.diff(first, append=len(ranks)))
        seen = least < ids
    else:
        order = np.argsort(every, kind="stable")
        same = np.diff(every[order]) == 0
        seen = np.append(same, False) | np.append(False, same)
    bits = np.zeros(len(every), dtype=bool)
    bits[order] = seen
    parts = np.split(bits, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"chunk": pdf["chunk"], "round": pdf["round"], "bucket": pdf["bucket"],
                         "n": sizes, "bits": [np.packbits(p).tobytes() for p in parts]})


_ASKED = "chunk int, round int, bucket int, keys binary, ids binary"
_ANSWERED = "chunk int, round int, bucket int, n int, bits binary"


def _answers(pdf: pd.DataFrame, number: int) -> np.ndarray:
    rows = pdf[pdf["round"] == number].sort_values("bucket")
    parts = [np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool)
             for n, b in zip(rows["n"], rows["bits"])]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)


def deal(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Texts dealt into chunks and kept as a bucketed table; and their total size.

    Columns ``chunk``, ``rid`` (a number per row), ``id`` (the largest long for
    null), ``text`` and ``rest``: all columns but the text.
    """
    others = [c for c in docs.columns if c != text_col]
    total = text_bytes(docs, text_col)
    chunks = parts_for(total, chunk_bytes, 1 << 30)
    buckets = parts_for(total, 4 * chunk_bytes)
    spark = docs.sparkSession
    name = f"sluice_chunks_{uuid.uuid4().hex}"
    (docs.select(F.monotonically_increasing_id().alias("rid"), 
                 F.coalesce(quoted(id_col).cast("long"), F.lit(int(_LAST))).alias("id"),
                 quoted(text_col).alias("text"), F.struct(*map(quoted, others)).alias("rest"))
     .withColumn("chunk", F.pmod(F.xxhash64("id", "rid"), F.lit(chunks)).cast("int"))
     .repartition(buckets, "chunk")
     .write.bucketBy(buckets, "chunk").option("compression", "zstd")
     .option("path", fresh_path(spark, "chunks")).saveAsTable(name))
    return spark.table(name), total


def _alone(fn: Callable) -> Callable:
    """For the first round, before there are any answers."""
    return lambda key, pdf: fn(key, pdf, None)


def own_id() -> Column:
    """The id as it was, null included."""
    return F.when(F.col("id") != int(_LAST), F.col("id"))


def with_rest(schema: str, chunks: DataFrame) -> T.StructType:
    return T.StructType(T._parse_datatype_string(schema).fields + [chunks.schema["rest"]])


def find_repeats(chunks: DataFrame, total: int, load: Callable[[pd.DataFrame], Corpus],
                 finish: Callable, schema: T.StructType, width: int, lengths: tuple[int, ...],
                 by_id: bool = False, bucket_bytes: int = 4 << 20) -> DataFrame:
    """Run the rounds; ``finish(rows of a chunk, corpus, covered)`` makes the result.

    ``lengths`` must grow and end at ``width``.  With ``by_id`` a window only
    repeats where a document with a smaller id has it.
    """
    if list(lengths) != sorted(set(lengths)) or lengths[-1] != width:
        raise ValueError("lengths must grow and end at the width")
    buckets = parts_for(total, bucket_bytes, 1 << 20)

    def replay(pdf: pd.DataFrame, answers: pd.DataFrame | None, upto: int):
        pdf = pdf.sort_values(["id", "rid"], ignore_index=True)
        corpus = load(pdf)
        rounds = Rounds(corpus, width, by_id)
        for number in range(upto):
            rounds.ask(lengths[number], number == len(lengths) - 1)
            rounds.answer(_answers(answers, number))
        return pdf, corpus, rounds

    def question(number: int):
        def ask(key, pdf, answers):
            _, _, rounds = replay(pdf, answers, number)
            keys, least = rounds.ask(lengths[number], number == len(lengths) - 1)
            places = _bucket_of(keys, buckets)
            cuts = np.flatnonzero(np.diff(places)) + 1
            found = [a[0] for a in np.split(places, cuts) if len(a)]
            return pd.DataFrame({
                "chunk": np.full(len(found), key[0], dtype=np.int32), "round": number, "bucket": found,
                "keys": [_pack(k) for k in np.split(keys, cuts) if len(k)],
                "ids": [None] * len(found) if least is None else
                [_pack(k) for k in np.split(least, cuts) if len(k)]})
        return ask

    def result(key, pdf, answers):
        pdf, corpus, rounds = replay(pdf, answers, len(lengths))
        return finish(pdf, corpus, rounds.covered())

    known, texts = None, chunks.select("chunk", "rid", "id", "text")
    for number in range(len(lengths)):
        fn = question(number)
        if known is None:
            asked = texts.groupBy("chunk").applyInPandas(_alone(fn), _ASKED)
        else:
            asked = texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(fn, _ASKED)
        fresh = materialise(asked.groupBy("bucket").applyInPandas(_resolve, _ANSWERED), "answers")
        known = fresh if known is None else known.unionByName(fresh)
    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(result, schema)
