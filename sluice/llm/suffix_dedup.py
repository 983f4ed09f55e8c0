"""Suffix-array dedup: remove bytes of long strings that occur elsewhere as well."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.repeats import (BYTE_VALUES, Corpus, deal, find_repeats, own_id,
                                with_rest)

#: Bytes of a string that counts as a repeat.
THRESHOLD = 200
#: Bytes of text that one task holds at a time.
CHUNK_BYTES = 2 << 20

_SCHEMA = "rid long, id long, n_bytes long, n_removed long, n_spans long, kept binary, text string"


def _load(pdf: pd.DataFrame) -> Corpus:
    texts = [t.encode() if isinstance(t, str) else b"" for t in pdf["text"]]
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    corpus = Corpus(BYTE_VALUES[raw], np.cumsum([0, *map(len, texts)]), np.arange(len(texts)))
    corpus.raw = raw
    return corpus


def _finish(pdf: pd.DataFrame, corpus: Corpus, covered: np.ndarray) -> pd.DataFrame:
    offsets = corpus.offsets
    starts, ends = offsets[:-1], offsets[1:]
    running = np.concatenate(([0], np.cumsum(covered)))
    removed = running[ends] - running[starts]
    # A run begins where a covered byte follows one that is not, or begins its document.
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    edge = starts[starts < len(covered)]
    begins[edge] = covered[edge]
    runs = np.concatenate(([0], np.cumsum(begins)))
    kept = [corpus.raw[a:b][~covered[a:b]].tobytes() if n else corpus.raw[a:b].tobytes()
            for a, b, n in zip(starts, ends, removed)]
    return pd.DataFrame({"rid": pdf["rid"], "id": pdf["id"], "n_bytes": ends - starts,
                         "n_removed": removed, "n_spans": runs[ends] - runs[starts], "kept": kept,
                         "text": [None if t is None else k.decode(errors="ignore")
                                  for t, k in zip(pdf["text"], kept)],
                         "rest": pdf["rest"]})


def _round_lengths(threshold: int) -> tuple[int, ...]:
    """A quarter of the threshold, then the threshold itself."""
    return tuple(sorted({max(1, threshold // 4), threshold}))


def removed_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: ``id, n_bytes, n_removed, n_spans``, ``kept`` (the bytes left), ``text``
    (the same as characters), ``rest`` (the other columns) and ``rid`` (a number of the row).

    Prefix doubling: the rank of a string is the pair of its halves' ranks.
    Strings of a quarter of the threshold are ranked first, at sampled places;
    then, where those were not unique, all strings of the full length as pairs
    of half-length ranks.  Ranks past the threshold are not needed.  See
    ``repeats`` for how Spark sorts the ranks and what the odds of an error are.

    A byte goes when a string of ``threshold`` bytes that covers it starts
    anywhere else too, in this document or another; all copies go, the first
    included.  A null text is empty, texts below the threshold stay whole,
    repeated rows are documents of their own, an empty table gives no rows.
    """
    chunks, total = deal(docs, id_col, text_col, chunk_bytes)
    return find_repeats(chunks, total, _load, _finish, with_rest(_SCHEMA, chunks), threshold,
                        _round_lengths(threshold), bucket_bytes=2 * chunk_bytes).withColumn(
                            "id", own_id())


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: int = THRESHOLD, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents, all columns, with repeated strings cut out of the text.

    What a cut leaves of a split character is dropped.  Null texts stay null.
    """
    found = removed_repeats(docs, id_col, text_col, threshold, chunk_bytes)
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c)
                          for c in docs.columns])
