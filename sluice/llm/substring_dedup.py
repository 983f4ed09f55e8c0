"""Substring dedup: remove word windows that an earlier document already has."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from sluice.llm.repeats import (BYTE_VALUES, Corpus, Names, deal, find_repeats, own_id,
                                with_rest)

#: Words of a window.
WINDOW = 13
#: Bytes of text that one task holds at a time.
CHUNK_BYTES = 4 << 20

_SCHEMA = "rid long, id long, n_words long, n_removed long, kept string"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _load(pdf: pd.DataFrame) -> Corpus:
    """Words of all texts, each as the name of its bytes."""
    texts = [t.encode() if isinstance(t, str) else b"" for t in pdf["text"]]
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    names = Names(BYTE_VALUES[raw])
    borders = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Corpus(names.of(starts, ends), np.searchsorted(starts, borders), pdf["id"].to_numpy())


def _finish(pdf: pd.DataFrame, corpus: Corpus, covered: np.ndarray) -> pd.DataFrame:
    offsets, n_removed, kept = corpus.offsets, [], []
    for text, a, b in zip(pdf["text"], offsets[:-1], offsets[1:]):
        words = text.encode().split() if isinstance(text, str) else []
        gone = covered[a:b]
        n = int(gone.sum())
        n_removed.append(n)
        left = [w for w, g in zip(words, gone) if not g] if n else words
        kept.append(b" ".join(left).decode())
    return pd.DataFrame({"rid": pdf["rid"], "id": pdf["id"], "n_words": np.diff(offsets),
                         "n_removed": n_removed, "kept": kept, "rest": pdf["rest"]})


def doubled_lengths(window: int) -> tuple[int, ...]:
    """Half the window (rounded up), then the window: each at most twice the one before."""
    return tuple(sorted({-(-window // 2), window}))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: ``id, n_words, n_removed``, ``kept`` (words left, one space between),
    ``rest`` (the other columns) and ``rid`` (a number of the row).

    Level-wise doubling: windows of half the length that occur in one place
    only are dropped; those that repeat are extended to the whole window, where
    the ones that repeat in a document with a smaller id are removed.

    Words are runs of anything but ASCII white space, compared as they are.
    The document with the smallest id keeps its words.  A null text has no
    words; rows with one id do not remove each other's words; a null id counts
    as larger than all others; an empty table gives no rows.
    """
    chunks, total = deal(docs, id_col, text_col, chunk_bytes)
    return find_repeats(chunks, total, _load, _finish, with_rest(_SCHEMA, chunks), window,
                        doubled_lengths(window), by_id=True,
                        bucket_bytes=2 * chunk_bytes).withColumn("id", own_id())
