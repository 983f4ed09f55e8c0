"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import functools
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import materialise, parts_for, quoted

SIZE = 1024
END = 2
#: Pieces of one length that are numbered in one task, about.
NUMBERED = 20_000
#: At least so many groups number the pieces of one length.
GROUPS = 64


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """Text to ids, as the tokenizers library reads the file at ``path``.

    Byte-level BPE files are run by tiktoken, with the ranks taken from the same
    file: the ids are the same and it is several times faster.  Texts that spell
    out a special token go to the tokenizers library itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = [t["content"] for t in content.get("added_tokens", ())]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in content["model"]["vocab"].items()
             if token not in special}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    exact = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter."""
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, size: int,
                 end: int, with_ids: bool) -> DataFrame:
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    names = [c.split()[0] for c in schema.split(", ")]

    def pieces(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer)
        for pdf in pdfs:
            rows = []
            for doc, text in zip(pdf["id"], pdf["text"]):
                ids = np.array([*encode(text or ""), end], dtype="<u4")
                for k, (s, n) in enumerate(cut(len(ids), size)):
                    part = ids[s:s + n]
                    rows.append((None if pd.isna(doc) else int(doc), k, s, n, zlib.crc32(part.tobytes()),
                                 *([part.astype(np.int32)] if with_ids else [])))
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(quoted(id_col).cast("long").alias("id"),
                       quoted(text_col).alias("text")).mapInPandas(pieces, schema)


def fullest(counts: list[int], room: int) -> list[tuple[int, int]]:
    """Lengths and how often each, with the largest sum up to ``room``.

    ``counts[l]`` pieces of length l are there.  Sums that can be reached are
    the set bits of a number; taking a batch of k pieces of length l shifts it.
    """
    reached, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in range(room, 0, -1):
        left, batch = min(counts[length], room // length), 1
        while left:
            k = min(batch, left)
            grown = reached | (reached << (k * length)) & mask
            if grown != reached:
                steps.append((length, k, reached))
                reached = grown
            left, batch = left - k, batch * 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            total -= k * length
            used[length] = used.get(length, 0) + k
    return sorted(used.items(), reverse=True)


def plan_bins(counts: list[int], size: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """Minimum bin slack on counts per length, at most ``size`` of them.

    Each bin starts with the largest length left; a subset-sum program finds the
    fullest completion, and the same filling is repeated as often as the counts
    allow.  Per length: (rank of the first piece, pieces per bin, first bin,
    offset within a bin).
    """
    counts = list(counts)
    given = [0] * (size + 1)
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    bins = 0
    for largest in range(size, 0, -1):
        while counts[largest]:
            counts[largest] -= 1
            rest = dict(fullest(counts, size - largest))
            counts[largest] += 1
            rest[largest] = rest.get(largest, 0) + 1
            times = min(counts[length] // k for length, k in rest.items())
            offset = 0
            for length, k in sorted(rest.items(), reverse=True):
                out.setdefault(length, []).append((given[length], k, bins, offset))
                given[length] += k * times
                counts[length] -= k * times
                offset += k * length
            bins += times
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """All documents as token pieces placed into sequences of at most ``size`` tokens.

    Columns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and
    ``ids`` if asked for.  Every document ends with the id ``end``; a null text
    is empty and still has that one token.  Only documents longer than a
    sequence are cut.  Repeated rows are documents of their own, an empty table
    gives no rows.

    Only counts per length reach the driver, at most ``size`` of them.  Pieces
    are numbered within their length in groups, so a length that most pieces
    have is spread over many tasks.
    """
    pieces = materialise(token_pieces(docs, tokenizer, id_col, text_col, size, end, with_ids)
                         .withColumn("rid", F.monotonically_increasing_id()), "pieces")
    counts = [0] * (size + 1)
    for row in pieces.groupBy("length").count().collect():  # at most `size` rows
        counts[row.length] = row["count"]
    groups = max(GROUPS, parts_for(sum(counts), NUMBERED, 1 << 30))
    plan = plan_bins(counts, size)
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("rid"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(
        Window.unboundedPreceding, -1)
    first = (dealt.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
             .select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = F.row_number().over(Window.partitionBy("length", "group").orderBy("rid")) - 1
    ranked = (dealt.withColumn("within", within).join(first, ["length", "group"])
              .withColumn("rank", F.col("first") + F.col("within"))
              .drop("group", "first", "within", "rid"))
    schema = T.StructType([f for f in ranked.schema.fields if f.name != "rank"] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = {length: [e[0] for e in entries] for length, entries in plan.items()}
        for pdf in pdfs:
            sequence, offset = [], []
            for length, rank in zip(pdf["length"].tolist(), pdf["rank"].tolist()):
                first, k, base, at = plan[length][bisect_right(starts[length], rank) - 1]
                turn, slot = divmod(rank - first, k)
                sequence.append(base + turn)
                offset.append(at + slot * length)
            out = pdf.drop(columns="rank")
            out["sequence_id"], out["offset"] = sequence, offset
            yield out

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return ranked.mapInPandas(place, schema).select(*names, *(["ids"] if with_ids else []))
