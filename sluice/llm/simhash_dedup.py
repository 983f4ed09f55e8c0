"""SimHash near-dedup with a generalised pigeonhole search."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import free_name, materialise, quoted
from sluice.llm.components import components

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Pairs are formed within buckets of up to so many fingerprints; larger buckets
#: are linked through shared neighbours instead, which finds the same components.
PAIR_BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of each bit over the hashes of all word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends)],
                      dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
        axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int,
                     keep: list[str]) -> DataFrame:
    """The columns to keep and the fingerprint as a long."""
    chosen = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(keep)],
                         quoted(text_col).alias("text"))
    schema = T.StructType([f for f in chosen.schema.fields if f.name != "text"]
                          + [T.StructField("fp", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")],
                             dtype=np.uint64).view(np.int64)
            left = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*left, pa.array(marks, pa.int64())],
                                             [*(f"c{i}" for i in range(len(keep))), "fp"])

    return chosen.mapInArrow(add, schema).toDF(*keep, name)


def bit_statistics(marks: DataFrame) -> tuple[np.ndarray, int]:
    """How often each two bits are both set, over all fingerprints, and their number."""
    def count(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros((BITS, BITS), dtype=np.int64)
        n = 0
        for pdf in pdfs:
            fp = pdf["fp"].to_numpy().astype("<i8")
            ones = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = ones.astype(np.float64)
            both += (ones.T @ ones).astype(np.int64)
            n += len(fp)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1),
                            "n": np.append(both.ravel(), n)})

    rows = (marks.select("fp").mapInPandas(count, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())  # 64 * 64 + 1 rows
    both, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r.i < 0:
            n = r.n
        else:
            both[r.i, r.j] = r.n
    return both, n


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits into partitions of equal width; a bit joins those it is most correlated with."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = -(-len(free) // (parts - k))
        seed = max(sorted(free), key=lambda b: sum(related[b, c] for c in free if c != b))
        group = [seed]
        free.discard(seed)
        while len(group) < width:
            best = max(sorted(free), key=lambda b: sum(related[b, c] for c in group))
            group.append(best)
            free.discard(best)
        out.append(sorted(group))
    return out


def _differing(bits: list[int], p: np.ndarray) -> np.ndarray:
    """Distribution of the number of differing bits of two fingerprints in a partition."""
    out = np.array([1.0])
    for b in bits:
        q = 2 * p[b] * (1 - p[b])
        out = np.append(out * (1 - q), 0) + np.append(0, out * q)
    return out


def allocate(groups: list[list[int]], p: np.ndarray, n: int, distance: int) -> tuple[float, list[int]]:
    """Thresholds per partition with the least estimated work.

    Two fingerprints at ``distance`` agree up to t_i bits in some partition i
    whenever the thresholds sum to distance - parts + 1 (-1 leaves one out).
    Work is probes plus expected candidates; the best split is found by dynamic
    programming over the partitions.
    """
    def work(bits: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        probes = sum(math.comb(len(bits), k) for k in range(t + 1))
        return n * probes + n * n / 2 * float(_differing(bits, p)[: t + 1].sum())

    best = {0: (0.0, [])}
    for bits in groups:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, distance + 1):
                total = cost + work(bits, t)
                if spent + t not in after or total < after[spent + t][0]:
                    after[spent + t] = (total, [*chosen, t])
        best = after
    return best[distance - len(groups) + 1]


def search_plan(marks: DataFrame, distance: int) -> list[tuple[int, int, list[int]]]:
    """Mask, threshold and bits of each partition that is probed."""
    both, n = bit_statistics(marks)
    p = np.diag(both) / max(n, 1)
    plans = []
    for parts in range(1, min(BITS, distance + 3) + 1):
        groups = group_bits(both, n, parts)
        cost, thresholds = allocate(groups, p, n, distance)
        plans.append((cost, groups, thresholds))
    _, groups, thresholds = min(plans, key=lambda x: x[0])
    return [(sum(1 << b for b in bits), t, bits) for bits, t in zip(groups, thresholds) if t >= 0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _balls(bits: list[int], radius: int) -> list[int]:
    """All ways to flip up to ``radius`` of the bits, fewest first."""
    return [_signed(sum(1 << b for b in some)) for k in range(radius + 1)
            for some in itertools.combinations(bits, k)]


def links(marks: DataFrame, distance: int = DISTANCE, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp``, all within the distance.

    Two fingerprints within the distance are linked or connected through others.
    """
    if distance >= BITS:
        raise ValueError("the distance must be below the number of bits")
    found = []
    for number, (mask, threshold, bits) in enumerate(search_plan(marks, distance)):
        key = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        index = marks.select(key.alias("key"), F.col("fp").alias("v"))
        flips = F.array(*[F.lit(m) for m in _balls(bits, threshold)])
        probe = marks.select(F.explode(F.transform(flips, lambda m: key.bitwiseXOR(m))).alias("key")
                             if threshold else key.alias("key"), F.col("fp").alias("u"))
        sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        far = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
        small = sizes.where((F.col("n") <= pair_bucket) & (F.col("n") > (0 if threshold else 1)))
        found.append(probe.join(index.join(small, "key"), "key")
                     .where(far & (F.col("u") < F.col("v") if not threshold else F.col("u") != F.col("v")))
                     .select("u", "v"))
        # Large buckets: who is in one or looks into one.
        large = sizes.where(F.col("n") > pair_bucket).select("key")
        crowd = probe.join(large, "key", "left_semi").select("u").distinct()
        found.append(_through_neighbours(crowd, distance))
    return reduce(DataFrame.unionByName, found).distinct()


def _through_neighbours(crowd: DataFrame, distance: int) -> DataFrame:
    """Link fingerprints that share a neighbour halfway, without forming pairs.

    Within the distance d, some value lies up to d // 2 from one and up to
    d - d // 2 from the other.  Everyone near a value is linked to the smallest
    fingerprint within d // 2 of it.  A value has only so many fingerprints
    around it as there are ways to flip that few bits.
    """
    near, wide = distance // 2, distance - distance // 2
    masks = _balls(list(range(BITS)), wide)
    flips = F.array(*[F.lit(m) for m in masks])
    around = crowd.select("u", F.explode(flips).alias("m")).select(
        "u", F.col("u").bitwiseXOR(F.col("m")).alias("x"), F.bit_count("m").alias("r"))
    groups = around.groupBy("x").agg(
        F.min(F.when(F.col("r") <= near, F.col("u"))).alias("v"), F.collect_list("u").alias("us"))
    return (groups.where("v IS NOT NULL AND size(us) > 1").select("v", F.explode("us").alias("u"))
            .where("u <> v").select("u", "v"))


def fingerprint_groups(docs: DataFrame, order_col: str, distance: int) -> DataFrame:
    """Per fingerprint ``fp`` its group's smallest value of ``order_col`` as ``first``."""
    marks = materialise(docs.groupBy("fp").agg(F.min(order_col).alias("first")), "fingerprints")
    tied = components(links(marks.select("fp"), distance))
    rooted = marks.join(tied, marks.fp == tied.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per document its id, ``fp`` (long) and ``first``, the smallest id of its group.

    Documents are in one group when a chain of fingerprints at ``distance`` or
    fewer differing bits joins them.  A text without words, or a null one, has
    fingerprint zero and is linked like any other.  Rows with a null id take
    part; a group with no other rows has a null ``first``.  Copies of a text are
    reduced to one fingerprint before the search.  An empty table gives no rows.
    """
    marked = materialise(with_fingerprint(docs, text_col, "fp", shingle, [id_col])
                         .toDF("id", "fp"), "marks")
    return marked.join(fingerprint_groups(marked, "id", distance), "fp", "left").select(
        F.col("id").alias(id_col), "fp", "first")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group, all columns: the one with the smallest id.

    Of rows with the same id, or without one, only one stays.
    """
    names = list(docs.columns)
    rid, fp, place = (free_name(names, n) for n in ("rid", "fp", "place"))
    numbered = materialise(with_fingerprint(
        docs.withColumn(rid, F.monotonically_increasing_id()), text_col, fp, shingle,
        [*names, rid]), "marked")
    order = F.struct(quoted(id_col).isNull().alias("none"), quoted(id_col).alias("id"),
                     F.col(rid).alias("rid"))
    marks = numbered.select(F.col(fp).alias("fp"), order.alias("place"))
    keep = fingerprint_groups(marks, "place", distance).select(
        F.col("first.rid").alias(rid)).distinct()
    return numbered.join(keep, rid, "left_semi").select(*map(quoted, names))
