"""Exact top-k inner products, pruned by bounds from segment statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialise, parts_for, quoted

K = 20
#: Vectors of one block of candidates and of one block of queries.
CANDIDATES, QUERIES = 2048, 8192
#: Segments of a vector, coarse to fine.
LEVELS = (1, 4, 16)
#: Below this share of survivors, single pairs are computed instead of a whole matrix.
SPARSE = 0.05
_LEAST = np.iinfo(np.int64).min


def valid_vector(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _segments(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations per segment, each scaled by the root of its length."""
    means, spreads = [], []
    for piece in np.array_split(x, min(parts, x.shape[1]), axis=1):
        root = np.sqrt(piece.shape[1])
        means.append(piece.mean(axis=1) * root)
        spreads.append(piece.std(axis=1) * root)
    return np.stack(means, axis=1), np.stack(spreads, axis=1)


def _dots(q: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    """Exact integer products: in doubles while no sum can leave their whole numbers."""
    return q @ c.T if wide else (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)


def block_topk(q: np.ndarray, c: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Scores of one block where they may be among the k highest, else the least long.

    For each segment, |q.c - n mq mc| <= n sq sc (means m, deviations s), so
    every level bounds the product from both sides.  A pair stays while its upper bound
    reaches the k-th highest lower bound of its query.  ``own`` marks pairs of a
    row with itself.
    """
    top = float(max(np.abs(q).max(initial=0), np.abs(c).max(initial=0)))
    wide = top * top * max(1, q.shape[1]) >= 2.0 ** 52
    alive = ~own
    floor = np.full(len(q), -np.inf)
    for parts in LEVELS if c.shape[1] else ():
        (qm, qs), (cm, cs) = _segments(q, parts), _segments(c, parts)
        middle, spread = qm @ cm.T, qs @ cs.T
        slack = 1e-9 * (np.abs(middle).max(initial=0) + spread.max(initial=0)) + 1e-6
        if c.shape[0] > k:
            low = np.where(own, -np.inf, middle - spread - slack)
            kth = np.partition(low, -k, axis=1)[:, -k]
            floor = np.maximum(floor, kth)
        alive &= middle + spread + slack >= floor[:, None]
    if alive.mean() < SPARSE:
        rows, cols = np.nonzero(alive)
        out = np.full(alive.shape, _LEAST)
        out[rows, cols] = np.einsum("ij,ij->i", q[rows], c[cols])
        return out
    return np.where(alive, _dots(q, c, wide), _LEAST)


def _pack(x: np.ndarray) -> tuple[str, bytes]:
    kind = "<i2" if np.abs(x).max(initial=0) < 1 << 15 else "<i8"
    return kind, x.astype(kind).tobytes()


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """Each query's k highest scores: ``query_id, rank, vec_id, score``.

    Both tables hold ``rid`` (a number per row, equal for the same row in both),
    ``vec_id`` and ``vector`` (array<long>).  A row is not its own candidate.
    Ties go to the smaller ``vec_id``; vectors of different lengths never meet.
    Blocks of queries meet blocks of candidates; each pair of blocks is a task's
    work of fixed size and yields at most k rows per query.
    """
    blocks = parts_for(candidates.count(), CANDIDATES, 1 << 30)
    turns = parts_for(queries.count(), QUERIES, 1 << 30)
    packed = "n int, kind string, rids binary, ids binary, data binary"

    def bundle(key, pdf):
        pdf = pdf.sort_values(["vec_id", "rid"])
        x = np.array(pdf["vector"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
        kind, data = _pack(x)
        return pd.DataFrame([(*key, len(pdf), kind, pdf["rid"].to_numpy("int64").tobytes(),
                              pdf["vec_id"].to_numpy("int64").tobytes(), data)])

    def bundles(df: DataFrame, name: str, n: int) -> DataFrame:
        dealt = df.select("rid", "vec_id", "vector", F.size("vector").alias("dim"),
                          F.pmod(F.xxhash64("rid"), F.lit(n)).alias(name))
        return dealt.groupBy(name, "dim").applyInPandas(bundle, f"{name} long, dim int, {packed}")

    def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (np.frombuffer(row.rids, "<i8"), np.frombuffer(row.ids, "<i8"),
                np.frombuffer(row.data, row.kind).reshape(row.n, -1).astype(np.int64))

    def meet(pdf):
        empty = pd.DataFrame({"query_rid": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        sides = {side: part for side, part in pdf.groupby("side")}
        if len(sides) < 2:
            return empty
        q_rid, q_id, q = unpack(next(sides["q"].itertuples()))
        c_rid, c_id, c = unpack(next(sides["c"].itertuples()))
        found = []
        for a in range(0, len(q), 512):
            s = slice(a, a + 512)
            own = q_rid[s, None] == c_rid[None, :]
            score = block_topk(q[s], c, own, k)
            some = min(k, score.shape[1])
            # Candidates are sorted by id: of equal scores the first ones count.
            best = np.argsort(-score.astype(np.float64), axis=1, kind="stable")[:, :some] \
                if np.abs(score[score != _LEAST]).max(initial=0) < 1 << 52 \
                else np.stack([np.lexsort((np.arange(len(c)), ~r))[:some] for r in score])
            rows = np.repeat(np.arange(len(best)), some)
            cols = best.ravel()
            good = score[rows, cols] != _LEAST
            rows, cols = rows[good], cols[good]
            found.append(pd.DataFrame({"query_rid": q_rid[s][rows], "query_id": q_id[s][rows],
                                       "vec_id": c_id[cols], "score": score[rows, cols]}))
        return pd.concat(found) if found else empty

    left = bundles(queries, "turn", turns).select(
        F.lit("q").alias("side"), "turn", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "dim", "n", "kind", "rids", "ids", "data")
    right = bundles(candidates, "block", blocks).select(
        F.lit("c").alias("side"), F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"), "block",
        "dim", "n", "kind", "rids", "ids", "data")
    met = left.unionByName(right).groupBy("turn", "block", "dim").applyInPandas(
        meet, "query_rid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_rid").orderBy(F.col("score").desc(), "vec_id")
    return (met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def scaled_top_k(vectors: DataFrame, every: int, scale: int = 64, k: int = K,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows whose id is divisible by ``every`` against all rows, components as floor(scale * x).

    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without an id.  Repeated rows are candidates of each other.
    """
    usable = vectors.where(valid_vector(quoted(vector_col)) & quoted(id_col).isNotNull())
    whole = materialise(usable.select(
        F.monotonically_increasing_id().alias("rid"), quoted(id_col).cast("long").alias("vec_id"),
        F.transform(quoted(vector_col), lambda x: F.floor(x.cast("double") * scale)).alias("vector")),
        "vectors")
    return top_k(whole.where(F.col("vec_id") % every == 0), whole, k)
