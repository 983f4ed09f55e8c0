import math
import random

import numpy as np

from sluice.llm import topk
from sluice.llm.queries import ORACLES, QUERIES
from tests.compare import check


def brute(rows, every, k=20):
    ok = [(n, i, [math.floor(64 * float(x)) for x in v]) for n, (i, v) in enumerate(rows)
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for m, j, c in ok
                            if m != n and len(c) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_like_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(topk, "CANDIDATES", 60)
    monkeypatch.setattr(topk, "QUERIES", 7)
    vector = lambda d: [rng.choice([rng.gauss(0, 0.3), 0.0, 0.25]) for _ in range(d)]
    rows = [(i, vector(8)) for i in range(200)]
    rows += [(40, rows[0][1]), (40, rows[0][1]), (60, None), (61, [None] * 8), (80, [float("nan")] * 8),
             (81, [float("inf")] * 8), (None, vector(8)), (100, vector(3)), (101, vector(3)), (120, []), (5, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rounded = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(map(tuple, topk.scaled_top_k(df, 20).collect()))
    assert got == brute(rounded, 20)
    assert topk.scaled_top_k(df.where("false"), 20).count() == 0


def test_bounds_keep_the_best():
    rng = np.random.default_rng(1)
    for scale in (3, 1000, 10 ** 9):
        q, c = (rng.integers(-scale, scale, (n, 48)) for n in (20, 400))
        c[:50] = c[50:100]
        score = topk.block_topk(q, c, np.zeros((20, 400), bool), 5)
        whole = q.astype(object) @ c.T.astype(object)
        for a, b in zip(score, whole):
            kth = sorted(b)[-5]
            assert all(a[j] == b[j] for j in range(400) if b[j] >= kth)


def test_query(spark, small):
    assert check(spark, "op10_exact_top_k", small, QUERIES, ORACLES) is None
