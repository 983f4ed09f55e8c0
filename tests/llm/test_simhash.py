import random

import xxhash
from pyspark.sql import functions as F

from sluice.llm import simhash_dedup as S
from sluice.llm.components import components


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks, distance):
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    marks = sorted(root)
    for i, a in enumerate(marks):
        for b in marks[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {m: find(m) for m in marks}


def near_marks(rng, n=150):
    marks = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(3 * n):
        m = rng.choice(marks)
        for _ in range(rng.randrange(1, 4)):
            m ^= 1 << rng.randrange(64)
        marks.append(m)
    return marks


def test_fingerprints():
    for text in (None, "", " \n", "one", "One two", "a b c", "a b c a b c a b c", "É é A a 日本 b\x85c\xa0d"):
        assert S.fingerprint(text) == brute_fingerprint(text)


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(3)
    for distance, bucket in ((2, 64), (2, 2), (3, 3), (1, 2), (0, 64)):
        marks = sorted(set(near_marks(rng)))
        df = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "fp long")
        edges = S.links(df, distance, bucket)
        for r in edges.collect():
            assert ((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= distance
        got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(edges).collect()}
        want = brute_groups(marks, distance)
        groups = lambda m: sorted(map(sorted, _classes(m)))
        assert groups({m: got.get(m, m) for m in marks}) == groups(want), (distance, bucket)


def _classes(root):
    out = {}
    for m, r in root.items():
        out.setdefault(r, []).append(m)
    return out.values()


def test_thresholds_cover_the_distance(spark):
    df = spark.createDataFrame([(m % (1 << 63),) for m in near_marks(random.Random(1))], "fp long")
    for distance in (0, 1, 2, 4):
        plan = S.search_plan(df, distance)
        left_out = 0  # partitions that are not probed have threshold -1
        bits = [b for _, _, some in plan for b in some]
        assert len(bits) == len(set(bits))
        assert sum(t + 1 for _, t, _ in plan) - left_out == distance + 1


def test_groups_of_documents(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(400))
    pairs = [(5, base), (3, base), (9, base.replace("w200 ", "x ")), (None, base), (4, "other words here"),
             (7, None), (8, ""), (4, "other words here")]
    got = {(r.doc_id, r.fp): r["first"] for r in S.near_duplicates(docs_of(pairs)).collect()}
    marks = {}
    for i, t in pairs:
        marks.setdefault(brute_fingerprint(t), []).append(i)
    roots = brute_groups(list(marks), 2)
    for i, t in pairs:
        m = brute_fingerprint(t)
        ids = [x for k, v in marks.items() if roots[k] == roots[m] for x in v if x is not None]
        assert got[(i, m - (1 << 64) if m >> 63 else m)] == min(ids)
    kept = S.simhash_dedup(docs_of(pairs))
    assert kept.columns == docs_of(pairs).columns
    first = {}
    for i, t in pairs:
        first.setdefault(roots[brute_fingerprint(t)], []).append(i)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        min(i for i in ids if i is not None) for ids in first.values())
    assert S.simhash_dedup(docs_of(pairs).where("false")).count() == 0


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100)] + [(500 + rng.randrange(50), 600) for _ in range(60)] + [(7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(1, 101)} == {0} and 0 not in got
    star = {u for u, v in edges if v == 600}
    assert all(got[x] == min(star) for x in (star | {600}) - {min(star)})
    assert components(spark.createDataFrame([], "u long, v long").select(F.col("u"), F.col("v"))).count() == 0
