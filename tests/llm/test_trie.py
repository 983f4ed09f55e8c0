import collections
import hashlib
import random
import re
import zlib

import pytest

from sluice.llm import prefix_trie as P
from sluice.llm.queries import ORACLES, QUERIES
from tests import compare

COLUMNS = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"


def brute(rows, every=20, most=4):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - c % every, [])[:h] + ts[h:])
    members = collections.defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(re.findall(P.WORD, m[-1][1])) for m in below if m)
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in members)]
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
                    sum(len(m) == len(node) + 1 for m in below), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def unordered_ties(rows):
    """Ties are ordered by digest, so brute force gets each place in a conversation once."""
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


@pytest.mark.parametrize("seed, longest", [(1, 3), (2, 9), (3, 70)])
def test_like_brute_force(spark, seed, longest, monkeypatch):
    monkeypatch.setattr(P, "SORTED", 40)  # conversations lie across tasks
    monkeypatch.setattr(P, "CHUNK_BITS", 2)
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(90), 40 if longest < 50 else 12):
        for t in range(rng.randrange(1, longest + 1)):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]),
                         rng.choice(["a b", "a", "", None]) if t > 4 else "same  words\there"))
    assert result(P.conversation_trie(frame(spark, rows))) == brute(unordered_ties(rows))


def test_one_conversation_of_most_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "SORTED", 30)
    rows = [(1, t, "user", "x") for t in range(300)] + [(c, 0, "user", "x") for c in (2, 3, 5)]
    assert result(P.conversation_trie(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (7, 0, "user", "b" * 10_000), (7, 0, "user", "b" * 10_000), (8, None, None, None)]
    df = frame(spark, rows).withColumnRenamed("role", "name").selectExpr("*", "1 AS depth", "2 AS pos")
    got = result(P.conversation_trie(df, role_col="name"))
    assert got == brute([r for r in rows if r[0] != 7] + [(7, 0, "user", "b" * 10_000), (7, 1, "user", "b" * 10_000)])
    assert P.conversation_trie(frame(spark, rows).where("false")).count() == 0


def test_turnless_conversations(spark):
    # 23 takes the first turns of 20, which is absent, and loses its own.
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(20, 40)}
    rows = [(c, 0, "user", "x") for c in range(21, 40) if h[c]][:5]
    assert result(P.conversation_trie(frame(spark, rows))) == brute(rows)


def test_query(spark, small):
    assert compare.check(spark, "op11_conversation_trie", small, QUERIES, ORACLES) is None
