import random
import re

import numpy as np

from sluice.llm import quality_forest as Q
from sluice.llm.queries import QUERIES


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    dup = sum(1 for k, x in enumerate(lines) if re.search("[^\x20\x09-\x0D]", x) and x in lines[:k])
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again))


def test_counts_like_brute_force(spark, small):
    texts = [None, "", " \n ", "a\na\na", "x y z x y z x", "é\x85日 ##\n\n a\r\na\r", "\x1c a \xa0 b", "a b c a b c d a b"]
    texts += [d.text[:3000] for d in spark.read.parquet(f"{small}/documents.parquet").limit(40).collect()]
    for t in texts:
        assert Q.rule_statistics(t)[0] == brute(t), t


def test_forest_isolates_outliers():
    rng = np.random.default_rng(3)
    rows = rng.normal(0, 1, (500, len(Q.FEATURES)))
    odd = rows[:5] + 8
    forest = Q.Forest(np.concatenate([rows, odd]))
    assert forest.scores(odd).min() > np.quantile(forest.scores(rows), 0.99)
    assert Q.Forest(np.zeros((0, len(Q.FEATURES)))).scores(odd).tolist() == [0.0] * 5
    assert 0 < Q.Forest(np.ones((3, len(Q.FEATURES)))).scores(odd).max() <= 1


def test_threshold_spares_good_rows(spark):
    rows = [(k / 1000, 1) for k in range(500)] + [(0.5 + k / 1000, 0) for k in range(200)] + [(0.95, 1)]
    scored = spark.createDataFrame(rows, "score double, quality int")
    cut = Q.best_threshold(scored, tolerance=0.01)
    assert 0.49 < cut <= 0.5
    assert Q.best_threshold(scored.where("quality = 1")) == float("inf")
    assert Q.best_threshold(scored.where("false")) == float("inf")


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, nearly all labelled good documents stay and most bad ones go."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = "pmod(xxhash64(doc_id), 2) = 1"
    out = Q.quality_rules(docs, labels.where(f"NOT ({held})")).join(
        labels.where(held).withColumnRenamed("doc_id", "id"), "id").where("NOT base_failed").collect()
    good = [r.kept for r in out if r.quality == 1]
    bad = [r.kept for r in out if r.quality == 0]
    assert len(good) > 50 and sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_query_and_filter(spark, small, docs_of):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op5_quality_rules"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, *_, again = counts = brute(docs[r.doc_id].text)
        assert tuple(r)[1:6] == counts and r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{small}/labels.parquet")
    kept = Q.quality_filter(spark.read.parquet(f"{small}/documents.parquet"), labels)
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(docs[r.doc_id]) for r in rows if r.kept)


def test_odd_rows(spark, docs_of):
    words = " ".join(f"w{random.Random(1).random()}{i}" for i in range(60))
    df = docs_of([(None, words), (1, None), (2, words), (2, words), (3, "")])
    labels = spark.createDataFrame([(2, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r.doc_id or 0 for r in Q.quality_filter(df, labels).collect()) == [0, 2, 2]
    assert Q.quality_rules(df, labels.where("false")).where("kept").count() == 3
    assert Q.quality_filter(df.where("false"), labels).count() == 0
