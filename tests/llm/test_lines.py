import hashlib
import random
import re
import time

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from sluice.llm import common as C
from sluice.llm import line_dedup as D


def norm(line):
    low = regex.sub(r"\p{N}+", "0", line.lower())
    return regex.sub(r"[^\p{L}0]+", " ", low).strip(" ")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(spark, pairs):
    """Groups by comparing every two distinct lines; hashes of words come from Spark."""
    lines = [(k, p, norm(x)) for k, (_, t) in enumerate(pairs) if t is not None
             for p, x in enumerate(t.split("\n")) if norm(x)]
    distinct = sorted({n for *_, n in lines})
    words = sorted({w for n in distinct for w in n.split(" ")})
    h = {r.w: r.h & (1 << 64) - 1 for r in spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", F.xxhash64("w").alias("h")).collect()} if words else {}
    marks = {}
    for n in distinct:
        bits = np.array([[h[w] >> b & 1 for b in range(64)] for w in n.split(" ")])
        marks[n] = sum(1 << b for b in range(64) if 2 * bits[:, b].sum() > len(bits))
    root = {n: n for n in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            x, y = a.split(" "), b.split(" ")
            if (marks[a] ^ marks[b]).bit_count() <= 3 and edits(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                root[find(a)] = find(b)
    order = sorted(lines, key=lambda r: (pairs[r[0]][0] is None, pairs[r[0]][0] or 0, r[0], r[1]))
    seen, gone = set(), set()
    for k, p, n in order:
        if find(n) in seen:
            gone.add((k, p))
        seen.add(find(n))
    return [None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (k, p) not in gone)
            for k, (_, t) in enumerate(pairs)]


def test_like_brute_force(spark, docs_of):
    rng = random.Random(9)
    vocabulary = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)]
    long = [[rng.choice(vocabulary) for _ in range(rng.choice([30, 60, 120]))] for _ in range(12)]
    texts = [None, "", "\n\n", "...", "Page 1", "page 22!", "one\ntwo\nONE", "ünï 日本\nÜNÏ, 日本"]
    for _ in range(50):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            words = list(rng.choice(long))
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(rng.choice(["", "- ", "* "]) + " ".join(words) + rng.choice(["", ".", " 7"]))
        texts.append("\n".join(lines))
    texts.append(texts[-1])
    ids = [rng.choice([k, k, k, 5, None]) for k in range(len(texts))]
    ids[-1] = ids[-2] = 40
    pairs = list(zip(ids, texts))
    df = docs_of(pairs)
    out = D.line_dedup(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    rows = sorted(out.collect(), key=lambda r: r.chunk)
    want = brute(spark, pairs)
    assert [r.text for r in rows] == want
    assert [r.n_lines for r in rows] == [0 if t is None else t.count("\n") + 1 for t in texts]
    assert sum(r.n_removed for r in rows) > 20
    # Fuzzy lines went too, not only equal ones.
    exact = {norm(x) for t in want if t for x in t.split("\n")}
    assert len(exact) < len({norm(x) for t in texts if t for x in t.split("\n")})


def test_equal_simhash_of_other_lines(spark, docs_of):
    """The same words in another order have the same SimHash, but are no copies."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    a, b = " ".join(words), " ".join(words[::-1])
    rows = D.line_dedup(docs_of([(1, a), (2, b), (3, b + " "), (4, a)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (2, 0), (3, 1), (4, 1)]


def test_large_class_and_long_lines(spark, docs_of):
    """One word outweighs all others, so unlike lines share a SimHash; each keeps its own group."""
    tails = [[chr(97 + i) + chr(97 + j) + "x" for j in range(9)] for i in range(12)]
    lines = [" ".join(["same"] * 12 + t) for t in tails]
    lines += [" ".join(["same"] * 12 + t[:-1] + ["other"]) for t in tails]
    lines.append(" ".join(f"w{'abcdefghij'[k % 10]}" for k in range(700)))
    lines.append(" ".join(["heavy"] * 400 + [f"v{'abcdefghij'[k % 10]}" for k in range(300)]))
    lines.append(lines[-1].replace("va ", "vz ", 1))
    rows = sorted(D.line_dedup(docs_of(list(enumerate(lines)))).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == brute(spark, list(enumerate(lines)))
    assert [r.n_removed for r in rows] == [0] * 12 + [1] * 12 + [0, 0, 1]


def test_empty_table_and_plan(spark, docs_of):
    df = docs_of([(1, "x")]).where("false")
    assert D.line_dedup(df).count() == 0
    plan = D.line_dedup(docs_of([(1, "x\nx")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(Eval|Map)", plan)


@pytest.mark.parametrize("n", [60, 120])
def test_chain_of_one_simhash(spark, docs_of, n):
    """Each line is an edit or two from the next and far from most; one SimHash for all."""
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}q" for i in range(n + 30)]
    pairs = [(k, " ".join(["same"] * 24 + words[k:k + 20])) for k in random.Random(n).sample(range(n), n)]
    rows = {r.doc_id: r.text for r in D.line_dedup(docs_of(pairs)).collect()}
    assert [rows[i] for i, _ in pairs] == brute(spark, pairs)
    assert sum(t != "" for t in rows.values()) == 1


def test_leaders_bound_the_first_pass(spark):
    """A SimHash or block of many lines gives a row per line, and none once they are one group."""
    lines = spark.range(500).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("key"),
                                    F.when(F.col("id") < 300, 5).otherwise(4).cast("long").alias("fp"))
    marks = lines.groupBy("fp").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n"))
    assert D.leader_pairs(lines, marks).count() == 299 + 199 + 1
    assert D.open_pairs(lines.withColumn("root", F.lit(1))).count() == 0
    apart = lines.withColumn("root", F.when(F.col("fp") == 5, 1).otherwise(2))
    assert D.open_pairs(apart).count() == 300 * 200


def test_short_lines_are_never_similar(spark, docs_of):
    assert D.least_words(0.8) == 4
    pairs = [(1, "red blue green"), (2, "red blue"), (3, "red blue green grey"), (4, "red blue green grey pink"), (5, "red blue!")]
    rows = sorted(D.line_dedup(docs_of(pairs)).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == brute(spark, pairs)
    assert rows[4].n_removed == 1


def test_columns_named_like_the_counts(spark, docs_of):
    df = docs_of([(1, "x"), (2, "x")]).withColumn("n_lines", F.lit(7))
    rows = sorted(D.line_dedup(df).collect(), key=lambda r: r.doc_id)
    assert [(r.n_lines, r._n_lines, r.n_removed) for r in rows] == [(7, 1, 0), (7, 1, 1)]


def test_long_unlike_lines_of_near_simhashes_do_not_meet(spark, docs_of):
    """Lines of common words have one SimHash; what is compared are the few that may be similar."""
    rng = random.Random(4)
    vocabulary = [f"{chr(97 + i)}{chr(97 + j)}y" for i in range(20) for j in range(20)]
    tails = [rng.sample(vocabulary, 60) for _ in range(40)]
    tails += [t[:50] + rng.sample(vocabulary, 10) for t in tails[:10]]
    pairs = list(enumerate(" ".join(["same"] * 61 + t) for t in tails))
    texts = docs_of(pairs).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("rid"), "text")
    lines = D.line_hashes(texts, 4).withColumn("root", F.xxhash64("key"))
    assert lines.select("fp").distinct().count() == 1
    assert D.open_pairs(lines.select("key", "fp", "root")).count() == 50 * 49 // 2
    assert D.open_pairs(lines.select("key", "fp", "root", "n", *D.MARKS)).count() < 100
    rows = sorted(D.line_dedup(docs_of(pairs)).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == brute(spark, pairs)
    assert sum(r.n_removed for r in rows) == 10


def test_blocks_keep_only_near_simhashes(spark):
    """Of SimHashes that share a block, those that are near none go; none of a near pair does."""
    rng = random.Random(3)
    fps = [5 + (rng.getrandbits(36) << 27) for _ in range(300)]
    fps += [fps[0] ^ 7 << 40, fps[1] ^ 1 << 30]
    pairs = [(a, b) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 3]
    rows = D.shared_blocks(spark.createDataFrame([(f,) for f in [*fps, None]], "fp long")).collect()
    blocks = {f: {r.block for r in rows if r.fp == f} for f in fps}
    assert {f for f in fps if blocks[f]} == {a for a, _ in pairs}
    assert len(pairs) < 20 and all(blocks[a] & blocks[b] for a, b in pairs)
    assert all(r.lead == min(x.fp for x in rows if x.block == r.block) for r in rows)


def test_digest_once_per_line(spark, docs_of):
    """The digest of a line is computed before its words are rows."""
    texts = docs_of([(1, "a b c d")]).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("rid"), "text")
    plan = D.line_hashes(texts, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1
    assert plan.index("md5(") > plan.index("posexplode(split(norm")


def test_steps_leave_no_shuffle_files(spark, docs_of):
    """What a step shuffled is gone from the disk when the operator returns, and the setting is as before."""
    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().endswith(".data")}
    rng = random.Random(6)
    words = [f"{chr(97 + i)}{chr(97 + j)}z" for i in range(20) for j in range(20)]
    docs = docs_of([(k, "\n".join(" ".join(rng.sample(words, 12)) for _ in range(6))) for k in range(40)])
    setting = spark.conf.get(C.CLEANUP, None)
    before = held()
    out = D.line_dedup(docs)
    for _ in range(50):
        if not (left := held() - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(C.CLEANUP, None) == setting
    assert out._jdf.queryExecution().shuffleCleanupMode().toString().startswith("DoNotCleanup")
    assert sorted(out.collect()) == sorted(out.collect()) and out.count() == 40


def test_setting_comes_back_after_nested_and_failed_runs(spark, docs_of):
    docs, seen = docs_of([(1, "x")]), []
    setting = spark.conf.get(C.CLEANUP, None)

    @C.without_shuffles_left
    def fails(docs):
        seen.append(spark.conf.get(C.CLEANUP))
        raise ValueError

    @C.without_shuffles_left
    def outer(docs):
        with pytest.raises(ValueError):
            fails(docs)
        seen.append(spark.conf.get(C.CLEANUP))
        return docs
    outer(docs)
    assert seen == ["true", "true"]
    assert spark.conf.get(C.CLEANUP, None) == setting


def test_hashing_is_code_that_the_jvm_compiles(spark, docs_of):
    """Methods over 8000 bytes are never compiled; a CASE per bit of the SimHash made one of 13,556."""
    texts = docs_of([(1, "a b c d")]).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("rid"), "text")
    setting = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # else the code is not known before the run
    try:
        plan = D.line_hashes(texts.repartition(2, "rid"), 4)._jdf.queryExecution()
        code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set(setting, before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
    assert "Project" in code


def test_digest_keeps_all_its_bits(spark, docs_of):
    """The halves of a digest may begin with zeros or be negative."""
    norms = [f"{chr(97 + i)}{chr(97 + j)}w" for i in range(26) for j in range(26)]
    texts = docs_of([(1, "\n".join(norms))]).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("rid"), "text")
    rows = D.line_hashes(texts, 4).select("pos", F.hex("key").alias("key")).collect()
    assert {r.pos: r.key.lower() for r in rows} == {k: hashlib.md5(n.encode()).hexdigest() for k, n in enumerate(norms)}


def test_components_of_names_are_found_by_numbers(spark):
    """Names get numbers in their order, so the root is the smallest name still."""
    rng = random.Random(5)
    names = [f"{rng.getrandbits(64):016X}" for _ in range(60)]
    edges = [(rng.choice(names[g::6]), rng.choice(names[g::6])) for g in range(6) for _ in range(30)]
    root = {n: {n} for n in names}
    for a, b in edges:
        both = root[a] | root[b]
        for n in both:
            root[n] = both
    got = {r.node: r.root for r in D.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {n: min(g) for n, g in root.items() if n != min(g)}
    none = D.components(spark.createDataFrame([], "u string, v string"))
    assert none.dtypes == [("node", "string"), ("root", "string")] and none.count() == 0
