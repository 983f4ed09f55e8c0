import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import encode
from sluice.operators import joins
from sluice.operators.index import WideIndex, fit_wide_index


def expected(values):
    counts = Counter(v for v in values if v is not None)
    return {v: float(i) for i, (v, _) in enumerate(sorted(counts.items(), key=lambda e: (-e[1], e[0].encode())))}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["", " ", "a", "B", "é", "日本", "a.b", "`", "\n"] + [f"w{k}" for k in range(300)]
    return [(i, rng.choice(words) if rng.random() < 0.6 else "hot", rng.choice([None, "x", "y", "z"]),
             rng.choice([1.5, 2.0, None])) for i in range(4000)]


def test_like_the_stage_on_narrow_columns(spark, rows):
    df = spark.createDataFrame(rows, "id long, wide string, `few.er` string, num double")
    named = df.withColumnRenamed("few.er", "fewer")
    index = fit_wide_index(named, ["wide", "fewer", "num"])
    ours = index.transform(named).orderBy("id").collect()
    stage = encode.string_indexer(["wide", "fewer", "num"]).fit(named).transform(named).orderBy("id").collect()
    assert [tuple(r) for r in ours] == [tuple(r) for r in stage]
    assert index.sizes == [len(expected([r[1] for r in rows])), 3, 2]
    dotted = fit_wide_index(df, ["few.er"]).transform(df)
    assert dotted.columns == ["id", "wide", "few.er", "num", "few.er_si"]
    want = expected([r[2] for r in rows])
    assert all(r[4] == want.get(r[2], 3.0) for r in dotted.collect())


def test_ranks_across_many_tasks(spark):
    """Levels far outnumber a task's; no place is given twice or left out."""
    df = spark.range(60_000).selectExpr("CAST(id % 20011 AS STRING) AS a", "CAST(id AS STRING) AS b")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = fit_wide_index(df, ["a", "b"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.sizes == [20011, 60_000]
    want = expected([str(i % 20011) for i in range(60_000)])
    got = index.levels.where("slot = 0").collect()
    assert {r.level: float(r["rank"]) for r in got} == want and len(got) == 20011
    got = [r.level for r in index.levels.where("slot = 1").orderBy("rank").collect()]
    assert got == sorted(map(str, range(60_000)))


def test_policies(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "c string")
    index = fit_wide_index(train, ["c"])
    probe = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("z", 3), (None, 4)], "c string, k int")
    kept = index.transform(probe).orderBy("k").collect()
    assert [r.c_si for r in kept] == [1.0, 2.0, 0.0, 3.0, 3.0]
    assert [r.k for r in index.transform(probe, handle_invalid="skip").orderBy("k").collect()] == [0, 1, 2]
    assert index.transform(probe.where("k < 3"), handle_invalid="error").count() == 3
    with pytest.raises(PySparkException, match="null or unseen text in c"):
        index.transform(probe, handle_invalid="error").collect()
    with pytest.raises(ValueError, match="keep, skip, error"):
        index.transform(probe, handle_invalid="drop")
    with pytest.raises(ValueError, match="present already: c_si"):
        index.transform(probe.withColumn("C_SI", F.lit(1)))


def test_empty_and_all_null(spark):
    none = spark.createDataFrame([(None, "x")] * 3, "a string, b string")
    index = fit_wide_index(none, ["a", "b"])
    assert index.sizes == [0, 1]
    assert [(r.a_si, r.b_si) for r in index.transform(none).collect()] == [(0.0, 0.0)] * 3
    empty = fit_wide_index(none.where("false"), ["a"])
    assert empty.sizes == [0] and empty.transform(none).count() == 3


def test_lookup_that_is_not_broadcast(spark, rows, monkeypatch):
    """Shuffled lookups with a level that holds two fifths of the rows give the same numbers."""
    df = spark.createDataFrame(rows, "id long, wide string, fewer string, num double")
    index = fit_wide_index(df, ["wide", "fewer"])
    want = index.transform(df).orderBy("id").collect()
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert index.transform(df).orderBy("id").collect() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_save_and_load(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "id long, wide string, fewer string, num double")
    index = fit_wide_index(df, ["wide", "num"])
    index.save(str(tmp_path / "index"))
    again = WideIndex.load(spark, str(tmp_path / "index"))
    assert again.sizes == index.sizes and again.columns == index.columns
    assert (again.transform(df).orderBy("id").collect() == index.transform(df).orderBy("id").collect())
