import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import joins


@pytest.fixture()
def four(spark):
    """Null keys, keys missing on one side, keys repeated on two sides."""
    a = spark.createDataFrame([(1, "a1"), (2, "a2"), (None, "a?"), (3, "a3")], "k int, a string")
    b = spark.createDataFrame([(1, "b1"), (2, "b2"), (None, "b?"), (4, "b4")], "k int, b string")
    c = spark.createDataFrame([(1, "c1"), (1, "c1"), (2, "c2")], "k int, c string")
    d = spark.createDataFrame([(1, "d1"), (1, "d2"), (1, "d3"), (2, "d4")], "k int, d string")
    return a, b, c, d


def bag(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_repeated_keys_multiply_and_null_keys_drop_out(four):
    rows = bag(joins.join_on_key(four, "k"))
    assert sum(rows.values()) == 2 * 3 + 1
    assert rows[("a1", "b1", "c1", "d1", 1)] == 2
    assert joins.join_on_key(four, "k").columns.count("k") == 1


def test_order_does_not_matter(four):
    want = bag(joins.join_on_key(four, "k"))
    for order in list(itertools.permutations(four))[5::6]:
        assert bag(joins.join_on_key(order, "k", hot=joins.HotKeys())) == want
        assert bag(joins.join_on_key(order, "k", per_task=2)) == want


def test_shared_names_are_refused(spark, four):
    with pytest.raises(ValueError, match="A"):
        joins.join_on_key([four[0], four[1].withColumnRenamed("b", "A")], "k")


@pytest.fixture()
def skewed(spark):
    """Key 7 holds a third of the rows on two sides; some of its rows are copies."""
    left = spark.range(300).selectExpr("IF(id % 3 = 0, 7, 1000 + id) AS k", "id % 50 AS x")
    right = spark.range(90).selectExpr("IF(id % 3 = 0, 7, 1000 + id) AS k", "id % 9 AS y")
    third = spark.range(1200).selectExpr("id AS k", "id * 2 AS z")
    return left.repartition(5), right.repartition(3), third


def axes(hot):
    return {r._hot: list(r._axes) for r in hot.grid.collect()}


def test_hot_keys_are_those_of_many_pairs(spark, skewed):
    hot = joins.hot_keys(skewed, "k", per_task=50)
    assert set(axes(hot)) == {7}
    a, b, c = axes(hot)[7]
    assert (100 / a) * (30 / b) <= 60 and c == 1
    assert not joins.hot_keys(skewed, "k", per_task=3000)
    assert joins.hot_keys(skewed, "k", per_task=2999)
    assert not joins.hot_keys([skewed[0].limit(0), skewed[1]], "k", per_task=1)


def test_axes_follow_each_sides_own_rows(spark):
    """Nine tenths of a large table under one key, and five rows of it on the other side."""
    large = spark.range(20_000).selectExpr("IF(id % 10 < 9, 7, id) AS k", "id AS x")
    small = spark.range(40).selectExpr("IF(id < 5, 7, 100000 + id) AS k", "id AS y")
    hot = joins.hot_keys([small, large], "k", per_task=1000)
    assert axes(hot) == {7: [1, 90]}  # 200 rows of the large table and all five in a cell
    assert axes(joins.hot_keys([large, small], "k", per_task=1000)) == {7: [90, 1]}
    got = joins.join_on_key([small, large], "k", hot=hot)
    assert got.count() == 5 * 18_000
    cells = joins._on_grid(large, "k", 1, hot).groupBy("_cell").count().agg(
        F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).first()
    assert cells.n == 90 and cells.most <= 210


def test_no_bound_on_the_grid(spark):
    """Two large sides: as many cells as the product demands, each within its share."""
    one = spark.range(3000).selectExpr("7 AS k", "id AS x")
    two = spark.range(2000).selectExpr("7 AS k", "id AS y")
    hot = joins.hot_keys([one, two], "k", per_task=900)
    a, b = axes(hot)[7]
    assert (a, b) == (100, 67)
    joined = joins._on_grid(one, "k", 0, hot).join(joins._on_grid(two, "k", 1, hot), ["k", "_cell"])
    sizes = joined.groupBy("_cell").count().agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("most"),
                                                F.sum("count").alias("all")).first()
    assert (sizes.n, sizes.all) == (a * b, 6_000_000) and sizes.most <= 1.2 * 900  # tasks number their rows on their own
    assert joined.select("x", "y").distinct().count() == 6_000_000


def test_copies_of_a_row_are_dealt_out_too(spark):
    same = spark.range(1, numPartitions=1).selectExpr("7 AS k", "explode(array_repeat('a', 1000)) AS x")
    other = spark.range(3).selectExpr("7 AS k", "id AS y")
    hot = joins.hot_keys([same, other], "k", per_task=30)
    sizes = joins._on_grid(same, "k", 0, hot).groupBy("_cell").count().collect()
    assert len(sizes) == 100 and max(r["count"] for r in sizes) == 10
    assert joins.join_on_key([same, other], "k", hot=hot).count() == 3000


@pytest.mark.parametrize("per_task", [1, 7, 40, 500])
def test_spread_join_equals_plain_join(skewed, per_task):
    plain = skewed[0].join(skewed[1], "k").join(skewed[2], "k")
    got = joins.join_on_key(skewed, "k", per_task=per_task)
    assert bag(got) == bag(plain) and got.columns == plain.columns


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_hot_keys(spark, skewed, how):
    facts = skewed[0].unionByName(spark.createDataFrame([(None, 1), (None, 1), (-5, 2)], "k long, x long"))
    lookup = skewed[2].where("k % 2 = 0").unionByName(spark.createDataFrame([(7, 1), (7, 2)], "k long, z long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for chosen in (lookup, lookup.where("k <> 7")):  # a hot key that the lookup lacks is spread as well
            hot = joins.lookup_hot_keys(facts, chosen, "k", per_task=20)
            assert set(axes(hot)) == {7}
            got = joins.attach_lookup(facts, chosen, "k", how, hot=hot)
            plain = facts.join(chosen, "k", how)
            key = lambda df: Counter(map(str, bag(df).elements()))
            assert key(got) == key(plain) and got.columns == plain.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not joins.lookup_hot_keys(facts, skewed[2], "k", per_task=20)  # small enough to be broadcast


def test_maps_do_not_stand_in_the_way(spark):
    facts = spark.range(60).selectExpr("IF(id % 2 = 0, 7, id) AS k", "map('a', id) AS m",
                                       "array(named_struct('x', map(1, id))) AS nested")
    lookup = spark.range(60).selectExpr("id AS k", "id AS z")
    got = joins.attach_lookup(facts, lookup, "k", hot=joins.hot_keys([facts, lookup], "k", per_task=5))
    assert sorted(r.m["a"] for r in got.collect()) == list(range(60))


def test_join_size_predicts_the_join(four, skewed):
    for tables in (four, skewed):
        row = joins.join_size(tables, "k").first()
        assert row.joined_rows == joins.join_on_key(tables, "k").count()
    assert row.rows_0 == 300 and row.max_rows_per_key_0 == 100


@pytest.mark.parametrize("text,size", [("-1", -1), ("10485760b", 10 << 20), ("10MB", 10 << 20),
                                       ("64k", 64 << 10), ("2g", 2 << 30)])
def test_sizes(text, size):
    assert joins._as_bytes(text) == size
