import math
import random

import pytest
from pyspark.sql import Row

from sluice.operators import clean, profile
from sluice.plans import funnel


@pytest.fixture()
def dups(spark):
    return spark.createDataFrame(
        [(1, "x", 1.0), (1, "x", 1.0), (2, None, None), (2, None, None), (3, "y", None)],
        "id int, a string, b double")


def test_duplicates_with_nulls_merge(dups):
    assert profile.drop_duplicates(dups).count() == 3
    assert profile.duplicate_audit(dups).collect() == [
        Row(rows=5, distinct_rows=3, duplicate_rows=2)]
    assert profile.duplicate_audit(dups.limit(0)).collect() == [
        Row(rows=0, distinct_rows=0, duplicate_rows=0)]


def test_shape_and_distinct(dups):
    assert profile.table_shape(dups).collect() == [Row(rows=5, columns=3)]
    assert {r.a for r in profile.distinct_values(dups, "a").collect()} == {"x", "y", None}


def test_odd_names_can_be_dropped_renamed_and_profiled(spark):
    df = spark.createDataFrame([("web", 1.0)], "`Lead_Source ` string, `Rate(%).x/y` double")
    trimmed = clean.trim_names(df)
    assert trimmed.columns == ["Lead_Source", "Rate(%).x/y"]
    assert clean.rename_columns(trimmed, {"Rate(%).x/y": "rate"}).columns == ["Lead_Source", "rate"]
    assert profile.column_profile(trimmed, exact=True).count() == 2
    assert profile.column_profile(trimmed).count() == 2
    assert clean.typed_columns(trimmed).count() == 2


def test_absent_names_raise_or_are_reported(dups):
    with pytest.raises(ValueError, match="nope"):
        clean.drop_columns(dups, ["a", "nope"])
    with pytest.raises(ValueError, match="nope"):
        clean.rename_columns(dups, {"nope": "z"})
    assert clean.drop_columns(dups, ["A", "nope"], strict=False).columns == ["id", "b"]
    assert clean.absent_columns(dups, ["A", "nope"]) == ["nope"]


def test_blanks_around_a_name_do_not_matter(spark):
    df = spark.createDataFrame([("a", 1)], "`Lead_Source ` string, n int")
    assert clean.resolve_columns(df, ["Lead_Source", "lead_source ", "N", "zz"]) == [
        "Lead_Source ", "Lead_Source ", "n", "zz"]
    assert clean.drop_columns(df, ["Lead_Source"]).columns == ["n"]
    assert clean.rename_columns(clean.trim_names(df), {"Lead_Source ": "s"}).columns == ["s", "n"]


def test_dates_are_not_numbers(spark):
    df = spark.sql("SELECT 1 AS n, 'a' AS c, DATE'2020-01-01' AS d, true AS t, "
                   "array(1) AS other, 'Converted' AS y")
    roles = {c: r for c, _, r in clean.column_roles(df.schema, "y")}
    assert roles == {"n": "numeric", "c": "categorical", "d": "temporal", "t": "categorical",
                     "other": "other", "y": "label"}
    assert clean.numeric_columns(df) == ["n"]


def test_incomplete_and_unknown_rows_drop(spark):
    fitted = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    df = spark.createDataFrame([("a", 1), ("z", 2), (None, 3), ("b", None)], "c string, n int")
    kept = clean.keep_known(df, fitted, ["c"])
    assert kept.columns == ["c", "n"]
    assert {tuple(r) for r in kept.collect()} == {("a", 1), ("b", None)}
    assert {tuple(r) for r in clean.drop_incomplete(df, ["c", "n"]).collect()} == {
        ("a", 1), ("z", 2)}


def test_cleaning_merges_rows_that_differ_only_in_the_dropped_column(spark):
    raw = spark.createDataFrame([("c1", "o1", 3.5, 7), ("c1", "o2", 3.5, 7)],
                                "Customer_ID string, Order_ID string, `Interest_Rates_(%)` double, "
                                "`Time_to_purchase(Days)` int")
    assert funnel.clean_sales(raw).collect() == [
        Row(Customer_ID="c1", Interest_rate=3.5, Days_to_purchase=7)]


def discrete(values, p):
    ranked = sorted(values)
    return ranked[max(1, math.ceil(p * len(ranked))) - 1]


@pytest.mark.parametrize("bits", [16, 5])
def test_exact_percentiles_match_sorting(spark, monkeypatch, bits):
    monkeypatch.setattr(profile, "BITS", bits)
    rng = random.Random(7)
    rows = [(rng.gauss(0, 100), rng.choice([0, 0, 0, 1, 5]), 1 if i % 3 else None)
            for i in range(5000)]
    df = spark.createDataFrame(rows, "x double, skewed int, holes int").repartition(5)
    ps = (0.01, 0.25, 0.5, 0.99, 1.0)
    got = {(r.column, r.percentile): r.value
           for r in profile.exact_percentiles(df, df.columns, ps).collect()}
    for i, c in enumerate(df.columns):
        for p in ps:
            assert got[c, p] == discrete([r[i] for r in rows if r[i] is not None], p), (c, p)


def test_codes_are_in_the_order_of_the_doubles(spark):
    rng = random.Random(3)
    edge = [0.0, 5e-324, 1e-310, 2.0 ** -1022, 1.0, 1.7976931348623157e308, math.inf]
    values = [*edge, *[2.0 ** k for k in range(-1074, 1024, 7)],
              *[math.nextafter(2.0 ** k, d) for k in range(-1000, 1000, 13) for d in (0.0, math.inf)],
              *[rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(300)]]
    values = sorted({*values, *[-v for v in values]}) + [math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.c for r in df.coalesce(1).select(profile._code(df.v).alias("c")).collect()]
    assert got == [profile.code_of(v) for v in values]
    assert got == sorted(set(got))
    parts = [r.c for r in df.coalesce(1).select(profile._octave_part(df.v).alias("c")).collect()]
    assert parts == sorted(parts) and parts.count(0) == 1


def test_far_apart_and_equal_values(spark):
    rows = [(1e300, 7.0, -0.0), (-1e-300, 7.0, 0.0), (math.nextafter(1.0, 2.0), 7.0, 0.0), (1.0, 7.0, -1.0)]
    df = spark.createDataFrame(rows, "x double, same double, zeros double")
    ps = (0.25, 0.5, 0.75, 1.0)
    got = {(r.column, r.percentile): r.value for r in profile.exact_percentiles(df, df.columns, ps).collect()}
    for i, c in enumerate(df.columns):
        assert [got[c, p] for p in ps] == sorted(r[i] for r in rows)


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double, t string")
    assert profile.exact_percentiles(empty, ["x"], (0.5,)).count() == 0
    assert profile.exact_percentiles(empty, [], (0.5,)).count() == 0
    rows = profile.column_profile(empty, exact=True).collect()
    assert {(r.column, r["values"], r.p50) for r in rows} == {("x", 0, None), ("t", 0, None)}
    assert profile.column_profile(empty).where("p50 IS NULL").count() == 2


def test_estimates_stay_close(spark):
    df = spark.range(20_000).selectExpr("id", "id % 100 AS few")
    rows = {r.column: r for r in profile.column_profile(df).collect()}
    assert abs(rows["id"].distinct - 20_000) < 2_000 and rows["id"].nulls == 0
    assert abs(rows["id"].p50 - 10_000) < 200
    assert (rows["few"].min, rows["few"].max) == ("0", "99")
