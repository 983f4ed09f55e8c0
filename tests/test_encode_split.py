import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.functions import class_name, percent
from sluice.operators import encode
from sluice.operators.split import random_split, split
from sluice.plans.funnel import CATEGORIES


def test_label_values(spark):
    df = spark.createDataFrame([("Converted",), ("Not Converted",), (None,)],
                               "Conversion_Status string")
    got = encode.label_binarize(df, "Conversion_Status").collect()
    assert [(r.Conversion_Status, r.label) for r in got] == [
        ("Converted", 0.0), ("Not Converted", 1.0)]
    assert encode.unlabelled_rows(df, "Conversion_Status").collect() == [
        Row(unlabelled_rows=1, rows=3)]


def test_a_third_label_fails(spark):
    df = spark.createDataFrame([("Converted",), ("Maybe",)], "s string")
    with pytest.raises(Exception, match="unknown conversion status: Maybe"):
        encode.label_binarize(df, "s").collect()


def test_percent_and_class_names(spark):
    row = spark.range(1).select(percent(F.lit(1), F.lit(4)).alias("a"),
                                percent(F.lit(1), F.lit(0)).alias("b"),
                                class_name(F.lit(1.0), ["x", "y"]).alias("c"),
                                class_name(F.lit(2.0), ["x", "y"]).alias("d")).first()
    assert tuple(row) == (25.0, None, "y", None)


@pytest.fixture()
def cats(spark):
    """Levels with 1, 2 and 50 rows, and null."""
    rows = ([("one", 1.0)] + [("two", 0.0), ("two", 1.0)] + [("fifty", float(i % 5 == 0)) for i in range(50)]
            + [(None, 1.0)] * 3)
    return spark.createDataFrame(rows, "Lead_Source string, y double")


def shrunk(values, prior, k=20.0, f=10.0):
    n, mean = len(values), sum(values) / len(values)
    return prior + (mean - prior) / (1 + math.exp(-(n - k) / f))


def test_target_means_by_hand(spark, cats):
    rows = cats.collect()
    prior = sum(r.y for r in rows) / len(rows)
    encoding = encode.fit_target_encoding(cats, ["Lead_Source"], "y")
    probe = spark.createDataFrame([("one",), ("two",), ("fifty",), (None,), ("new",)],
                                  "Lead_Source string").withColumn("id", F.monotonically_increasing_id())
    got = encoding.transform(probe).orderBy("id").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.Lead_Source, []).append(r.y)
    want = [shrunk(groups[k], prior) for k in ("one", "two", "fifty", None)] + [prior]
    assert [r.Lead_Source for r in got] == pytest.approx(want)
    for k, r in zip(("one", "two", "fifty", None), got):
        mean = sum(groups[k]) / len(groups[k])
        assert min(prior, mean) <= r.Lead_Source <= max(prior, mean)


def test_a_null_category_is_not_an_empty_text(spark):
    df = spark.createDataFrame([(None, 1.0)] * 40 + [("", 0.0)] * 40, "c string, y double")
    encoding = encode.fit_target_encoding(df, ["c"], "y")
    got = encoding.transform(spark.createDataFrame([(None,), ("",)], "c string")).collect()
    assert got[0].c > 0.5 > got[1].c


def test_target_means_save_load_and_parameters(spark, cats, tmp_path):
    encoding = encode.fit_target_encoding(cats, ["Lead_Source"], "y", k=1, f=1)
    encoding.save(str(tmp_path / "enc"))
    again = encode.TargetEncoding.load(spark, str(tmp_path / "enc"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(again.transform(cats)) == key(encoding.transform(cats))
    other = encode.fit_target_encoding(cats, ["Lead_Source"], "y")
    assert key(other.transform(cats)) != key(encoding.transform(cats))


def test_names_with_blanks_are_found(spark, cats):
    out = encode.fit_target_encoding(cats, ["Lead_Source "], "y").transform(cats)
    assert dict(out.dtypes)["Lead_Source"] == "double"


def test_all_ten_categories_of_the_funnel(spark):
    names = ["Lead_Source ", *CATEGORIES[1:]]
    df = spark.range(60).select(
        *[(F.col("id") % (i + 2)).cast("string").alias(c) for i, c in enumerate(names)],
        (F.col("id") % 2).cast("double").alias("y"))
    out = encode.fit_target_encoding(df, CATEGORIES, "y").transform(df)
    assert out.columns == df.columns and out.count() == 60
    assert {t for _, t in out.dtypes} == {"double"}


def test_encoding_keeps_rows_columns_and_their_order(spark, cats):
    wide = cats.withColumn("City", F.lit("x")).withColumn("n", F.lit(1))
    out = encode.fit_target_encoding(wide, ["City", "Lead_Source"], "y").transform(wide)
    assert out.columns == wide.columns and out.count() == wide.count()
    assert dict(out.dtypes)["Lead_Source"] == dict(out.dtypes)["City"] == "double"


def test_formula_levels_by_frequency_and_nulls_skip(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 0.0), ("b", 1.0), ("b", 1.0), ("b", 0.0), ("c", 1.0)], "c string, y double")
    model = encode.formula_encoder("y").fit(df)
    slots = {r.c: list(r.v) for r in model.transform(df).select(
        "c", vector_to_array("enc_features").alias("v")).distinct().collect()}
    assert slots == {"b": [1.0, 0.0], "a": [0.0, 1.0], "c": [0.0, 0.0]}
    assert encode.vector_names(model.transform(df), "enc_features") == ["c_b", "c_a"]
    fresh = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert model.transform(fresh).count() == 1
    kept = encode.formula_encoder("y", handle_invalid="keep").fit(df)
    assert kept.transform(fresh).count() == 3


def test_scaling_divides_by_the_sample_deviation(spark):
    df = encode.assembler(["x"], "v").transform(spark.createDataFrame([(1.0,), (3.0,), (8.0,)], "x double"))
    out = encode.scaler("v", "s").fit(df).transform(df).select(vector_to_array("s")[0].alias("s"))
    sd = math.sqrt(sum((x - 4) ** 2 for x in (1, 3, 8)) / 2)
    assert [r.s for r in out.collect()] == pytest.approx([1 / sd, 3 / sd, 8 / sd])


def test_string_index_ties_by_name_and_unseen_kept(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "c string")
    model = encode.string_indexer(["c"]).fit(df)
    probe = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "c string")
    assert [r.c_si for r in model.transform(probe).collect()] == [1.0, 2.0, 0.0, 3.0, 3.0]


def test_wide_columns_are_not_indexed(spark):
    df = spark.range(1000).selectExpr("cast(id AS string) AS c")
    with pytest.raises(ValueError, match="more than 100 categories in c"):
        encode.check_categories(df, ["c"], limit=100)
    encode.check_categories(df, ["c"])


def test_split_is_complete_disjoint_and_stable(spark):
    df = spark.range(3000).selectExpr("id", "id % 700 AS customer")
    parts = split(df, ["customer"])
    ids = [{r.id for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 3000 and set().union(*ids) == set(range(3000))
    moved = split(df.repartition(7).orderBy(F.desc("id")), ["customer"])
    assert [{r.id for r in p.collect()} for p in moved] == ids
    owners = [{i % 700 for i in part} for part in ids]
    assert not (owners[0] & owners[1] or owners[1] & owners[2] or owners[0] & owners[2])
    shares = [len(o) / 700 for o in owners]
    assert shares == pytest.approx([0.6, 0.2, 0.2], abs=0.07)
    reseeded = split(df, ["customer"], seed="other")
    assert {r.id for r in reseeded[0].collect()} != ids[0]


def test_split_without_key_keeps_copies_together(spark):
    df = spark.createDataFrame([(i % 40, None) for i in range(400)], "a int, b string")
    parts = [{r.a for r in p.collect()} for p in split(df)]
    assert sum(p.count() for p in split(df)) == 400
    assert sum(map(len, parts)) == 40


def test_random_split_is_complete(spark):
    assert sum(p.count() for p in random_split(spark.range(500).toDF("k"), seed=1)) == 500
