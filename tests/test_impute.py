import random
import statistics

import pytest
from pyspark.sql import functions as F

from sluice.operators import encode, evaluate, impute, models
from sluice.operators.split import split


@pytest.fixture(scope="module")
def gappy(spark):
    """x decides the label; it is missing for one lead in five, and those mostly convert."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        x, gap = rng.gauss(0, 1), rng.random() < 0.2
        yes = rng.random() < 0.9 if gap else x > 0.3
        rows.append((i, None if gap else x, rng.choice([1, 2, None]), rng.choice([0.5, float("nan")]), rng.random(),
                     rng.choice("ab"), "Converted" if yes else "Not Converted"))
    df = spark.createDataFrame(rows, "Lead_ID long, x double, n int, `odd.rate` double, whole double, "
                                     "kind string, Conversion_Status string")
    return encode.label_binarize(df, "Conversion_Status").persist()


SKIP = ("Lead_ID", "Conversion_Status")


def test_medians_are_of_the_training_rows(gappy):
    columns = impute.columns_with_gaps(gappy)
    assert columns == ["x", "n", "odd.rate"]
    fitted = impute.fit_imputation(gappy, columns)
    x = sorted(r.x for r in gappy.collect() if r.x is not None)
    assert fitted.medians["x"] == statistics.median_low(x)
    assert fitted.medians["odd.rate"] == 0.5
    rows = fitted.transform(gappy).collect()
    assert all(r["x_missing"] in (0.0, 1.0) and r["odd.rate"] == 0.5 for r in rows)
    given = {r.Lead_ID: r for r in gappy.collect()}
    assert all(r["x"] == (fitted.medians["x"] if given[r.Lead_ID].x is None else given[r.Lead_ID].x) for r in rows)
    assert fitted.transform(gappy).columns == [*gappy.columns, "x_missing", "n_missing", "odd.rate_missing"]


def test_odd_columns(spark):
    df = spark.createDataFrame([(None, 1)], "x double, y int")
    assert impute.fit_imputation(df, ["x"]).transform(df).first().x == 0.0
    assert impute.fit_imputation(df, []).transform(df).columns == ["x", "y"]
    assert impute.columns_with_gaps(df.where("false")) == []
    with pytest.raises(ValueError, match="x_missing"):
        impute.fit_imputation(df.withColumn("x_missing", F.lit(1)), ["x"])


BUILD = {
    "logistic": lambda df: models.logistic(df, "label", SKIP),
    "logistic_encoded": lambda df: models.logistic(df, "label", SKIP, target_means=["kind"]),
    "forest": lambda df: models.forest(df, exclude=SKIP, trees=8),
    "boosted": lambda df: models.boosted(df, exclude=SKIP, rounds=3),
    "indexed_boosted": lambda df: models.indexed_boosted(df, exclude=SKIP, rounds=3),
}


@pytest.mark.parametrize("kind", BUILD)
def test_every_kind_trains_with_gaps(gappy, kind, tmp_path, spark):
    train, _, test = split(gappy, ["Lead_ID"])
    df = train.withColumnRenamed("odd.rate", "odd_rate")
    recipe = BUILD[kind](df)
    model = models.fit(recipe, df)
    test = test.withColumnRenamed("odd.rate", "odd_rate")
    scored = model.score(test)
    assert evaluate.scorecard(scored, recipe.classifier_label).first().weighted_f1 > 0.8
    covered = evaluate.coverage(test, scored).first()
    assert covered.given == covered.scored == test.count() and covered.skipped == 0
    model.save(str(tmp_path / "m"))
    again = models.FunnelModel.load(spark, str(tmp_path / "m"))
    key = lambda d: sorted((r.Lead_ID, r.prediction) for r in d.collect())
    assert key(again.score(test)) == key(scored)


def test_gaps_that_training_never_saw_are_counted(gappy):
    """A number that is always there in training has no median; a lead without it is not scored."""
    df = gappy.select("Lead_ID", "whole", "kind", "label")
    recipe = models.forest(df, exclude=("Lead_ID",), trees=2)
    assert recipe.gaps == ()
    model = models.fit(recipe, df)
    holes = df.withColumn("whole", F.when(F.col("Lead_ID") % 3 > 0, F.col("whole")))
    covered = evaluate.coverage(holes, model.score(holes)).first()
    assert tuple(covered) == (1500, 1000, 500)
    by = evaluate.coverage(holes, holes.where("whole IS NOT NULL"), "kind").collect()
    assert sum(r.skipped for r in by) == 500 and sum(r.given for r in by) == 1500
