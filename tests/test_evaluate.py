import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.operators import evaluate


def preds(spark, pairs):
    return spark.createDataFrame(pairs, "label double, prediction double")


CASES = {
    "perfect": [(0.0, 0.0), (1.0, 1.0)],
    "one class predicted": [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)],
    "class never true": [(0.0, 0.0), (0.0, 1.0)],
    "all wrong": [(0.0, 1.0), (1.0, 0.0)],
    "three classes": [(0.0, 0.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (2.0, 2.0)],
}


@pytest.mark.parametrize("case", CASES)
def test_f1_equals_the_built_in_evaluator(spark, case):
    df = preds(spark, CASES[case])
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    row = evaluate.weighted_f1(df, "label").first()
    assert row.rows == len(CASES[case]) and row.weighted_f1 == pytest.approx(want)


def test_f1_of_nothing_is_null(spark):
    assert evaluate.weighted_f1(preds(spark, []), "label").collect() == [
        Row(rows=0, weighted_f1=None)]


def test_sweep_equals_one_evaluation_per_cut(spark):
    rng = random.Random(5)
    rows = [(float(rng.random() < 0.3), rng.choice([0.1, 0.25, 0.5, 0.5, 0.9])) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, score double")
    cuts = [0.9, 0.05, 0.5, 0.25, 0.5]
    got = {r.threshold: r.weighted_f1
           for r in evaluate.threshold_sweep(df, "label", "score", cuts).collect()}
    assert set(got) == set(cuts)
    for t in got:
        one = df.withColumn("prediction", F.when(F.col("score") > t, 1.0).otherwise(0.0))
        assert got[t] == pytest.approx(evaluate.weighted_f1(one, "label").first().weighted_f1)
    best = evaluate.best_threshold(evaluate.threshold_sweep(df, "label", "score", cuts)).first()
    assert best.weighted_f1 == max(got.values())


def statuses(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "predicted string")


def test_effectiveness_by_label_text(spark):
    def value(*texts):
        return tuple(evaluate.funnel_effectiveness(statuses(spark, *texts), "predicted").first())

    assert value("Converted", "Not Converted", "Not Converted", "Converted") == (4, 2, 50.0)
    assert value("Converted") == (1, 1, 100.0)
    assert value("Not Converted", "Not Converted") == (2, 0, 0.0)
    assert value() == (0, 0, None)


def test_group_count(spark):
    rows = evaluate.group_count(statuses(spark, "a", "b", "a"), "predicted").collect()
    assert {tuple(r) for r in rows} == {("a", 2), ("b", 1)}


def test_scorecard_agrees_with_its_parts(spark):
    rng = random.Random(9)
    df = preds(spark, [(float(rng.random() < 0.4), float(rng.random() < 0.5)) for _ in range(200)])
    df = df.withColumn("predicted_status", F.when(F.col("prediction") == 0.0, "Converted")
                       .otherwise("Not Converted"))
    card = evaluate.scorecard(df, "label").first()
    f1 = evaluate.weighted_f1(df, "label").first()
    rate = evaluate.funnel_effectiveness(df, "predicted_status").first()
    assert (card.rows, card.weighted_f1) == (f1.rows, pytest.approx(f1.weighted_f1))
    assert card.predicted_converted == rate.predicted_converted
    assert card.effectiveness == pytest.approx(rate.effectiveness)
    assert evaluate.scorecard(df.limit(0), "label").first().effectiveness is None
