import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sluice.operators import encode, forest_tables, models, optimum


@pytest.fixture(scope="module")
def leads(spark):
    rng = random.Random(8)
    rows = []
    for i in range(900):
        x, kind = rng.gauss(0, 1), rng.choice("abcd")
        rows.append((i, x, 100 * rng.random(), kind, 1.0 if x + "abcd".index(kind) * 0.4 + rng.gauss(0, 1) > 0.5 else 0.0))
    return spark.createDataFrame(rows, "id long, x double, wide double, kind string, label double").persist()


@pytest.fixture(scope="module")
def logistic(leads):
    recipe = models.logistic(leads, "label", ("id",))
    return recipe, models.fit(recipe, leads)


def test_gradient_is_that_of_the_loss(leads, logistic):
    recipe, model = logistic
    scored = model.score(leads)
    got = {r.feature: r.gradient for r in optimum.log_loss_gradient(scored, recipe.features, recipe.classifier_label).collect()}
    rows = scored.select(vector_to_array(recipe.features).alias("v"), recipe.classifier_label,
                         vector_to_array("probability")[1].alias("p")).collect()
    names = encode.vector_names(scored, recipe.features)
    for j, name in enumerate(names):
        assert got[name] == pytest.approx(sum((r.p - r[1]) * r.v[j] for r in rows) / len(rows), abs=1e-7)
    assert got["(intercept)"] == pytest.approx(sum(r.p - r[1] for r in rows) / len(rows), abs=1e-7)


def test_only_the_optimum_is_certified(leads, logistic):
    recipe, model = logistic
    assert optimum.certificate(model, recipe, leads).first().optimal
    early = recipe.with_classifier(maxIter=1)
    stopped = optimum.certificate(models.fit(early, leads), early, leads).first()
    assert not stopped.optimal and stopped.largest_gradient > 1e-3
    assert not optimum.certificate(model, recipe, leads.where("false")).first().optimal


def test_every_level_gets_its_share(leads, logistic):
    recipe, model = logistic
    means = optimum.level_means(model.score(leads), ["kind"], recipe.classifier_label).collect()
    assert len(means) == 4  # the base level, which has no slot, as well
    assert all(r.label_mean == pytest.approx(r.probability_mean, abs=1e-4) for r in means)


@pytest.mark.parametrize("kind", ["forest", "boosted", "indexed"])
def test_nodes_score_like_the_model(spark, leads, kind):
    build = {"forest": lambda: models.forest(leads, exclude=("id",), trees=5, depth=4),
             "boosted": lambda: models.boosted(leads, exclude=("id",), rounds=3, depth=3),
             "indexed": lambda: models.indexed_boosted(leads, exclude=("id",), rounds=3, depth=3)}
    recipe = build[kind]()
    model = models.fit(recipe, leads)
    scored = model.score(leads).select("id", recipe.features, vector_to_array("probability")[1].alias("own"), "prediction")
    nodes = forest_tables.tree_nodes(model.classifier, spark)
    leaves = forest_tables.descend(scored, nodes, "id", recipe.features)
    trees = model.classifier.getNumTrees
    assert leaves.count() == 900 * trees
    if kind == "forest":
        found = forest_tables.forest_probability(leaves)
    else:  # a boosted margin is the weighted sum of its trees, and twice that in the logistic curve
        weights = spark.createDataFrame(list(enumerate(map(float, model.classifier.treeWeights))), "tree int, w double")
        found = leaves.join(weights, "tree").groupBy("key").agg(F.sum(F.col("w") * F.col("prediction")).alias("m")).select(
            "key", (1 / (1 + F.exp(-2 * F.col("m")))).alias("probability"))
        assert nodes.where("categories IS NOT NULL").isEmpty() == (kind == "boosted")
    off = scored.join(found, F.col("id") == F.col("key")).where(F.abs(F.col("own") - F.col("probability")) > 1e-9)
    assert off.isEmpty()
    if kind == "forest":
        names = encode.vector_names(model.features.transform(leads), recipe.features)
        own = {r.feature: r.importance for r in models.feature_importance(model, recipe, leads).collect()}
        got = {r.feature: r.importance for r in forest_tables.importance_by_gain(nodes, names).collect()}
        assert got == pytest.approx(own, abs=1e-12)
