import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import encode, models, tune
from sluice.operators.evaluate import scorecard
from sluice.operators.split import split
from sluice.plans import jobs
from sluice.streaming import lead_stream, score_stream


@pytest.fixture(scope="module")
def planted(spark):
    """The label is a noisy function of x; the rest says nothing."""
    rng = random.Random(11)
    rows = []
    for i in range(1200):
        x = rng.gauss(0, 1)
        yes = x + rng.gauss(0, 0.3) > 0.4
        rows.append((i, x, rng.random(), rng.choice("abc"), "Converted" if yes else "Not Converted"))
    return spark.createDataFrame(
        rows, "Lead_ID long, x double, noise double, `Product/Service_Interest` string, "
              "Conversion_Status string").persist()


SKIP = ("Lead_ID", "Conversion_Status")


def recipes(df):
    labelled = encode.label_binarize(df, "Conversion_Status")
    return labelled, {
        "logistic": models.logistic(labelled, "label", SKIP),
        "logistic_encoded": models.logistic(labelled, "label", SKIP,
                                            target_means=["Product/Service_Interest"]),
        "forest": models.forest(labelled, exclude=SKIP, trees=8),
        "boosted": models.boosted(labelled, exclude=SKIP, rounds=3),
        "indexed_boosted": models.indexed_boosted(labelled, exclude=SKIP, rounds=3),
    }


@pytest.mark.parametrize("kind", ["logistic", "logistic_encoded", "forest", "boosted",
                                  "indexed_boosted"])
def test_signal_is_found(planted, kind):
    df, built = recipes(planted)
    recipe = built[kind]
    assert "Conversion_Status" not in recipe.predictors and "label" not in recipe.predictors
    train, _, test = split(df, ["Lead_ID"])
    model = models.fit(recipe, train)
    card = scorecard(model.score(test), recipe.classifier_label).first()
    majority = scorecard(model.score(test).withColumn("prediction", F.lit(1.0)),
                         recipe.classifier_label).first()
    assert card.weighted_f1 > 0.8 > majority.weighted_f1
    assert 20 < card.effectiveness < 60
    names = encode.vector_names(model.features.transform(test), recipe.features)
    assert not any("label" in n or "Status" in n for n in names)
    if kind != "logistic" and hasattr(model.classifier, "featureImportances"):
        ranked = models.feature_importance(model, recipe, test).collect()
        assert ranked[0].feature == "x"
        assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)


@pytest.mark.parametrize("flip", [False, True])
def test_effectiveness_does_not_depend_on_the_majority(planted, flip):
    """An indexed text label numbers its classes by frequency; the report must not care."""
    df = planted
    if flip:
        df = df.withColumn("Conversion_Status", F.when(
            F.col("Conversion_Status") == "Converted", "Not Converted").otherwise("Converted"))
    recipe = models.logistic(df, "Conversion_Status", ("Lead_ID",))
    train, _, test = split(df, ["Lead_ID"])
    model = models.fit(recipe, train)
    majority = "Converted" if flip else "Not Converted"
    assert model.classes[0] == majority
    scored = model.score(test)
    truth = 100 * scored.where("Conversion_Status = 'Converted'").count() / scored.count()
    card = scorecard(scored, recipe.classifier_label).first()
    assert card.effectiveness == pytest.approx(truth, abs=6)


def test_saved_models_score_alike_and_unlabelled(planted, tmp_path, spark):
    df, built = recipes(planted)
    train, _, test = split(df, ["Lead_ID"])
    model = models.fit(built["forest"], train)
    model.save(str(tmp_path / "m"))
    model.save(str(tmp_path / "m"))  # saving again replaces
    loaded = models.FunnelModel.load(spark, str(tmp_path / "m"))
    assert (loaded.classes, loaded.name) == (model.classes, "forest")
    bare = test.drop("label", "Conversion_Status")
    rows = [sorted((r.Lead_ID, r.prediction, r.predicted_status) for r in m.score(d).collect())
            for m, d in ((model, test), (loaded, bare))]
    assert rows[0] == rows[1]


def test_search_with_shared_fits_equals_single_fits(planted):
    df, built = recipes(planted)
    train, validation, _ = split(df, ["Lead_ID"])
    trials = [{"maxIter": 5, "threshold": 0.3}, {"maxIter": 5, "threshold": 0.6},
              {"maxIter": 20, "threshold": 0.3}]
    found = tune.param_search(built["logistic"], train, validation, trials)
    for i, params, f1 in found.trials:
        model = tune.retrain(built["logistic"], params, train)
        one = scorecard(model.score(validation), "label_enc").first().weighted_f1
        assert f1 == pytest.approx(one), params
    assert found.best == max(found.trials, key=lambda t: (t[2], -t[0]))[1]
    assert found.frame(planted.sparkSession).count() == 3


def test_search_over_trees(planted):
    df, built = recipes(planted)
    train, validation, _ = split(df, ["Lead_ID"])
    found = tune.param_search(built["forest"], train, validation,
                              [{"maxDepth": 1, "numTrees": 1}, {"maxDepth": 4.0, "numTrees": 6}])
    assert [t[0] for t in found.trials] == [0, 1] and all(0 <= t[2] <= 1 for t in found.trials)
    with pytest.raises(ValueError, match="cut-off"):
        tune.param_search(built["logistic"], train, validation,
                          [{"maxIter": 5}, {"maxIter": 5, "threshold": 0.5}])


def test_drawn_trials():
    grid = tune.draw_trials(tune.BOOSTED_SPACE)
    assert len(grid) == 9 and len({tuple(t.items()) for t in grid}) == 9
    for space, n in ((tune.LOGISTIC_SPACE, 10), (tune.LOGISTIC_WIDE_SPACE, 32), (tune.FOREST_SPACE, 9)):
        drawn = tune.draw_trials(space)
        assert len(drawn) == n and drawn == tune.draw_trials(space)
        assert drawn != tune.draw_trials(space, seed=1)
    assert all(0.4 <= t["threshold"] <= 0.9 and t["maxIter"] in (100, 150, 200, 250, 300)
               for t in tune.draw_trials(tune.LOGISTIC_SPACE))
    depths = {t["maxDepth"] for t in tune.draw_trials(tune.FOREST_SPACE, 200)}
    assert depths == {6, 9, 12, 15}
    trees = {t["numTrees"] for t in tune.draw_trials(tune.FOREST_SPACE, 200)}
    assert all(100 <= n <= 500 and n % 10 == 0 for n in trees)


def test_a_stream_is_scored_file_by_file(planted, spark, tmp_path):
    df, built = recipes(planted)
    model = models.fit(built["forest"], df)
    leads = df.drop("label", "Conversion_Status")
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in (0, 1):
        leads.where(F.col("Lead_ID") % 2 == part).write.mode("append").parquet(inbox)
        stream = lead_stream(spark, inbox, leads.schema, files_per_batch=1)
        score_stream(model, stream, out, checkpoint, ["Lead_ID"]).awaitTermination()
        assert spark.read.parquet(out).count() == leads.where(F.col("Lead_ID") % 2 <= part).count()
    key = lambda d: sorted((r.Lead_ID, r.prediction, r.predicted_status) for r in d.collect())
    assert key(spark.read.parquet(out)) == key(model.score(leads))


def test_jobs_from_csv_to_report(spark, planted, tmp_path):
    crm = planted.select(F.col("Lead_ID").alias("Customer_ID"), "x", "Conversion_Status")
    external = planted.select(F.col("Lead_ID").alias("Customer_ID"),
                              F.col("Product/Service_Interest").alias("Location"))
    marketing, sales = tmp_path / "m.csv", tmp_path / "s.csv"
    ids = range(1200)
    marketing.write_text("Customer_ID,Device_Type,Email_Open_Rate(%)," + "a,b,c,d,e,f,\n"
                         + "".join(f"{i},phone,{i % 7}.5,1,1,1,1,1,1,\n" for i in [*ids, 3, 3]))
    sales.write_text('Customer_ID,Order_ID,Interest_Rates_(%),Note\n'
                     + "".join(f'{i},o{i},2.5,"said ""ok""\nthen left"\n' for i in ids))
    crm.write.mode("overwrite").saveAsTable("crm_in")
    external.write.mode("overwrite").saveAsTable("external_in")
    loaded = jobs.load_marketing(spark, str(marketing), "marketing_in")
    assert loaded.columns == ["Customer_ID", "Email_open_rate", *"abcdef"]
    assert loaded.count() == 1200
    assert jobs.load_sales(spark, str(sales), "sales_in").count() == 1200
    funnel = jobs.build_funnel(spark, "crm_in", "external_in", "marketing_in", "sales_in",
                               "lead_funnel", "final_data")
    assert funnel.count() == 1200
    audit = jobs.Audit.of(funnel)
    assert audit.shape.first().rows == 1200 and audit.duplicates.first().duplicate_rows == 0
    assert audit.profile.count() == len(funnel.columns)
    run = jobs.train_funnel_model(
        spark, funnel, "forest", str(tmp_path / "model"), "lead_funnel.model_runs",
        trials=[{"maxDepth": 2, "numTrees": 3}, {"maxDepth": 4, "numTrees": 5}])
    card = run.scores.first()
    assert card.weighted_f1 > 0.8 and 0 <= card.effectiveness <= 100
    assert spark.table("lead_funnel.model_runs").count() == 3
    again = models.FunnelModel.load(spark, str(tmp_path / "model")).score(funnel)
    assert again.count() == 1200 and "predicted_status" in again.columns
    assert run.unlabelled.first().unlabelled_rows == 0
    leaky = jobs.train_funnel_model(spark, funnel, "boosted", means_from_all=True,
                                    trials=[{"maxDepth": 2, "maxIter": 2, "stepSize": 0.3}])
    assert leaky.scores.first().rows == card.rows and leaky.trials.count() == 1
