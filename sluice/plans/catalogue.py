"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import CONVERTED, NOT_CONVERTED, class_name
from sluice.operators import (
    boosting, clean, encode, evaluate, forest_tables, impute, index, joins, models, optimum, profile, tune,
)
from sluice.operators.split import split, split_name
from sluice.plans import funnel, standins
from sluice.sources import files, records, tables
from sluice.sources.scratch import fresh_path, materialise
from sluice.streaming import (
    deliver, first_deliveries, lead_stream, publish_model, score_newest, score_stream, scored_leads,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THRESHOLDS = (0.1, 0.3, 0.5, 0.7, 0.9)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; results do not."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def _database(spark: SparkSession) -> str:
    """A database of this application's own, in the shared folder."""
    name = "funnel_" + spark.sparkContext.applicationId.replace("-", "_").replace(".", "_").lower()
    if not spark.catalog.databaseExists(name):
        tables.create_database(spark, name, fresh_path(spark, "database"))
    return name


def _splits(leads: DataFrame) -> list[DataFrame]:
    return split(leads, ["Customer_ID"])


def _rule_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Leads with a 0/1 label and the fixed rule's score, prediction and text."""
    score = standins.rule_score()
    return (encode.label_binarize(standins.leads(spark, folder), "Conversion_Status")
            .withColumn("score", score)
            .withColumn("prediction", F.when(score > 0.5, 1.0).otherwise(0.0))
            .withColumn("predicted_status",
                        class_name(F.col("prediction"), (CONVERTED, NOT_CONVERTED))))


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return encode.label_binarize(standins.leads(spark, folder), "Conversion_Status")


def _slots(vector: str, n: int, prefix: str = "x") -> list[Column]:
    values = vector_to_array(vector)
    return [values[i].alias(f"{prefix}{i}") for i in range(n)]


def _doubled(spark: SparkSession, folder: str) -> DataFrame:
    """Every row twice, all columns: rows that are copies as a whole."""
    rows = tables.read_parquet(spark, folder, "lineitem")
    return rows.unionByName(rows)


# -- sources, sinks, catalog --------------------------------------------------

@query
def csv_scan_infer(spark, folder):
    source = tables.read_parquet(spark, folder, "orders")
    path = fresh_path(spark, "csv")
    files.write_csv(source, path)
    found = files.read_csv(spark, path)
    return found.select(*[F.col(f.name).cast(f.dataType) for f in source.schema.fields])


@query
def csv_scan_multiline(spark, folder):
    source = tables.read_parquet(spark, folder, "documents")
    path = fresh_path(spark, "csv")
    files.write_csv(source, path)
    return files.read_csv_multiline(spark, path, source.schema)


@query
def csv_scan_split(spark, folder):
    """The same texts with their line breaks, each file read by many tasks."""
    source = tables.read_parquet(spark, folder, "documents")
    path = fresh_path(spark, "csv")
    files.write_csv(source, path)
    return records.read_csv_split(spark, path, source.schema)


@query
def table_scan(spark, folder):
    tables.read_parquet(spark, folder, "lineitem").createOrReplaceTempView("sluice_lineitem")
    return tables.read_table(spark, "sluice_lineitem")


@query
def save_overwrite_roundtrip(spark, folder):
    name = f"{_database(spark)}.customers"
    tables.save_table(tables.read_parquet(spark, folder, "supplier"), name)
    return tables.save_table(tables.read_parquet(spark, folder, "customer"), name)


@query
def database_ddl(spark, folder):
    name = _database(spark)
    tables.create_database(spark, name)  # a second time does no harm
    before = spark.catalog.currentDatabase()
    try:
        tables.create_database(spark, name, use=True)
        tables.save_table(standins.sales(spark, folder), "sales")
    finally:
        spark.catalog.setCurrentDatabase(before)
    return evaluate.group_count(tables.read_table(spark, f"{name}.sales"), "Lead_Source")


@query
def run_log_append(spark, folder):
    name = f"{_database(spark)}.model_runs"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    scored = _rule_scored(spark, folder)
    for run, part in zip(("rule_validation", "rule_test"), _splits(scored)[1:]):
        sweep = evaluate.threshold_sweep(part, "label", "score", THRESHOLDS)
        runs = sweep.select(
            F.lit(run).alias("run_name"),
            F.array_position(F.array(*[F.lit(t) for t in THRESHOLDS]), F.col("threshold"))
            .alias("trial_id"),
            F.create_map(F.lit("threshold"), F.col("threshold").cast("string")).alias("params"),
            F.lit("weighted_f1").alias("metric"), F.col("weighted_f1").alias("value"))
        tables.append_runs(runs, name)
    return _rounded(spark.table(name).select(
        "run_name", "trial_id", F.col("params")["threshold"].cast("double").alias("threshold"),
        "metric", "value"))


@query
def preview_rows(spark, folder):
    return tables.preview(tables.read_parquet(spark, folder, "orders"), 20,
                          F.desc("o_totalprice"), "o_orderkey")


# -- projections, filters -----------------------------------------------------

@query
def drop_columns(spark, folder):
    return clean.drop_columns(standins.sales(spark, folder), funnel.SALES_DROPS)


@query
def drop_columns_lenient(spark, folder):
    kept, absent = funnel.model_table(standins.leads(spark, folder))
    return kept.withColumn("absent", F.lit(len(absent)))


@query
def select_distinct(spark, folder):
    return profile.distinct_values(tables.read_parquet(spark, folder, "lineitem"), "l_shipdate")


@query
def rename_columns(spark, folder):
    return _rounded(funnel.clean_marketing(standins.marketing(spark, folder)))


@query
def typed_columns(spark, folder):
    return clean.typed_columns(standins.lead_details(spark, folder, standins.sales(spark, folder)),
                               "Conversion_Status")


@query
def null_row_filter(spark, folder):
    """Leads of touched customers whose start day also occurs among training leads."""
    sales = standins.sales(spark, folder).withColumn(
        "Start_Day", F.date_format("Start_Date", "yyyy-MM-dd"))
    touched = joins.attach_lookup(sales, standins.marketing(spark, folder), "Customer_ID")
    complete = clean.drop_incomplete(touched, ["Touches", "Start_Day"])
    train, _, test = _splits(complete)
    return (clean.keep_known(test, train, ["Start_Day"])
            .select("Order_ID", "Customer_ID", "Start_Day", "Touches"))


# -- joins --------------------------------------------------------------------

@query
def funnel_join_pair(spark, folder):
    return joins.join_on_key([standins.crm(spark, folder), standins.external(spark, folder)],
                             "Customer_ID")


def _four_tables(spark, folder):
    return (standins.crm(spark, folder), standins.external(spark, folder),
            funnel.clean_marketing(standins.marketing(spark, folder)),
            funnel.clean_sales(standins.sales(spark, folder)))


@query
def funnel_join_chain(spark, folder):
    return _rounded(funnel.funnel_table(*_four_tables(spark, folder)))


@query
def funnel_join_heavy_keys(spark, folder):
    """The chain with every customer of more than ten rows in the result spread out."""
    return _rounded(joins.join_on_key(_four_tables(spark, folder), "Customer_ID", per_task=10))


def _touches(spark, folder):
    """Single marketing touches, as they come in."""
    return tables.read_parquet(spark, folder, "events").select(
        F.col("user_id").alias("Customer_ID"), F.col("event_type").alias("Touch"))


@query
def funnel_join_touches(spark, folder):
    """Customers, where they live, every touch and every sale: a row per combination."""
    return joins.join_on_key([standins.crm(spark, folder), standins.external(spark, folder),
                              _touches(spark, folder), standins.sales(spark, folder)], "Customer_ID")


@query
def funnel_join_touches_spread(spark, folder):
    """The same with customers spread over grids of some 100 rows a cell."""
    return joins.join_on_key([standins.crm(spark, folder), standins.external(spark, folder),
                              _touches(spark, folder), standins.sales(spark, folder)], "Customer_ID", per_task=100)


@query
def hot_key_grids(spark, folder):
    """Which customers' touches and sales are more than 100 pairs, and how they are dealt out."""
    hot = joins.hot_keys([_touches(spark, folder), standins.sales(spark, folder)], "Customer_ID", per_task=100)
    if not hot:
        return spark.createDataFrame([], "Customer_ID long, touch_axis long, sale_axis long")
    return hot.grid.select(F.col("_hot").alias("Customer_ID"), F.col("_axes")[0].alias("touch_axis"),
                           F.col("_axes")[1].alias("sale_axis"))


@query
def join_size(spark, folder):
    """What joining customers, single touches and sales would yield, without the join."""
    return joins.join_size([standins.crm(spark, folder), _touches(spark, folder),
                            standins.sales(spark, folder)], "Customer_ID")


# -- aggregations -------------------------------------------------------------

@query
def table_shape(spark, folder):
    return profile.table_shape(tables.read_parquet(spark, folder, "lineitem"))


@query
def drop_duplicates(spark, folder):
    return profile.drop_duplicates(_doubled(spark, folder))


@query
def duplicate_audit(spark, folder):
    return profile.duplicate_audit(_doubled(spark, folder))


@query
def group_count(spark, folder):
    return evaluate.group_count(_rule_scored(spark, folder), "prediction")


@query
def funnel_effectiveness(spark, folder):
    return _rounded(evaluate.funnel_effectiveness(_rule_scored(spark, folder),
                                                  "predicted_status"))


@query
def funnel_effectiveness_by_location(spark, folder):
    return _rounded(evaluate.funnel_effectiveness(_rule_scored(spark, folder),
                                                  "predicted_status", "Location"))


@query
def column_profile(spark, folder):
    return _rounded(profile.column_profile(tables.read_parquet(spark, folder, "lineitem"),
                                           exact=True), 4)


@query
def column_profile_estimated(spark, folder):
    return profile.column_profile(tables.read_parquet(spark, folder, "lineitem"))


# -- features -----------------------------------------------------------------

@query
def label_binarize(spark, folder):
    return _labelled(spark, folder).select("Lead_ID", "Conversion_Status", "label")


@query
def split_three_way(spark, folder):
    leads = standins.leads(spark, folder)
    return leads.select("Lead_ID", "Customer_ID",
                        split_name([F.col("Customer_ID")]).alias("split"))


def _target_encoded(leads: DataFrame, fitted_on: DataFrame) -> DataFrame:
    columns = ["Lead_Source", "Profession", "City", "Location"]
    encoding = encode.fit_target_encoding(fitted_on, columns, "label")
    return _rounded(encoding.transform(leads).select("Lead_ID", *columns))


@query
def target_encode(spark, folder):
    leads = _labelled(spark, folder)
    return _target_encoded(leads, _splits(leads)[0])


@query
def target_encode_all_rows(spark, folder):
    """Means fitted before the split, held-out labels included."""
    leads = _labelled(spark, folder)
    return _target_encoded(leads, leads)


@query
def rformula_encode(spark, folder):
    leads = standins.leads(spark, folder)
    train, validation, _ = _splits(leads)
    names = ["Profession", "Lead_Source", "Account_Balance", "Sale_Amount", "Conversion_Status"]
    with models.kept(train.select(*names)) as frame:
        model = encode.formula_encoder("Conversion_Status").fit(frame)
    return (model.transform(validation)
            .select("Lead_ID", *_slots("enc_features", 10),
                    F.col("Conversion_Status_enc").alias("label")))


@query
def standard_scale(spark, folder):
    columns = ["Account_Balance", "Sale_Amount"]
    train, _, test = [encode.assembler(columns, "numbers").transform(d)
                      for d in _splits(standins.leads(spark, folder))]
    scaled = encode.scaler("numbers", "scaled").fit(train).transform(test)
    return _rounded(scaled.select("Lead_ID", *_slots("scaled", 2)))


@query
def string_index(spark, folder):
    train, _, test = _splits(standins.leads(spark, folder))
    columns = ["City", "Lead_Source"]
    encode.check_categories(train, columns)
    return (encode.string_indexer(columns).fit(train).transform(test)
            .select("Lead_ID", "City", "Lead_Source", "City_si", "Lead_Source_si"))


@query
def wide_index(spark, folder):
    """All texts of the leads and their customers, most of whom training never saw."""
    train, _, test = _splits(standins.leads(spark, folder))
    columns = ["Profession", "City", "Location", "Lead_Source", "Customer_ID"]
    return (index.fit_wide_index(train, columns).transform(test)
            .select("Lead_ID", *[f"{c}_si" for c in columns]))


@query
def wide_index_levels(spark, folder):
    """Every level of four columns of all order lines, with its rows and number."""
    lines = tables.read_parquet(spark, folder, "lineitem")
    return index.fit_wide_index(lines, ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]).named_levels()


@query
def assemble_features(spark, folder):
    leads = _labelled(spark, folder)
    columns = encode.feature_columns(
        leads.select(*clean.numeric_columns(leads)), "label", "Lead_ID", "Customer_ID")
    return (encode.assembler(columns).transform(leads)
            .select("Lead_ID", *_slots("inp_features", 2), "label"))


def _gappy(spark, folder):
    """Leads with what their customers' marketing says, which many customers have none of.

    Sales of whole thousands lose their amount, so that a lead's own number is missing too.
    """
    touched = joins.attach_lookup(_labelled(spark, folder), funnel.clean_marketing(standins.marketing(spark, folder)),
                                  "Customer_ID")
    odd = F.floor(F.col("Sale_Amount")) % 10 == 0
    return touched.withColumn("Sale_Amount", F.when(~odd, F.col("Sale_Amount")))


GAPPY = ("Account_Balance", "Sale_Amount", "Touches", "Email_open_rate", "click_through_rate")


@query
def impute_features(spark, folder):
    """Numbers of all leads, gaps filled with the training leads' medians, and where the gaps were."""
    leads = _gappy(spark, folder)
    train = _splits(leads)[0]
    fitted = impute.fit_imputation(train, impute.columns_with_gaps(train, GAPPY))
    return _rounded(fitted.transform(leads.select("Lead_ID", *GAPPY)))


@query
def gappy_train_coverage(spark, folder):
    """Every kind of model trained and scored on leads with missing numbers: all leads get a score."""
    leads = _gappy(spark, folder)
    train = materialise(_splits(leads)[0], "train")
    held_out = _held_out(leads)
    built = {
        "logistic": models.logistic(train, "label", NOT_FEATURES),
        "logistic_encoded": models.logistic(train, "label", NOT_FEATURES, target_means=["Location", "Profession"]),
        "forest": models.forest(train, exclude=NOT_FEATURES),
        "boosted": models.boosted(train, exclude=NOT_FEATURES, rounds=5),
        "indexed_boosted": models.indexed_boosted(train, exclude=NOT_FEATURES, rounds=5),
    }
    out = [evaluate.coverage(held_out, models.fit(recipe, train).score(held_out), "split")
           .select(F.lit(kind).alias("kind"), "split", "given", "scored", "skipped") for kind, recipe in built.items()]
    return reduce(DataFrame.unionByName, out)


# -- evaluation ---------------------------------------------------------------

@query
def weighted_f1(spark, folder):
    return _rounded(evaluate.weighted_f1(_rule_scored(spark, folder), "label"))


@query
def threshold_sweep(spark, folder):
    return _rounded(evaluate.threshold_sweep(_rule_scored(spark, folder), "label", "score",
                                             THRESHOLDS))


# -- models -------------------------------------------------------------------

IDS = ("Lead_ID", "Customer_ID")
NOT_FEATURES = (*IDS, "Conversion_Status")


def _held_out(leads: DataFrame) -> DataFrame:
    """Validation and test leads, named in a column, to be scored in one go."""
    named = leads.withColumn("split", split_name([F.col("Customer_ID")]))
    return named.where("split <> 'train'")


def _train_and_score(leads: DataFrame, recipe: models.Recipe) -> DataFrame:
    """F1 and effectiveness on validation and test."""
    model = models.fit(recipe, _splits(leads)[0])
    return _rounded(evaluate.scorecard(model.score(_held_out(leads)),
                                       recipe.classifier_label, "split"))


@query
def lr_train_score(spark, folder):
    leads = standins.leads(spark, folder)
    return _train_and_score(leads, models.logistic(leads, "Conversion_Status", IDS))


@query
def encoded_lr_train_score(spark, folder):
    leads = _labelled(spark, folder)
    return _train_and_score(leads, models.logistic(
        leads, "label", NOT_FEATURES, target_means=["Location", "Profession"]))


@query
def rf_train_score(spark, folder):
    leads = _labelled(spark, folder)
    return _train_and_score(leads, models.forest(leads, exclude=NOT_FEATURES))


@query
def gbt_train_score(spark, folder):
    leads = _labelled(spark, folder)
    return _train_and_score(leads, models.boosted(leads, exclude=NOT_FEATURES))


@query
def indexed_gbt_train_score(spark, folder):
    leads = _labelled(spark, folder)
    return _train_and_score(leads, models.indexed_boosted(leads, exclude=NOT_FEATURES))


@query
def penalised_train_score(spark, folder):
    leads = _labelled(spark, folder)
    return _train_and_score(leads, models.penalised(leads, exclude=NOT_FEATURES, rounds=10, alpha=0.1))


@query
def penalised_stump_scores(spark, folder):
    """Every sale's probability from one tree of one split with an L1 penalty of five."""
    sales = encode.label_binarize(standins.sales(spark, folder), "Conversion_Status")
    rows = encode.assembler(["urgency", "month"]).transform(sales.select(
        "Order_ID", "label", F.substring("Lead_Source", 1, 1).cast("double").alias("urgency"),
        F.month("Start_Date").cast("double").alias("month")))
    fitted = boosting.L1BoostedClassifier(maxIter=1, maxDepth=1, stepSize=0.5, alpha=5.0).fit(rows)
    return fitted.transform(rows).select("Order_ID", F.round(vector_to_array("probability")[1], 6).alias("probability"))


@query
def feature_importance(spark, folder):
    leads = _labelled(spark, folder)
    recipe = models.forest(leads, exclude=NOT_FEATURES)
    train = _splits(leads)[0]
    model = models.fit(recipe, train)
    return _rounded(models.feature_importance(model, recipe, train))


@query
def param_search(spark, folder):
    leads = standins.leads(spark, folder)
    train, validation, _ = _splits(leads)
    found = tune.param_search(models.logistic(leads, "Conversion_Status", IDS), train, validation,
                              tune.draw_trials(tune.LOGISTIC_SPACE))
    return _trial_rows(found.frame(spark), "maxIter", "threshold")


@query
def adaptive_param_search(spark, folder):
    """The wide logistic space in batches, broken off after 12 of 32 trials and taken up from the run table."""
    leads = standins.leads(spark, folder)
    train, validation, _ = _splits(leads)
    recipe, name = models.logistic(leads, "Conversion_Status", IDS), f"{_database(spark)}.adaptive_runs"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for trials in (12, None):
        found = tune.adaptive_search(recipe, train, validation, tune.LOGISTIC_WIDE_SPACE, trials, startup=12,
                                     runs_table=name)
    return _trial_rows(found.frame(spark), "maxIter", "threshold")


@query
def forest_param_search(spark, folder):
    leads = _labelled(spark, folder)
    train, validation, _ = _splits(leads)
    trials = [{"maxDepth": d, "numTrees": n} for d in (5, 6) for n in (10, 20)]
    found = tune.param_search(models.forest(leads, exclude=NOT_FEATURES), train, validation, trials)
    return _trial_rows(found.frame(spark), "maxDepth", "numTrees")


@query
def gbt_param_search(spark, folder):
    leads = _labelled(spark, folder)
    train, validation, _ = _splits(leads)
    trials = [{"maxDepth": d, "stepSize": s} for d in (3, 5) for s in (0.1, 0.3)]
    found = tune.param_search(models.boosted(leads, exclude=NOT_FEATURES, rounds=5), train,
                              validation, trials)
    return _trial_rows(found.frame(spark), "maxDepth", "stepSize")


def _level_means(model: models.FunnelModel, leads: DataFrame, recipe: models.Recipe, columns) -> DataFrame:
    """Per category of the training leads: its share of the label, and whether the model's mean is the same."""
    train = _splits(leads)[0]
    means = optimum.level_means(model.score(train), columns, recipe.classifier_label)
    same = F.abs(F.col("label_mean") - F.col("probability_mean")) < 1e-3
    return means.select("column", "level", "rows", F.round("label_mean", 6).alias("label_mean"), same.alias("same"))


@query
def lr_level_means(spark, folder):
    """The logistic regression is the optimum: every category's mean probability is its true share."""
    leads = _labelled(spark, folder)
    recipe = models.logistic(leads, "label", NOT_FEATURES)
    return _level_means(models.fit(recipe, _splits(leads)[0]), leads, recipe,
                        ["Profession", "Lead_Source", "City", "Location"])


@query
def encoded_lr_level_means(spark, folder):
    """The same behind target means: the columns that have a slot per category."""
    leads = _labelled(spark, folder)
    recipe = models.logistic(leads, "label", NOT_FEATURES, target_means=["Location", "Profession"])
    return _level_means(models.fit(recipe, _splits(leads)[0]), leads, recipe, ["Lead_Source", "City"])


@query
def lr_certificate(spark, folder):
    """Rows scored, and whether the gradient of the log-loss is zero for both logistic regressions."""
    leads = _labelled(spark, folder)
    train = _splits(leads)[0]
    built = {"logistic": models.logistic(leads, "label", NOT_FEATURES),
             "logistic_encoded": models.logistic(leads, "label", NOT_FEATURES, target_means=["Location", "Profession"])}
    return reduce(DataFrame.unionByName, [
        optimum.certificate(models.fit(recipe, train), recipe, train, tolerance=1e-3)
        .select(F.lit(kind).alias("kind"), "rows", "optimal") for kind, recipe in built.items()])


@query
def forest_node_scores(spark, folder):
    """Held-out leads scored by joining them to the forest's nodes, next to the model's own scores."""
    leads = _labelled(spark, folder)
    recipe = models.forest(leads, exclude=NOT_FEATURES)
    model = models.fit(recipe, _splits(leads)[0])
    scored = materialise(model.score(_held_out(leads)).select(
        "Lead_ID", "split", recipe.features, vector_to_array("probability")[1].alias("own")), "scored")
    nodes = forest_tables.tree_nodes(model.classifier, spark)
    found = forest_tables.forest_probability(forest_tables.descend(scored, nodes, "Lead_ID", recipe.features))
    both = scored.join(found, F.col("Lead_ID") == F.col("key"), "left")
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("scored"),
                                     F.count_if(F.abs(F.col("own") - F.col("probability")) < 1e-9).alias("same"))


@query
def forest_gain_importance(spark, folder):
    """Every feature's importance from the gains in the node table, next to the model's own."""
    leads = _labelled(spark, folder)
    recipe = models.forest(leads, exclude=NOT_FEATURES)
    train = _splits(leads)[0]
    model = models.fit(recipe, train)
    own = models.feature_importance(model, recipe, train).withColumnRenamed("importance", "own")
    found = forest_tables.importance_by_gain(forest_tables.tree_nodes(model.classifier, spark),
                                             encode.vector_names(model.features.transform(train), recipe.features))
    return own.join(found, "feature", "full").select(
        "feature", (F.abs(F.col("own") - F.col("importance")) < 1e-9).alias("same"))


def _trial_rows(runs: DataFrame, *names: str) -> DataFrame:
    return _rounded(runs.select("trial_id",
                                *[F.col("params")[n].cast("double").alias(n) for n in names],
                                F.col("value").alias("weighted_f1")))


@query
def retrain_best(spark, folder):
    """Search, refit the best trial on train, score validation and test, log the run."""
    leads = standins.leads(spark, folder)
    train, validation, _ = _splits(leads)
    recipe = models.logistic(leads, "Conversion_Status", IDS)
    best = tune.param_search(recipe, train, validation,
                             tune.draw_trials(tune.LOGISTIC_SPACE)).best
    model = tune.retrain(recipe, best, train)
    scores = _rounded(evaluate.scorecard(model.score(_held_out(leads)),
                                         recipe.classifier_label, "split"))
    params = F.create_map(*[F.lit(str(x)) for kv in best.items() for x in kv])
    runs = scores.select(
        F.concat(F.lit("logistic_final_"), "split").alias("run_name"),
        F.lit(0).cast("bigint").alias("trial_id"), params.alias("params"),
        F.lit("weighted_f1").alias("metric"), F.col("weighted_f1").alias("value"))
    name = f"{_database(spark)}.final_runs"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return tables.append_runs(runs, name).select(
        "run_name", "metric", "value",
        *[F.col("params")[k].cast("double").alias(k) for k in best])


def _planted(spark: SparkSession, folder: str) -> DataFrame:
    """Leads whose status follows from two numbers, so that a model predicts both classes."""
    converted = F.col("Account_Balance") + F.col("Sale_Amount") / 100 > 5000
    return standins.leads(spark, folder).withColumn(
        "Conversion_Status", F.when(converted, CONVERTED).otherwise(NOT_CONVERTED))


def _planted_model(leads: DataFrame) -> models.FunnelModel:
    return models.fit(models.logistic(leads, "Conversion_Status", IDS, handle_invalid="keep"),
                      _splits(leads)[0])


def _probability(name: str) -> Column:
    return vector_to_array("probability")[0].alias(name)


def _agreement(scored: DataFrame) -> DataFrame:
    """Leads by whether two probabilities are equal to 1e-9, and how many classes are predicted."""
    return scored.agg(F.count("before").alias("scored"),
                      F.count_if(F.abs(F.col("before") - F.col("after")) <= 1e-9).alias("same"),
                      F.count_distinct("predicted_status").alias("classes"))


@query
def model_save_load(spark, folder):
    """Every test lead scored by a model and by its reloaded copy."""
    leads = _planted(spark, folder)
    test = _splits(leads)[2]
    model = _planted_model(leads)
    path = fresh_path(spark, "model")
    model.save(path)
    first = model.score(test).select(*test.columns, _probability("before"))
    second = models.FunnelModel.load(spark, path).score(first)
    return _agreement(second.select("before", _probability("after"), "predicted_status"))


def _arriving_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("Customer_ID"), F.col("o_orderkey").alias("Order_ID"),
        F.col("o_totalprice").alias("Sale_Amount"), F.col("o_orderpriority").alias("Lead_Source"))


@query
def score_leads_stream(spark, folder):
    """Every lead scored from a stream, next to the score a batch gives it."""
    leads = _planted(spark, folder)
    model = _planted_model(leads)
    orders = lead_stream(spark, folder, tables.read_parquet(spark, folder, "orders").schema,
                         "orders.parquet")
    arriving = standins.lead_details(spark, folder, _arriving_orders(orders))
    out = fresh_path(spark, "scores")
    score_stream(model, arriving, out, fresh_path(spark, "stream"),
                 ["Lead_ID", "probability"]).awaitTermination()
    streamed = spark.read.parquet(out).select("Lead_ID", _probability("after"), "predicted_status")
    batch = model.score(leads).select("Lead_ID", _probability("before"))
    return _agreement(streamed.join(batch, "Lead_ID", "full"))


@query
def score_leads_deliveries(spark, folder):
    """Every order delivered twice and scored once, a row per lead."""
    leads = _planted(spark, folder)
    model = _planted_model(leads)
    inbox, registry, out = (fresh_path(spark, n) for n in ("inbox", "models", "scores"))
    orders = tables.read_parquet(spark, folder, "orders")
    files = deliver(orders, inbox, 2)
    publish_model(spark, model, registry)
    stream = (lead_stream(spark, inbox, orders.schema, files_per_batch=files)
              .withColumn("Start_Date", F.col("o_orderdate").cast("timestamp")))
    once = first_deliveries(stream, ["o_orderkey"], "Start_Date", "36500 days")
    score_newest(standins.lead_details(spark, folder, _arriving_orders(once)), registry, out,
                 fresh_path(spark, "stream"), ["Lead_ID"]).awaitTermination()
    batch = model.score(leads).select("Lead_ID", _probability("before"))
    close = F.abs(F.col("probability")[0] - F.col("before")) <= 1e-9
    return (scored_leads(spark, out).join(batch, "Lead_ID", "full")
            .select("Lead_ID", "model_version", close.alias("same")))


def entry(spark: SparkSession, folder: str) -> DataFrame:
    """Four tables, one funnel, one model: effectiveness per location."""
    table = funnel.funnel_table(*_four_tables(spark, folder)).drop("Start_Date")
    recipe = models.logistic(table, "Conversion_Status", ("Customer_ID",), handle_invalid="keep")
    return _rounded(funnel.effectiveness_report(table, recipe, by=["Location"]))
