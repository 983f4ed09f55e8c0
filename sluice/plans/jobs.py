"""The analyses as jobs that read and write catalog tables and files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import conversion_label, quoted
from sluice.operators import models, tune
from sluice.operators.clean import trim_names
from sluice.operators.encode import unlabelled_rows
from sluice.operators.evaluate import coverage, scorecard
from sluice.operators.profile import column_profile, duplicate_audit, table_shape
from sluice.operators.split import NAMES, split_name
from sluice.plans import funnel
from sluice.sources import files, records, tables
from sluice.sources.scratch import materialise


@dataclass(frozen=True)
class Audit:
    """What to look at before and after cleaning; nothing runs until it is asked for."""

    shape: DataFrame
    duplicates: DataFrame
    profile: DataFrame

    @classmethod
    def of(cls, df: DataFrame) -> "Audit":
        return cls(table_shape(df), duplicate_audit(df), column_profile(df))


def load_marketing(spark: SparkSession, path: str, table: str,
                   schema: T.StructType | None = None,
                   types: Mapping[str, str] | None = None) -> DataFrame:
    """Marketing CSV to cleaned table.  See ``read_csv`` for schema and types."""
    raw = files.read_csv(spark, path, schema, types)
    return tables.save_table(funnel.clean_marketing(raw), table)


def load_sales(spark: SparkSession, path: str, table: str,
               schema: T.StructType | None = None,
               types: Mapping[str, str] | None = None) -> DataFrame:
    """Sales CSV, with line breaks inside its fields, to cleaned table."""
    raw = records.read_csv_split(spark, path, schema, types)
    return tables.save_table(funnel.clean_sales(raw), table)


def build_funnel(spark: SparkSession, crm: str, external: str, marketing: str, sales: str,
                 database: str, table: str) -> DataFrame:
    """Join four catalog tables into ``database.table``."""
    tables.create_database(spark, database)
    joined = funnel.funnel_table(*[tables.read_table(spark, t)
                                   for t in (crm, external, marketing, sales)])
    return tables.save_table(joined, f"{database}.{table}")


@dataclass(frozen=True)
class TrainingRun:
    model: models.FunnelModel
    trials: DataFrame
    scores: DataFrame
    unlabelled: DataFrame


RecipeBuilder = Callable[[DataFrame, str], models.Recipe]

# Which recipe and which full search space each kind of model uses.
KINDS: Mapping[str, tuple[RecipeBuilder, tune.SearchSpace]] = {
    "logistic": (models.logistic, tune.LOGISTIC_SPACE),
    "logistic_encoded": (
        lambda df, label: models.logistic(df, label, target_means=("Location", "Profession")),
        tune.LOGISTIC_WIDE_SPACE),
    "forest": (models.forest, tune.FOREST_SPACE),
    "boosted": (models.boosted, tune.BOOSTED_SPACE),
    "penalised": (models.penalised, tune.PENALISED_SPACE),
    "indexed_boosted": (models.indexed_boosted, tune.BOOSTED_SPACE),
}


def train_funnel_model(spark: SparkSession, leads: DataFrame, kind: str,
                       model_path: str | None = None, runs_table: str | None = None,
                       keys: Sequence[str] | None = (funnel.KEY,),
                       trials: Sequence[Mapping[str, object]] | None = None,
                       parallelism: int = 4, means_from_all: bool = False) -> TrainingRun:
    """Split, search, retrain, score the test leads, record and save.

    ``leads`` may still hold identifiers and other columns that must not
    predict; they are left out of the predictors but serve to split.  The
    trials default to the kind's whole search space.  ``means_from_all`` fits the
    target means on all leads before the split; the scores are then optimistic.
    """
    builder, space = KINDS[kind]
    named = trim_names(leads)
    status = quoted(funnel.STATUS)
    labelled = (named.where(status.isNotNull())
                .withColumn("label", conversion_label(status))
                .withColumn("split", split_name([quoted(c) for c in keys or named.columns])))
    # Written once, a folder per split: later scans read their split alone.
    stored = materialise(labelled, "leads", "split")
    train, validation, test = [stored.where(F.col("split") == name).drop("split")
                               for name in NAMES]
    predictors, _ = funnel.model_table(train.drop(funnel.STATUS))
    recipe = builder(predictors, "label")
    means_on = stored.drop("split") if means_from_all else None
    found = tune.param_search(recipe, train, validation,
                              trials or tune.draw_trials(space), parallelism, means_on)
    model = tune.retrain(recipe, found.best, train, means_on)
    scored = model.score(test)
    scores = scorecard(scored, recipe.classifier_label).crossJoin(  # one row each
        coverage(test, scored).select("skipped"))
    if runs_table:
        tables.append_runs(found.frame(spark), runs_table)
        final = [(0, found.best, scores.first()["weighted_f1"])]
        tables.append_runs(tables.run_records(spark, f"{kind}_final", "weighted_f1", final),
                           runs_table)
    if model_path:
        model.save(model_path)
    return TrainingRun(model, found.frame(spark), scores, unlabelled_rows(named, funnel.STATUS))
