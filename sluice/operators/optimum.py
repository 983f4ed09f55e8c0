"""Is a fitted logistic regression the optimum?  Its own equations say so."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import quoted
from sluice.operators.encode import vector_names
from sluice.operators.models import FunnelModel, Recipe


def _probability() -> Column:
    return vector_to_array("probability")[1]


def log_loss_gradient(scored: DataFrame, features: str, label: str) -> DataFrame:
    """``feature, gradient``: the mean of (probability - label) * value per slot, and for the intercept.

    At the optimum of the log-loss without a penalty all of them are zero.  Two
    scans, whatever the number of slots: weights, and the sums of a vector weighted by
    the probability and by the label, whose difference is the gradient.
    """
    weighted = scored.select(quoted(features).alias("x"), _probability().alias("p"), quoted(label).alias("y"))
    names = vector_names(scored, features)
    ones = weighted.agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("p"), F.sum("y").alias("y")).first()
    # Rows without weight are none to the summary, which fails on nothing at all.
    sums = [Summarizer.metrics("sum").summary(F.col("x"), F.col(w))["sum"].alias(w) for w in ("p", "y") if ones[w]]
    if sums:
        row = weighted.agg(*sums).first().asDict()  # one row of two vectors at most
        totals = [row[w].toArray() if w in row else 0.0 for w in ("p", "y")]
        slots = [*((totals[0] - totals[1]) / ones.n).tolist(), (ones.p - ones.y) / ones.n]
    else:
        slots = [0.0 if ones.n else None] * (len(names) + 1)
    return SparkSession.active().createDataFrame(
        list(zip([*names, "(intercept)"], slots)), "feature string, gradient double")


def level_means(scored: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``column, level, rows, label_mean, probability_mean`` per category.

    A model with a slot per category of a column gives each category its true
    share: at the optimum the two means are equal, for the base level as well.
    All columns are reduced in one scan.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("level")) for c in columns])
    return (scored.select(quoted(label).alias("y"), _probability().alias("p"), F.explode(pairs).alias("x"))
            .groupBy("x.column", "x.level").agg(F.count(F.lit(1)).alias("rows"), F.avg("y").alias("label_mean"),
                                                F.avg("p").alias("probability_mean")))


def certificate(model: FunnelModel, recipe: Recipe, train: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """One row: scored rows, largest gradient in scaled features, whether it is within ``tolerance``.

    The features are scaled by their deviation, so that one bound fits all.
    """
    scored = model.score(train)
    gradient = log_loss_gradient(scored, recipe.features, recipe.classifier_label)
    largest = gradient.agg(F.max(F.abs("gradient")).alias("largest_gradient"))
    return scored.agg(F.count(F.lit(1)).alias("rows")).crossJoin(largest).withColumn(  # one row each
        "optimal", F.coalesce(F.col("largest_gradient") <= tolerance, F.lit(False)))

