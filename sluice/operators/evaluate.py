"""Class counts, weighted F1, cut-off sweeps and funnel effectiveness.

All of it is one scan that is reduced to a handful of counts per task; the
formulas then run on those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import CONVERTED, percent, quoted


def group_count(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("count"))


def confusion(df: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """Rows per pair of true and predicted class."""
    return (df.groupBy(*by, quoted(label).alias("label"), quoted(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def f1_from_confusion(counts: DataFrame, *by: str, hit: Column | None = None) -> DataFrame:
    """Weighted F1 per group: each class's F1, weighted by its true rows.

    ``hit`` marks predictions to count along the way.
    """
    zero, n = F.lit(0).cast("bigint"), F.col("n")
    right = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    marked = F.when(hit, n).otherwise(zero) if hit is not None else zero
    sides = F.array(
        F.struct(F.col("label").alias("cls"), n.alias("support"), zero.alias("predicted"),
                 right.alias("right"), marked.alias("marked")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("support"), n.alias("predicted"),
                 zero.alias("right"), zero.alias("marked")))
    sums = ("support", "predicted", "right", "marked")
    per_class = (counts.select(*by, F.inline(sides)).groupBy(*by, "cls")
                 .agg(*[F.sum(c).alias(c) for c in sums]))
    f1 = F.try_divide(F.lit(2.0) * F.col("right"), F.col("support") + F.col("predicted"))
    out = [F.coalesce(F.sum("support"), F.lit(0)).cast("bigint").alias("rows"),
           F.try_divide(F.sum(F.col("support") * f1), F.sum("support").cast("double"))
           .alias("weighted_f1")]
    if hit is not None:
        out.append(F.coalesce(F.sum("marked"), F.lit(0)).cast("bigint")
                   .alias("predicted_converted"))
    return per_class.groupBy(*by).agg(*out)


def weighted_f1(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: scored rows and weighted F1, which is null for no rows."""
    return f1_from_confusion(confusion(df, label, prediction))


def threshold_sweep(df: DataFrame, label: str, score: str,
                    thresholds: Sequence[float]) -> DataFrame:
    """Weighted F1 of a 0/1 label at every cut-off, from one scan.

    A row is predicted 1 when its score exceeds the cut-off.  Rows are counted
    by label and by how many cut-offs they exceed; no row is copied per
    cut-off and no model is refitted.
    """
    cuts = sorted(set(float(t) for t in thresholds))
    exceeded = sum((F.when(quoted(score) > t, 1).otherwise(0) for t in cuts), F.lit(0))
    histogram = (df.select(quoted(label).cast("double").alias("label"), exceeded.alias("exceeded"))
                 .groupBy("label", "exceeded").agg(F.count(F.lit(1)).alias("n")))
    # From here on at most 2 * (cut-offs + 1) rows go in.
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold"))
                     for i, t in enumerate(cuts)])
    counts = (histogram.select("label", "exceeded", "n", F.inline(grid))
              .groupBy("threshold", "label",
                       F.when(F.col("exceeded") > F.col("i"), 1.0).otherwise(0.0).alias("prediction"))
              .agg(F.sum("n").alias("n")))
    return f1_from_confusion(counts, "threshold")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The cut-off with the highest F1, the lowest of several."""
    return sweep.orderBy(F.desc("weighted_f1"), "threshold").limit(1)


def effectiveness(predicted: Column) -> list[Column]:
    """Aggregates over predicted class texts."""
    hits = F.count_if(predicted == CONVERTED)
    return [F.count(F.lit(1)).alias("scored_leads"), hits.alias("predicted_converted"),
            percent(hits, F.count(F.lit(1))).alias("effectiveness")]


def funnel_effectiveness(df: DataFrame, predicted: str, *by: str) -> DataFrame:
    """Percentage of scored leads predicted to convert, overall or per group.

    Works on the predicted text, never on the position of a class in some
    result, so it means the same whichever way a model numbers its classes.
    """
    return df.groupBy(*[quoted(c) for c in by]).agg(*effectiveness(quoted(predicted)))


def scorecard(scored: DataFrame, label: str, *by: str) -> DataFrame:
    """Rows, weighted F1 and effectiveness per group, from one scan of scored leads."""
    counts = (scored.groupBy(*by, quoted(label).alias("label"), "prediction", "predicted_status")
              .agg(F.count(F.lit(1)).alias("n")))
    card = f1_from_confusion(counts, *by, hit=F.col("predicted_status") == CONVERTED)
    return card.withColumn("effectiveness", percent(F.col("predicted_converted"), F.col("rows")))


def coverage(leads: DataFrame, scored: DataFrame, *by: str) -> DataFrame:
    """Leads that were given, scored and skipped, per group; one scan of each."""
    given = leads.groupBy(*[quoted(c) for c in by]).agg(F.count(F.lit(1)).alias("given"))
    done = scored.groupBy(*[quoted(c) for c in by]).agg(F.count(F.lit(1)).alias("scored"))
    both = given.join(done, list(by), "left") if by else given.crossJoin(done)  # one row each
    n = F.coalesce("scored", F.lit(0))
    return both.select(*[quoted(c) for c in by], "given", n.alias("scored"), (F.col("given") - n).alias("skipped"))
