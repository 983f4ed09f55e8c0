"""Categories to numbers: target means, indices, formulas, vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import RFormula, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import conversion_label, quoted
from sluice.operators.clean import resolve_columns
from sluice.operators.joins import attach_lookup, lookup_hot_keys
from sluice.sources.scratch import materialise

#: A fitted index lives on the driver, so it is only built for columns with at
#: most this many categories.  Target means and wide indexes have no such limit.
MAX_INDEXED = 100_000


# -- label ------------------------------------------------------------------

def label_binarize(df: DataFrame, status: str, label: str = "label") -> DataFrame:
    """Add the 0/1 label and leave out rows without one."""
    return df.where(quoted(status).isNotNull()).withColumn(label, conversion_label(quoted(status)))


def unlabelled_rows(df: DataFrame, status: str) -> DataFrame:
    """How many rows have no label."""
    return df.agg(F.count_if(quoted(status).isNull()).alias("unlabelled_rows"),
                  F.count(F.lit(1)).alias("rows"))


# -- target means -----------------------------------------------------------

def smoothed_mean(n: Column, mean: Column, prior: Column, k: float, f: float) -> Column:
    """Shrink a category's mean towards the overall mean; rare ones most."""
    trust = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(k))) / F.lit(float(f))))
    return prior + (mean - prior) * trust


class TargetEncoding:
    """Fitted target means, kept as a table of one row per column and category.

    ``stats`` has ``column``, ``category`` (null is a category of its own) and
    ``encoded``.  The table may be of any size: joining it is left to the size
    check and the hot-key handling of :func:`attach_lookup`.
    """

    def __init__(self, stats: DataFrame, columns: Sequence[str], prior: float | None):
        self.stats, self.columns, self.prior = stats, list(columns), prior

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace every encoded column by its mean; unseen categories get the prior."""
        out = df
        for i, column in enumerate(self.columns):
            key, value = f"_key{i}", f"_enc{i}"
            lookup = (self.stats.where(F.col("column") == column)
                      .select(_category_key(F.col("category")).alias(key),
                              F.col("encoded").alias(value)))
            # Searched in the input, not in what the joins so far have made of it.
            hot = lookup_hot_keys(df.select(_category_key(quoted(column)).alias(key)),
                                      lookup, key)
            out = attach_lookup(out.withColumn(key, _category_key(quoted(column))), lookup, key,
                                hot=hot).drop(key)
        prior = F.lit(self.prior).cast("double")
        encoded = {c: F.coalesce(F.col(f"_enc{i}"), prior) for i, c in enumerate(self.columns)}
        return out.select(*[encoded[c].alias(c) if c in encoded else quoted(c)
                            for c in df.columns])

    def save(self, path: str) -> None:
        header = self.stats.sparkSession.createDataFrame(
            [(self.columns, self.prior)], "columns array<string>, prior double")
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")
        header.write.mode("overwrite").parquet(f"{path}/header")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TargetEncoding":
        header = spark.read.parquet(f"{path}/header").first()
        return cls(spark.read.parquet(f"{path}/stats"), header["columns"], header["prior"])


def _category_key(category: Column) -> Column:
    """A join key that is never null and keeps null apart from every text."""
    return F.concat(F.when(category.isNull(), F.lit("n")).otherwise(F.lit("v")),
                    F.coalesce(category.cast("string"), F.lit("")))


def category_stats(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Labelled rows and label sum per category, for all columns in one scan.

    Rows are unpivoted and reduced per task before the shuffle, so a category
    that holds a third of the rows sends one record per task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("category"))
                      for c in columns])
    return (df.select(quoted(label).alias("_y"), F.explode(pairs).alias("p"))
            .groupBy("p.column", "p.category")
            .agg(F.count("_y").alias("n"), F.sum("_y").alias("total")))


def fit_target_encoding(train: DataFrame, columns: Sequence[str], label: str,
                        k: float = 20.0, f: float = 10.0) -> TargetEncoding:
    """Learn smoothed label means.

    Fit on the training rows.  Fitting on all rows before the split is possible
    but hands the labels of the held-out rows to the model.
    """
    columns = resolve_columns(train, columns)
    counted = materialise(category_stats(train, columns, label), "target-means")
    # The categories of any one column partition the rows, so they give the overall mean.
    prior = (counted.where(F.col("column") == columns[0])
             .agg(F.try_divide(F.sum("total"), F.sum("n").cast("double"))).first()[0])
    mean = F.try_divide(F.col("total"), F.col("n").cast("double"))
    stats = counted.select("column", "category", "n", smoothed_mean(
        F.col("n"), mean, F.lit(prior).cast("double"), k, f).alias("encoded"))
    return TargetEncoding(stats, columns, prior)


# -- Spark ML stages --------------------------------------------------------

def check_categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_INDEXED) -> None:
    """Refuse to index a column whose categories would not fit the driver."""
    if not columns:
        return
    # rsd 5 %: one sketch per column, one row.
    counts = df.agg(*[F.approx_count_distinct(quoted(c)).alias(str(i))
                      for i, c in enumerate(columns)]).first()
    wide = [c for i, c in enumerate(columns) if counts[i] > limit]
    if wide:
        raise ValueError(f"more than {limit} categories in {', '.join(wide)}; "
                         "use target means or a wide index for these columns")


def string_indexer(columns: Sequence[str], suffix: str = "_si",
                   handle_invalid: str = "keep") -> StringIndexer:
    """Indices by falling frequency, ties by name; outputs get a suffix."""
    return StringIndexer(inputCols=list(columns), outputCols=[c + suffix for c in columns],
                         handleInvalid=handle_invalid)


def formula_encoder(label: str, features: str = "enc_features", encoded_label: str | None = None,
                    terms: str = ".", handle_invalid: str = "skip") -> RFormula:
    """One-hot texts with the rarest level as base, numbers as they are."""
    return RFormula(formula=f"{label} ~ {terms}", featuresCol=features,
                    labelCol=encoded_label or f"{label}_enc", handleInvalid=handle_invalid)


def scaler(features: str = "enc_features", output: str = "sc_features") -> StandardScaler:
    """Divide by the sample deviation, without centring, so that zeros stay zero."""
    return StandardScaler(inputCol=features, outputCol=output)


def assembler(columns: Sequence[str], output: str = "inp_features",
              handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output,
                           handleInvalid=handle_invalid)


def feature_columns(df: DataFrame, label: str, *other: str) -> list[str]:
    """All columns but the label and any others named."""
    skip = {label, *other}
    return [c for c in df.columns if c not in skip]


def vector_names(df: DataFrame, vector: str) -> list[str]:
    """Names of a vector column's slots, from the metadata the stages leave."""
    meta = df.schema[vector].metadata.get("ml_attr", {})
    slots = [a for group in meta.get("attrs", {}).values() for a in group]
    ordered = sorted(slots, key=lambda a: a["idx"])
    return [a.get("name", f"{vector}_{a['idx']}") for a in ordered]


def class_names(df: DataFrame, label: str) -> list[str] | None:
    """Texts behind an indexed label, in index order."""
    return df.schema[label].metadata.get("ml_attr", {}).get("vals")
