"""Missing numbers: medians of the training rows, and a column that says what was missing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted
from sluice.operators.clean import numeric_columns
from sluice.operators.profile import exact_percentiles

#: Behind the name of a column that had missing values.
SUFFIX = "_missing"


def _missing(df: DataFrame, name: str) -> Column:
    """A number that is not there: null, or not a number."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def missing_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Missing values per column, from one scan; one row comes back."""
    if not columns:
        return {}
    row = df.agg(*[F.count_if(_missing(df, c)).alias(str(i)) for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def columns_with_gaps(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The number columns that miss a value somewhere."""
    numbers = numeric_columns(df)
    counts = missing_counts(df, [c for c in (columns or numbers) if c in numbers])
    return [c for c, n in counts.items() if n]


@dataclass(frozen=True)
class Imputation:
    """Fitted medians, one number per column that had gaps in training."""

    medians: dict[str, float | None]

    @property
    def indicators(self) -> list[str]:
        return [c + SUFFIX for c in self.medians]

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill the gaps and add a 0/1 column per filled one; a stream is filled like a table.

        A column that had no number at all in training is filled with zero.
        """
        filled = {}
        for name, median in self.medians.items():
            gap = _missing(df, name)
            filled[name] = F.when(gap, F.lit(float(median or 0.0))).otherwise(quoted(name).cast("double"))
            filled[name + SUFFIX] = gap.cast("double")
        return df.select(*[filled[c].alias(c) if c in filled else quoted(c) for c in df.columns],
                         *[filled[c].alias(c) for c in self.indicators]) if filled else df

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        (spark.createDataFrame([(i, c, m) for i, (c, m) in enumerate(self.medians.items())],
                               "position int, column string, median double")
         .coalesce(1).write.mode("overwrite").parquet(path))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Imputation":
        rows = spark.read.parquet(path).orderBy("position").collect()  # a row per column
        return cls({r["column"]: r["median"] for r in rows})


def fit_imputation(train: DataFrame, columns: Sequence[str]) -> Imputation:
    """Medians of the training rows, found by exact rank: always a value that occurs."""
    clash = [c + SUFFIX for c in columns if c + SUFFIX in train.columns]
    if clash:
        raise ValueError(f"columns present already: {', '.join(clash)}")
    if not columns:
        return Imputation({})
    numbers = train.select(*[F.when(~_missing(train, c), quoted(c).cast("double")).alias(c) for c in columns])
    found = {r["column"]: r["value"] for r in exact_percentiles(numbers, list(columns), [0.5]).collect()}
    return Imputation({c: found.get(c) for c in columns})
