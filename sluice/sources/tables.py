"""Catalog tables, databases, previews and the run log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("run_name", T.StringType(), False),
    T.StructField("trial_id", T.LongType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None,
                    use: bool = False) -> None:
    """Create a database unless it is there; optionally make it current."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")
    if use:
        spark.sql(f"USE {_quoted(name)}")


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a managed table with ``df`` and return the table as stored."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows; with an order, one top-n per task and a final merge."""
    return (df.orderBy(*order) if order else df).limit(n)


def append_runs(runs: DataFrame, table: str) -> DataFrame:
    """Append run records (see ``RUN_SCHEMA``) to a table, stamped with the time."""
    stamped = runs.select(*[f.name for f in RUN_SCHEMA],
                          F.current_timestamp().alias("logged_at"))
    stamped.write.mode("append").saveAsTable(table)
    return runs.sparkSession.table(table)


def run_records(spark: SparkSession, run_name: str, metric: str,
                trials: Iterable[tuple[int, Mapping[str, object], float]]) -> DataFrame:
    """Driver-side trial results as run records; one row per fitted model."""
    rows: Sequence[tuple] = [
        (run_name, trial, {k: str(v) for k, v in params.items()}, metric, value)
        for trial, params, value in trials]
    return spark.createDataFrame(rows, RUN_SCHEMA)
