"""Numbers for the categories of columns of any width.

A :class:`StringIndexer` keeps its levels on the driver.  Here they stay a
table: counted in one scan, ordered by a range shuffle, numbered by their place
in a task plus the levels of the tasks before it, and looked up by a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.columns import quoted
from sluice.operators.clean import resolve_columns
from sluice.operators.joins import attach_lookup, lookup_hot_keys
from sluice.sources.scratch import materialise

POLICIES = ("keep", "skip", "error")


class WideIndex:
    """A fitted index, kept as a table of one row per column and level.

    ``levels`` has ``slot`` (the column's place in ``columns``), ``level``, ``n``
    (its rows) and ``rank``; ``sizes`` has the levels of each column.
    """

    def __init__(self, levels: DataFrame, columns: Sequence[str], sizes: Sequence[int]):
        self.levels, self.columns, self.sizes = levels, list(columns), list(sizes)

    def transform(self, df: DataFrame, suffix: str = "_si", handle_invalid: str = "keep") -> DataFrame:
        """Add each column's index as a double.

        A null or unseen text gets the number after the last (``keep``), costs
        its row (``skip``), or fails the job (``error``).
        """
        if handle_invalid not in POLICIES:
            raise ValueError(f"handle_invalid has to be one of {', '.join(POLICIES)}")
        taken = {c.lower() for c in df.columns}
        clash = [c + suffix for c in self.columns if (c + suffix).lower() in taken]
        if clash:
            raise ValueError(f"columns present already: {', '.join(clash)}")
        out, found = df, {}
        for i, column in enumerate(self.columns):
            key, rank = f"_key{i}", f"_rank{i}"
            text = quoted(column).cast("string").alias(key)
            lookup = self.levels.where(F.col("slot") == i).select(F.col("level").alias(key),
                                                                  F.col("rank").alias(rank))
            hot = lookup_hot_keys(df.select(text), lookup, key)
            out = attach_lookup(out.select("*", text), lookup, key, hot=hot).drop(key)
            found[column + suffix] = F.col(rank)
            if handle_invalid == "keep":
                found[column + suffix] = F.coalesce(rank, F.lit(self.sizes[i]))
            elif handle_invalid == "error":
                found[column + suffix] = F.coalesce(rank, F.raise_error(
                    F.lit(f"a null or unseen text in {column}")).cast("long"))
        if handle_invalid == "skip":
            out = out.dropna(subset=[f"_rank{i}" for i in range(len(self.columns))])
        return out.select(*map(quoted, df.columns), *[c.cast("double").alias(n) for n, c in found.items()])

    def named_levels(self) -> DataFrame:
        """``column, level, n, rank`` of all columns."""
        names = F.array(*map(F.lit, self.columns))
        return self.levels.select(names[F.col("slot")].alias("column"), "level", "n", "rank")

    def save(self, path: str) -> None:
        header = self.levels.sparkSession.createDataFrame(
            [(self.columns, self.sizes)], "columns array<string>, sizes array<long>")
        self.levels.write.mode("overwrite").partitionBy("slot").parquet(f"{path}/levels")
        header.write.mode("overwrite").parquet(f"{path}/header")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "WideIndex":
        header = spark.read.parquet(f"{path}/header").first()
        levels = spark.read.schema("level string, n long, rank long, slot int").parquet(f"{path}/levels")
        return cls(levels, header["columns"], header["sizes"])


def fit_wide_index(df: DataFrame, columns: Sequence[str]) -> WideIndex:
    """Number the levels of each column by falling frequency, ties by name (UTF-8 order).

    Nulls are no level.  Rows are reduced to counts per task before the shuffle,
    so a level that holds a third of the rows sends one record per task.  No
    task sees more than its range of levels; what crosses tasks is one number
    per task and column.
    """
    columns = resolve_columns(df, columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("slot"), quoted(c).cast("string").alias("level"))
                      for i, c in enumerate(columns)])
    counted = materialise(
        df.select(F.explode(pairs).alias("p")).where("p.level IS NOT NULL")
        .groupBy("p.slot", "p.level").agg(F.count(F.lit(1)).alias("n")), "level-counts")
    order = [F.col("slot"), F.desc("n"), F.col("level")]
    # Written with their places, so that offsets and places are of the same run.
    placed = materialise(
        counted.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("slot", "level", "n", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().alias("place")), "level-places")
    runs = placed.groupBy("slot", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    earlier = F.sum("held").over(Window.partitionBy("slot").orderBy("part")) - F.col("held")
    levels = (placed.join(runs.select("slot", "part", "first", earlier.alias("before")), ["slot", "part"])
              .select("level", "n", (F.col("before") + F.col("place") - F.col("first")).alias("rank"), "slot"))
    # A folder per column: each lookup then has its own size.
    levels = materialise(levels, "index", "slot")
    sizes = {r["slot"]: r["size"] for r in runs.groupBy("slot").agg(F.sum("held").alias("size")).collect()}
    return WideIndex(levels, columns, [sizes.get(i, 0) for i in range(len(columns))])
