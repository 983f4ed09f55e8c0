"""Shape, duplicates and column statistics."""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted
from sluice.operators.clean import numeric_columns

Slot = tuple[int, int]  # (column, percentile), both as positions

#: Percentiles of a profile, as discrete percentiles: always a value that
#: occurs in the column.
PERCENTILES = (0.25, 0.5, 0.75)
#: Size parameter of the quantile sketch: rank error around 0.1 percent.
SKETCH_SIZE = 4_000
#: Leading bits of a value that one pass over it tells apart.
BITS = 16
#: The code of infinity.
LARGEST = 2047 * 2 ** 52


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).alias("columns"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each row; nulls compare equal.

    Copies are merged before the shuffle, so a row with many copies travels
    once per task.
    """
    return df.dropDuplicates()


def duplicate_audit(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies, from one aggregation."""
    copies = (df.groupBy(*[quoted(c) for c in df.columns])
              .agg(F.count(F.lit(1)).alias("_copies")))
    total = F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint")
    return copies.agg(total.alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
                      (total - F.count(F.lit(1))).alias("duplicate_rows"))


def column_profile(df: DataFrame, exact: bool = False,
                   percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Statistics per column: values, nulls, distinct, range, moments, percentiles.

    By default two scans with bounded memory: the distinct count and the
    percentiles are estimates from sketches.  ``exact`` counts distinct values
    through a shuffle of the values and pins each percentile down by rank.
    Minimum and maximum are returned as text since the columns' types differ;
    moments and percentiles are null for columns that are not numbers.
    """
    names = [f"p{round(p * 100)}" for p in percentiles]
    # One row per column of df on every side of these joins.
    out = moments(df)
    if exact:
        ranks = (exact_percentiles(df, numeric_columns(df), percentiles)
                 .groupBy("column").pivot("percentile", [float(p) for p in percentiles])
                 .agg(F.first("value")).toDF("column", *names))
        out = (out.join(distinct_counts(df), "column", "left")
               .join(ranks, "column", "left"))
    else:
        out = out.join(_sketches(df, percentiles, names), "column", "left")
    return out.select("column", "values", "nulls", "distinct", "min", "max", "mean",
                      "stddev", *names)


def moments(df: DataFrame) -> DataFrame:
    """Counts, range, mean and sample deviation per column, as one row each.

    Numbers and times are kept apart from texts and sketches: their aggregation
    compiles to one loop over fixed-width buffers, which either would prevent.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = [c for c in df.columns if c not in text]
    parts = [_moments(df.select(*[quoted(c) for c in group])) for group in (fixed, text) if group]
    return reduce(DataFrame.unionByName, parts)


def _moments(df: DataFrame) -> DataFrame:
    numbers = set(numeric_columns(df))
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, name in enumerate(df.columns):
        c = quoted(name)
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}")]
        mean = deviation = F.lit(None).cast("double")
        if name in numbers:
            number = c.cast("double")
            aggs += [F.avg(number).alias(f"avg{i}"), F.stddev(number).alias(f"sd{i}")]
            mean, deviation = F.col(f"avg{i}"), F.col(f"sd{i}")
        rows.append(F.struct(
            F.lit(name).alias("column"), F.col(f"n{i}").alias("values"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.col(f"min{i}").cast("string").alias("min"),
            F.col(f"max{i}").cast("string").alias("max"),
            mean.alias("mean"), deviation.alias("stddev")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _sketches(df: DataFrame, percentiles: Sequence[float], names: Sequence[str]) -> DataFrame:
    numbers = set(numeric_columns(df))
    aggs, rows = [], []
    for i, name in enumerate(df.columns):
        c = quoted(name)
        aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
        values = [F.lit(None).cast("double")] * len(names)
        if name in numbers:
            aggs.append(F.kll_sketch_agg_double(c.cast("double"), SKETCH_SIZE).alias(f"q{i}"))
            values = [F.when(F.kll_sketch_get_n_double(f"q{i}") > 0,
                             F.kll_sketch_get_quantile_double(f"q{i}", F.lit(float(p))))
                      for p in percentiles]
        rows.append(F.struct(F.lit(name).alias("column"), F.col(f"d{i}").alias("distinct"),
                             *[v.alias(n) for v, n in zip(values, names)]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct values per column; equal values merge before the shuffle.

    Every column is counted by itself: a columnar source is read once in all,
    and no row is copied per column.
    """
    return reduce(DataFrame.unionByName, [
        df.select(quoted(c).alias("v")).where("v IS NOT NULL").distinct()
        .agg(F.count(F.lit(1)).alias("distinct")).select(F.lit(c).alias("column"), "distinct")
        for c in df.columns])


def exact_percentiles(df: DataFrame, columns: Sequence[str],
                      percentiles: Sequence[float]) -> DataFrame:
    """Discrete percentiles of number columns: the value at rank ``ceil(p * n)``.

    A histogram over parts of octaves tells the bin that holds each rank.
    Doubles are also numbered in their order by 64-bit codes: the next passes look at the
    values of these bins alone, each by the next ``BITS`` bits of their codes, until
    a bin holds one value.  That takes ``1 + 48 / BITS`` passes at most, for all columns
    together and however the values lie.  Rows are counted per bin before the
    shuffle, so a task sends some ``2 ** BITS`` counts per rank at most.
    """
    spark = df.sparkSession
    schema = "column string, percentile double, value double"
    if not columns:
        return spark.createDataFrame([], schema)
    numbers = [quoted(c).cast("double") for c in columns]
    ranks = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(p)).alias("p"))
                      for j, p in enumerate(percentiles)])
    long = (df.select(F.posexplode(F.array(*numbers)).alias("i", "v")).where("v IS NOT NULL")
            .withColumn("bin", _octave_part(F.col("v"))))
    sums = _histogram(long, "i")
    located = (sums.select("*", F.inline(ranks))
               .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("total"))))
               .where("rank > upto - n AND rank <= upto")
               .select("i", "j", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "lo", "hi"))
    # One row per column and percentile, whatever the size of df.
    open_slots = {(r.i, r.j): (r.rank, r.lo, r.hi) for r in located.collect()}
    found = {}
    while True:
        found |= {s: lo for s, (_, lo, hi) in open_slots.items() if lo == hi or lo != lo}
        open_slots = {s: v for s, v in open_slots.items() if s not in found}
        if not open_slots:
            break
        open_slots = _refined(df, numbers, open_slots)
    return spark.createDataFrame(
        [(columns[i], float(percentiles[j]), v) for (i, j), v in found.items()], schema)


def _refined(df: DataFrame, numbers: Sequence[Column],
             slots: Mapping[Slot, tuple[int, float, float]]) -> dict:
    """Each rank and the bounds of its bin, by the next bits of the values within the bounds."""
    entries, inside = [], []
    for (i, j), (_, lo, hi) in slots.items():
        low, shift = code_of(lo), max(0, (code_of(hi) - code_of(lo)).bit_length() - BITS)
        inside.append(numbers[i].between(lo, hi))
        entries.append(F.when(inside[-1], F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), numbers[i].alias("v"),
            F.lit(low).cast("bigint").alias("low"), F.lit(shift).alias("shift"))))
    ranks = reduce(lambda a, b: a.when(*b), [
        ((F.col("i") == i) & (F.col("j") == j), F.lit(rank)) for (i, j), (rank, _, _) in slots.items()], F)
    long = (df.where(reduce(lambda a, b: a | b, inside))
            .select(F.inline(F.array_compact(F.array(*entries))))
            .withColumn("code", _code(F.col("v")))
            .withColumn("bin", F.expr("shiftright(code - low, shift)")))
    located = (_histogram(long, "i", "j").withColumn("rank", ranks)
               .where("rank > upto - n AND rank <= upto"))
    return {(r.i, r.j): (r.rank - r.upto + r.n, r.lo, r.hi) for r in located.collect()}


def _histogram(long: DataFrame, *keys: str) -> DataFrame:
    """Rows per bin, summed up to and including it, with the least and largest value inside."""
    order = Window.partitionBy(*keys).orderBy("bin")
    return (long.groupBy(*keys, "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .withColumn("upto", F.sum("n").over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("total", F.sum("n").over(Window.partitionBy(*keys))))


def _octave_part(v: Column) -> Column:
    """A number that never falls as ``v`` grows, 32 to each doubling of its size."""
    size = F.abs(v)
    part = (F.when(size == 0, F.lit(0).cast("bigint"))
            .when(F.isnan(size), F.lit(2 ** 20 + 1).cast("bigint"))
            .when(size == float("inf"), F.lit(2 ** 20).cast("bigint"))
            .otherwise(F.floor(F.log2(size) * 32) + 1075 * 32))
    return F.when(v < 0, -part).otherwise(part)


def _code(v: Column) -> Column:
    """A number per double, in the doubles' order: exponent and fraction, negative below zero."""
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("int")
    # The logarithm may be off by one next to a power of two.
    power = (F.when(F.pow(F.lit(2.0), guess) > size, guess - 1)
             .when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess))
    fraction = (size / F.pow(F.lit(2.0), power) - 1.0) * F.lit(2.0 ** 52)
    code = (F.when(size == 0, F.lit(0).cast("bigint"))
            .when(F.isnan(size), F.lit(LARGEST + 1))
            .when(size == float("inf"), F.lit(LARGEST))
            .when(size < 2.0 ** -1022, (size / F.lit(5e-324)).cast("bigint"))
            .otherwise((power + 1023).cast("bigint") * F.lit(2 ** 52) + fraction.cast("bigint")))
    return F.when(v < 0, -code).otherwise(code)


def code_of(v: float) -> int:
    """The same for one value."""
    if math.isnan(v):
        return LARGEST + 1
    code = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
    return -code if v < 0 else code
