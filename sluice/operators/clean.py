"""Projections, renames and row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted
from sluice.operators.joins import attach_lookup, lookup_hot_keys


def trim_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def resolve_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns meant by ``names``, whatever their case and the blanks around them.

    A name that fits no column is returned as it is.
    """
    have = {c.strip().lower(): c for c in reversed(df.columns)}
    return [n if n in df.columns else have.get(n.strip().lower(), n) for n in names]


def absent_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names that ``df`` has no column for."""
    return [n for n, c in zip(names, resolve_columns(df, names)) if c not in df.columns]


def drop_columns(df: DataFrame, names: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop columns; a name that is absent raises unless ``strict`` is off."""
    missing = absent_columns(df, names)
    if strict and missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.drop(*resolve_columns(df, names))


def rename_columns(df: DataFrame, names: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Rename columns from a map of old to new names."""
    missing = absent_columns(df, list(names))
    if strict and missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.withColumnsRenamed(dict(zip(resolve_columns(df, list(names)), names.values())))


def column_roles(schema: T.StructType, label: str | None = None) -> list[tuple[str, str, str]]:
    """``(column, type, role)`` per column.

    Dates and timestamps are neither numbers nor categories; they get their
    own role rather than being swept in with the numbers.
    """
    def role(field: T.StructField) -> str:
        if field.name == label:
            return "label"
        if isinstance(field.dataType, T.NumericType):
            return "numeric"
        if isinstance(field.dataType, (T.StringType, T.BooleanType)):
            return "categorical"
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "temporal"
        return "other"

    return [(f.name, f.dataType.simpleString(), role(f)) for f in schema.fields]


def numeric_columns(df: DataFrame, label: str | None = None) -> list[str]:
    return [c for c, _, role in column_roles(df.schema, label) if role == "numeric"]


def categorical_columns(df: DataFrame, label: str | None = None) -> list[str]:
    return [c for c, _, role in column_roles(df.schema, label) if role == "categorical"]


def typed_columns(df: DataFrame, label: str | None = None) -> DataFrame:
    """The schema as rows, each with the column's count of values (one scan)."""
    counts = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                     F.lit(kind).alias("dtype"), F.lit(role).alias("role"),
                     F.col(f"c{i}").alias("values"))
            for i, (c, kind, role) in enumerate(column_roles(df.schema, label))]
    return counts.select(F.inline(F.array(*rows)))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows that have a value in every one of ``columns``."""
    return df.where(reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in columns]))


def keep_known(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows whose categories all occur in ``fitted``; nulls drop out."""
    out = drop_incomplete(df, columns)
    for column in columns:
        known = fitted.select(quoted(column)).where(quoted(column).isNotNull()).distinct()
        out = attach_lookup(out, known, column, how="inner",
                            hot=lookup_hot_keys(df.select(quoted(column)), known, column))
    return out.select(*[quoted(c) for c in df.columns])
