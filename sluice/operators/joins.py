"""Joins on a customer key, safe when one key holds a large share of the rows.

Small sides are left to Catalyst, which broadcasts them on their size.  Beyond
that a key's rows all meet in one task, and a key that several tables repeat
yields the product of its rows there.  So the rows per key are counted first,
reduced per task before they are shuffled, and multiplied.  A key whose result
is more than a task's share is hot: its rows are dealt over a grid with one axis
per table, a row picks a coordinate on its own table's axis and is copied along
the others.  Each pair of matching rows meets in exactly one cell, so the result
is the plain join's result.

Each axis is as long as that table's own rows of that key demand, and nothing
else bounds it: a table with a handful of rows gets an axis of one, however many
rows it is joined to, and is the one that is copied.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted
from sluice.sources.scratch import materialise, plan_bytes

#: Rows of the result that one key may have in one task.  It measures work per
#: task and neither bounds a key nor changes a result.
ROWS_PER_TASK = 1_000_000

_CELL, _AXES, _KEY = "_cell", "_axes", "_hot"


@dataclass(frozen=True)
class HotKeys:
    """Rows ``_hot, _axes``: a key and the length of each table's axis; None where no key is hot."""

    grid: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.grid is not None


def shared_names(tables: Sequence[DataFrame], keys: Sequence[str]) -> list[str]:
    """Non-key column names that more than one table has, ignoring case."""
    skip = {k.lower() for k in keys}
    seen: set[str] = set()
    clash: list[str] = []
    for table in tables:
        for name in table.columns:
            low = name.lower()
            if low in skip:
                continue
            if low in seen and name not in clash:
                clash.append(name)
            seen.add(low)
    return clash


def rows_per_key(tables: Sequence[DataFrame], key: str, how: str = "inner") -> DataFrame:
    """``_hot, n0, n1, ...``: how many rows each table has of a key, null keys left out.

    Rows are counted per task before the shuffle, so a hot key sends one number.
    """
    counted = [t.where(quoted(key).isNotNull()).groupBy(quoted(key).alias(_KEY)).agg(F.count(F.lit(1)).alias(f"n{i}"))
               for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.join(b, _KEY, how), counted)


def grid_axes(rows: Sequence[Column], per_task: int) -> Column:
    """Axis lengths for a key with so many rows per table.

    The rows of a cell multiply to at most ``per_task``.  Tables are dealt with
    from the smallest up: each may put the even share of what is left into a
    cell, and one that has fewer rows than that leaves the rest to the others.
    """
    by_size = F.array_sort(F.array(*[F.struct(n.cast("double").alias("n"), F.lit(i).alias("i"))
                                     for i, n in enumerate(rows)]))
    start = F.struct(F.lit(float(per_task)).alias("room"), F.lit(len(rows)).alias("left"),
                     F.array().cast("array<struct<i:int,axis:bigint>>").alias("axes"))

    def place(acc: Column, x: Column) -> Column:
        share = F.greatest(F.lit(1.0), F.floor(F.pow(acc["room"], F.lit(1.0) / acc["left"]) + 1e-9).cast("double"))
        in_cell = F.least(F.greatest(x["n"], F.lit(1.0)), share)
        axis = F.greatest(F.ceil(x["n"] / in_cell), F.lit(1))
        return F.struct((acc["room"] / in_cell).alias("room"), (acc["left"] - 1).alias("left"),
                        F.array_append(acc["axes"], F.struct(x["i"].alias("i"), axis.alias("axis"))).alias("axes"))

    placed = F.aggregate(by_size, start, place, lambda acc: F.array_sort(acc["axes"]))
    return F.transform(placed, lambda x: x["axis"])


def hot_keys(tables: Sequence[DataFrame], key: str, per_task: int | None = None) -> HotKeys:
    """Keys whose rows multiply to more than ``per_task``, with their grids.

    There are fewer of them than the result has tasks' shares, so they are kept
    as a table; Catalyst sees its size and broadcasts it while that is small.
    """
    per_task = per_task or ROWS_PER_TASK
    counts = rows_per_key(tables, key)
    rows = [F.col(f"n{i}") for i in range(len(tables))]
    return _kept(counts, rows, per_task)


def _kept(counts: DataFrame, rows: Sequence[Column], per_task: int) -> HotKeys:
    product = reduce(lambda a, b: a * b, [F.greatest(n, F.lit(1)).cast("double") for n in rows])
    grid = materialise(counts.where(product > per_task).select(_KEY, grid_axes(rows, per_task).alias(_AXES)), "hot-keys")
    return HotKeys(None if grid.isEmpty() else grid)


def _without(table: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Rows of ordinary keys, and rows without a key."""
    return table.join(hot.grid, quoted(key) == F.col(_KEY), "left_anti")


def _on_grid(table: DataFrame, key: str, axis: int, hot: HotKeys) -> DataFrame:
    """Rows of hot keys, one per cell that they belong to.

    They are written first: their numbers are then the same whenever a task runs
    again, and rows that are copies of each other still get different ones.
    """
    rows = materialise(table.join(hot.grid, quoted(key) == F.col(_KEY)).drop(_KEY), "hot-rows")
    length = F.element_at(_AXES, axis + 1)
    below = F.aggregate(F.slice(_AXES, 1, axis), F.lit(1).cast("long"), lambda a, x: a * x) if axis else F.lit(1)
    cells = F.aggregate(_AXES, F.lit(1).cast("long"), lambda a, x: a * x)
    numbered = rows.withColumns({"_own": F.pmod(F.monotonically_increasing_id(), length), "_below": below.cast("long"),
                                 "_length": length, "_copies": (cells / length).cast("long")})
    copied = numbered.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    cell = (F.pmod("_o", "_below") + F.col("_own") * F.col("_below")
            + F.floor(F.col("_o") / F.col("_below")) * F.col("_below") * F.col("_length"))
    return copied.withColumn(_CELL, cell).drop(_AXES, "_own", "_below", "_length", "_copies", "_o")


def join_on_key(tables: Sequence[DataFrame], key: str, hot: HotKeys | None = None,
                per_task: int | None = None) -> DataFrame:
    """Inner-join all tables on ``key``, left to right; the key appears once.

    A row per combination of matching rows: null keys drop out, repeated keys
    multiply.  Two tables must not share any other column name.
    """
    clash = shared_names(tables, [key])
    if clash:
        raise ValueError(f"columns present in several tables: {', '.join(clash)}")
    if hot is None:
        hot = hot_keys(tables, key, per_task)
    if not hot:
        return reduce(lambda a, b: a.join(b, key, "inner"), tables)
    plain = reduce(lambda a, b: a.join(b, key, "inner"), [_without(t, key, hot) for t in tables])
    spread = reduce(lambda a, b: a.join(b, [key, _CELL], "inner"),
                    [_on_grid(t, key, i, hot) for i, t in enumerate(tables)])
    return plain.unionByName(spread.drop(_CELL))


def lookup_hot_keys(facts: DataFrame, lookup: DataFrame, key: str, per_task: int | None = None) -> HotKeys:
    """Hot keys of the facts where the lookup is too large to be broadcast.

    A key that the lookup lacks is counted as well: its rows meet in one task too.
    """
    if facts.isStreaming:  # cannot be counted; its micro-batches are bounded instead
        return HotKeys()
    limit = _as_bytes(facts.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    size = plan_bytes(lookup)
    if size is not None and size <= limit:
        return HotKeys()
    counts = rows_per_key([facts, lookup], key, "left")
    return _kept(counts, [F.col("n0"), F.coalesce("n1", F.lit(1))], per_task or ROWS_PER_TASK)


def attach_lookup(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                  hot: HotKeys | None = None, per_task: int | None = None) -> DataFrame:
    """Join a table with a few rows per key onto a large one, ``left`` or ``inner``.

    Catalyst broadcasts the lookup when it is small.  A larger one is shuffled;
    then the rows of hot keys are spread out first, and rows without a key,
    which match nothing, do not take part at all.
    """
    if hot is None:
        hot = lookup_hot_keys(facts, lookup, key, per_task)
    if not hot:
        return facts.join(lookup, key, how)
    keyed = facts.where(quoted(key).isNotNull())
    plain = _without(keyed, key, hot).join(lookup, key, how)
    spread = _on_grid(keyed, key, 0, hot).join(_on_grid(lookup, key, 1, hot), [key, _CELL], how).drop(_CELL)
    out = plain.unionByName(spread)
    if how == "left" and facts.schema[key].nullable:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema.fields if f.name != key]
        out = out.unionByName(facts.where(quoted(key).isNull()).select("*", *empty))
    return out


def _as_bytes(text: str) -> int:
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = text.strip().lower().removesuffix("b")
    return int(text[:-1]) * units[text[-1]] if text[-1:] in units else int(text)


def join_size(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Row counts of the tables and of their join, without running the join.

    Each table is reduced to rows per key before anything is shuffled; matching
    counts multiply.  Tells in advance what repeated keys will do to the result.
    """
    per_key = [t.where(quoted(key).isNotNull()).groupBy(key)
               .agg(F.count(F.lit(1)).alias(f"n{i}")) for i, t in enumerate(tables)]
    joined = reduce(lambda a, b: a.join(b, key, "full"), per_key)
    wide = T.DecimalType(38, 0)
    counts = [F.coalesce(F.col(f"n{i}"), F.lit(0)) for i in range(len(tables))]
    product = reduce(lambda a, b: (a * b).cast(wide), [c.cast(wide) for c in counts])
    return joined.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(product > 0).alias("joined_keys"),
        F.coalesce(F.sum(product), F.lit(0)).cast(wide).alias("joined_rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"rows_{i}")
          for i, c in enumerate(counts)],
        *[F.max(c).alias(f"max_rows_per_key_{i}") for i, c in enumerate(counts)])
