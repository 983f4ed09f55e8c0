"""Train, validation and test splits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import hash_bucket, quoted

# The shares of train, validation and test.
WEIGHTS = (0.6, 0.2, 0.2)
NAMES = ("train", "validation", "test")
#: Resolution of the key-hash split.
BUCKETS = 1000


def split_name(keys: Sequence[Column], weights: Sequence[float] = WEIGHTS,
               names: Sequence[str] = NAMES, seed: str = "") -> Column:
    """Which split a row belongs to, from its key alone.

    The same key gets the same split in every run, plan and partitioning, which
    a random split does not promise once a lost task is run again.
    """
    share = sum(weights)
    ends = [round(BUCKETS * upto / share) for upto in accumulate(weights)]
    bucket = hash_bucket(keys, BUCKETS, seed)
    out = F.lit(names[-1])
    for name, end in reversed(list(zip(names[:-1], ends[:-1]))):
        out = F.when(bucket < end, name).otherwise(out)
    return out


def split(df: DataFrame, keys: Sequence[str] | None = None,
          weights: Sequence[float] = WEIGHTS, seed: str = "") -> list[DataFrame]:
    """Disjoint splits that together hold every row.

    ``keys`` names the identity that must not straddle two splits, such as the
    customer in a table with several rows per customer.  Without it the whole
    row is the key, so copies of a row stay together.
    """
    chosen = split_name([quoted(c) for c in keys or df.columns], weights,
                        [str(i) for i in range(len(weights))], seed)
    return [df.where(chosen == str(i)) for i in range(len(weights))]


def random_split(df: DataFrame, weights: Sequence[float] = WEIGHTS,
                 seed: int = 42) -> list[DataFrame]:
    """Spark's sampling split.  Stable only while the input's partitions are."""
    return df.randomSplit(list(weights), seed)
