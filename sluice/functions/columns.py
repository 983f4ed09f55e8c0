from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two texts of the label.
CONVERTED = "Converted"
NOT_CONVERTED = "Not Converted"


def quoted(name: str) -> Column:
    """A column whose name may hold dots, slashes, blanks or percent signs."""
    return F.col("`" + name.replace("`", "``") + "`")


def conversion_label(status: Column) -> Column:
    """0.0 for converted, 1.0 for not converted, null for null.

    Any third text fails the job: silently mapping it to either class would
    corrupt the label.
    """
    return (F.when(status == CONVERTED, F.lit(0.0))
            .when(status == NOT_CONVERTED, F.lit(1.0))
            .when(status.isNotNull(),
                  F.raise_error(F.concat(F.lit("unknown conversion status: "), status))
                  .cast("double")))


def class_name(prediction: Column, names: Sequence[str]) -> Column:
    """The text of a predicted class index."""
    return F.get(F.array(*[F.lit(n) for n in names]), prediction.cast("int"))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; null, not an error, when ``whole`` is zero."""
    return F.try_divide(part * F.lit(100.0), whole)


def hash_bucket(keys: Sequence[Column], buckets: int, seed: str = "") -> Column:
    """A bucket in ``[0, buckets)`` that depends on the key values alone.

    Built on md5 so that any engine can reproduce it.  Keys are joined with a
    colon behind the seed; a null key counts as an empty text.
    """
    parts = [F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]]
    head = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
