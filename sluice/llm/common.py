"""Helpers the training-data operators share."""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.scratch import fresh_path, materialise  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(name: str):
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores in front until no column is called that."""
    low = {t.lower() for t in taken}
    while base.lower() in low:
        base = "_" + base
    return base


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts, from one scan of one column."""
    return docs.agg(F.sum(F.octet_length(quoted(text)))).first()[0] or 0


def parts_for(n: int, each: int, most: int = 100_000) -> int:
    """How many parts of about ``each`` make up ``n``; ``most`` only widens the parts."""
    return max(1, min(most, -(-n // each)))


#: Spark's setting by which the shuffle files of a job go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, list] = {}
_lock = threading.Lock()


def without_shuffles_left(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Jobs that the operator runs while it builds its result leave no shuffle files behind.

    Without it they stay until the driver collects garbage, and the disk holds
    those of all steps at once.  Only for operators that write each step and
    read the files.  The setting of the session is put back, after the last of
    the operators that run side by side.
    """
    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **more) -> DataFrame:
        conf, app = docs.sparkSession.conf, docs.sparkSession.sparkContext.applicationId
        with _lock:
            held = _cleaning.setdefault(app, [0, conf.get(CLEANUP, None)])
            held[0] += 1
            conf.set(CLEANUP, "true")
        try:
            out = operator(docs, *args, **more)
        finally:
            with _lock:
                held[0] -= 1
                if not held[0]:
                    del _cleaning[app]
                    conf.unset(CLEANUP) if held[1] is None else conf.set(CLEANUP, held[1])
        return out.select("*")  # a frame keeps to the setting it was made under
    return run
