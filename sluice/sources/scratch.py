"""Where intermediate tables live, and how large Spark thinks a plan is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    base = spark.conf.get(SETTING, None)
    if base:
        return base.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="sluice-")
    return _local[app]


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """An unused path in the shared folder; two runs never share one."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write once and read back: short lineage, known size, survives lost executors."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[
        "`" + c.replace("`", "``") + "`" for c in df.columns])


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, or None where it cannot be asked for (Connect)."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
