"""Leads that are delivered again, that come late, or that meet a newer model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.models import FunnelModel
from sluice.sources.scratch import fresh_path

VERSIONS = "version bigint, path string"


def deliver(leads: DataFrame, inbox: str, times: int = 1) -> int:
    """Write the leads to a new inbox, so many times; tells the files of one delivery.

    A stream that takes that many files per batch has a batch per delivery,
    into however many files the leads' size makes Spark write them.
    """
    for _ in range(times):
        leads.write.mode("append").parquet(inbox)
    return -(-len(leads.sparkSession.read.parquet(inbox).inputFiles()) // times)


def first_deliveries(leads: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each lead once, by key, however often it is delivered within ``delay``.

    A key is remembered until the watermark, ``delay`` behind the latest
    ``time`` seen, has passed its own time by ``delay``, so state does not grow with the stream.  Leads
    older than the watermark are late: they are dropped and counted, see
    ``delivery_counts``.
    """
    return leads.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def publish_model(spark: SparkSession, model: FunnelModel, registry: str) -> int:
    """Save a model as the next version; streams take it up with their next batch.

    The version is listed after the model is complete, so no stream meets half
    a model.
    """
    try:
        version = newest_version(spark, registry)[0] + 1
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        version = 1
    path = f"{registry}/models/{version}-{fresh_path(spark, 'm')[-8:]}"
    model.save(path)
    (spark.createDataFrame([(version, path)], VERSIONS).coalesce(1)
     .write.mode("append").parquet(f"{registry}/versions"))
    return version


def newest_version(spark: SparkSession, registry: str) -> tuple[int, str]:
    """Number and folder of the newest version; one row per version is read."""
    listed = spark.read.schema(VERSIONS).parquet(f"{registry}/versions")
    newest = listed.agg(F.max(F.struct("version", "path")).alias("v")).first()["v"]
    return newest["version"], newest["path"]


def score_newest(leads: DataFrame, registry: str, output: str, checkpoint: str,
                 keep: Sequence[str], continuous: str | None = None) -> StreamingQuery:
    """Score a stream, each batch with the newest model published when it starts.

    Rows hold ``keep``, ``probability`` (an array), ``prediction``,
    ``predicted_status`` and ``model_version``.  A batch is written to a folder of its own
    number and replaces what a cut-off run of it left there, so a restart from the
    checkpoint doubles and loses nothing.  Read with ``scored_leads``.
    """
    loaded: dict[int, FunnelModel] = {}

    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version, path = newest_version(spark, registry)
        if version not in loaded:
            loaded.clear()
            loaded[version] = FunnelModel.load(spark, path)
        held = batch.persist()  # the state behind it is read and written once
        try:
            scored = loaded[version].score(held).select(
                *keep, vector_to_array("probability").alias("probability"), "prediction",
                "predicted_status", F.lit(version).cast("bigint").alias("model_version"))
            scored.write.mode("overwrite").parquet(f"{output}/batch={number}")
        finally:
            held.unpersist()

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (leads.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def scored_leads(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).drop("batch")


def delivery_counts(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Leads that arrived, came late, or were repeated, a row per batch.

    Covers the batches that Spark remembers
    (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    rows = []
    for p in query.recentProgress:
        state = p.stateOperators
        rows.append((p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in state),
                     sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in state)))
    counts = spark.createDataFrame(rows, "batch bigint, arrived bigint, late bigint, repeated bigint")
    return counts.groupBy("batch").agg(*[F.max(c).alias(c) for c in ("arrived", "late", "repeated")])
