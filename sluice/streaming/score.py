"""Score new leads as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.models import FunnelModel


def lead_stream(spark: SparkSession, folder: str, schema: T.StructType,
                pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """New parquet files in a folder, a bounded number per micro-batch."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def score_stream(model: FunnelModel, leads: DataFrame, output: str, checkpoint: str,
                 keep: list[str], continuous: str | None = None) -> StreamingQuery:
    """Write the scores of a lead stream as parquet, each lead exactly once.

    Scoring keeps no state and shuffles nothing, so no watermark is needed.
    Without ``continuous`` (a trigger interval) the query takes what is there,
    in bounded batches, and ends.
    """
    scored = model.score(leads).select(*keep, "prediction", "predicted_status")
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", output).option("checkpointLocation", checkpoint))
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
