"""Session settings shared by the bench, the tests and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g",
                  **conf: str) -> SparkSession:
    """A local session.  On a cluster use the session the platform hands out."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("sluice")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(partitions)))
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
