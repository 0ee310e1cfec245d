"""Session settings shared by the bench, the tests and the smoke entry."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # call-site capture costs several milliseconds per column expression on the driver
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "tidemark", **extra: str) -> SparkSession:
    """A single-machine session. On a cluster the session comes from spark-submit instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    partitions = "8" if cores == "*" else str(max(int(cores), 1))
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": partitions, "spark.driver.memory": "12g", **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
