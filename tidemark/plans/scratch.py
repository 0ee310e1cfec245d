"""Written intermediate tables.

A few plans need a row layout that cannot change between two uses (global row numbers, ranks). They
write the table once into the shared folder named by ``spark.checkpoint.dir`` and read it back. That
survives the loss of executors, cuts the lineage, and gives the planner a true table size, so that a
later join is broadcast only if the written files are below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a private folder only for a single-machine session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[context.applicationId]


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"


def drop_written(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Call it when no table derived from them is
    needed any more; nothing calls it on its own."""
    drop_path(spark, _application_folder(spark))


def written_at(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet into the shared folder; the table that was written, and its path."""
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and return the table that was written."""
    return written_at(df)[0]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one table of ``written_at`` when nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
