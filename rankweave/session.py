"""Session settings and stage tables kept in the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "rankweave", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on; everything else is left to the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in `spark.checkpoint.dir`.

    Only a session whose executors are the driver itself may run without the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rankweave-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and keeps column pruning, filter pushdown and exact
    size statistics for the plans built on top.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(table: DataFrame) -> None:
    """Delete a table made by `materialize` that nothing reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        _delete(table.sparkSession, folder)


def clear_stages(spark: SparkSession) -> None:
    """Delete every table that this application has written to the shared folder."""
    _delete(spark, f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
