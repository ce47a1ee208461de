"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC timestamps and Arrow on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: the one the cluster names.

    Only a local session without the setting gets a temporary folder, since there
    the driver and the executors are one machine.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[|$)", context.master):  # local-cluster has executors of its own
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="larkspur-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives lost executors."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, of which later steps read the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
