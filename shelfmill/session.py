"""Session settings that suit page extraction."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Parsing costs far more CPU per byte than a plain scan: smaller splits.
    "spark.sql.files.maxPartitionBytes": "64m",
    # Page expressions are large; recording a call site per node costs seconds.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Pages are large rows: bound Arrow batches by rows too.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that a running session can still change.

    Task functions travel with the job, so workers need no installed package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and cut-off tables. Where none
    is named, one is made if all tasks run in this process, and else it is an
    error: executors would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="shelfmill-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from there. Unlike a
    checkpoint, the table can be read column by column, and its size is known
    when later joins are planned."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_session(app: str = "shelfmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
