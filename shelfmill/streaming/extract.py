"""Pages as they come (ST1): a stream to an append table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.crawl import extract_details, extract_links
from ..rules import DEFAULT_PROFILE, SiteProfile


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: Sequence[str] = ("page_id",),
) -> StreamingQuery:
    """Append the first row per key, by ``order``, of the batch that first holds
    the key; stop when all present input is read.

    Which keys are known is state, kept by key in RocksDB on the executors' disks
    and saved in ``checkpoint``: a batch reads its new input and the state of
    its own keys, however many rows are stored. Each task sends one row per key
    to the state, so a hot key is no hot task. Each batch is a folder
    ``batch=<number>`` of Parquet files, written whole, so a batch that is
    repeated after a failure replaces itself, and a restart adds nothing.
    """
    spark = rows.sparkSession
    # All rows of a batch have its start as ``now``, also when it is repeated.
    now = F.current_timestamp()
    first = (
        rows.withColumn("__now", now).groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
            F.min_by(F.struct(*rows.columns), F.struct("__now", *order)).alias("row"),
            F.min("__now").alias("first"), F.max("__now").alias("last"),
        )
    )

    def write(batch: DataFrame, number: int) -> None:
        # A batch gets all its keys; those that it holds first have no earlier time.
        new = batch.filter("first = last").select("row.*")
        new.write.mode("overwrite").parquet(f"{path}/batch={number}")

    kind = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(kind)
    spark.conf.set(kind, STATE_STORE)
    try:
        return (
            first.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(kind, before)


def stream_details(
    pages: DataFrame, path: str, checkpoint: str, profile: SiteProfile = DEFAULT_PROFILE
) -> StreamingQuery:
    """Product pages to detail rows, first capture per URL. Pages are parsed
    before duplicates are dropped, so the state shuffle moves no HTML."""
    return stream_table(extract_details(pages, profile), path, checkpoint, ["url"])


def stream_links(
    pages: DataFrame, path: str, checkpoint: str, profile: SiteProfile = DEFAULT_PROFILE
) -> StreamingQuery:
    """The first link to each target of a page stream."""
    return stream_table(extract_links(pages, profile), path, checkpoint, ["url"], ["page_id", "pos"])
