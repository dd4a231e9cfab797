"""Page sources."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = "page_id long, url string, html string"


def read_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", url: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Captured pages as ``page_id, url, html``.

    ``parquet``, ``json`` and ``orc`` hold these columns. ``html`` reads saved
    page files, also in sub-folders. ``url`` makes a page's URL from its place
    below ``path``, less the ending ``.html``; without it, that place is the URL.
    """
    if fmt == "html":
        raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        file = F.col("_metadata.file_path")
        plain = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
        folder = re.escape(path.rstrip("/").split(":", 1)[-1].lstrip("/"))
        place = F.regexp_replace(F.regexp_replace(plain, f"^.*?{folder}/", ""), r"\.html$", "")
        return raw.select(
            F.xxhash64(file).alias("page_id"),
            (url(place) if url else place).alias("url"),
            F.col("value").alias("html"),
        )
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)


def balanced(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before the costly parse.

    An input of fewer splits than cores is small by construction (splits have
    a size bound), so this shuffle is too. A larger input is left alone.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stream_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Pages of a growing folder, as a stream."""
    reader = spark.readStream.schema(PAGE_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
