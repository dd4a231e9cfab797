"""A page table laid out by URL, so that later stages find pages without moving HTML."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .pages import PAGE_SCHEMA

BUCKETS = 64
# Captures of one URL are spread over this many slots, so that no URL fills a bucket.
SLOTS = 8
_COLUMNS = ("page_id", "url", "html")


class PageStore:
    """Pages in hash buckets of (URL, slot), sorted by URL within a file.

    HTML is shuffled once, when pages are added. A join on (URL, slot) reads bucket
    by bucket: only the keys move. A URL's captures lie in ``SLOTS`` slots by
    their ``page_id``, so a URL that holds a third of all captures is read by several
    tasks; its key goes to each slot, which costs ``SLOTS`` narrow rows a key.

    The number of buckets is fixed when a store is made and kept beside the data; a store that
    is opened later, or from another session, takes it from there. Choose it so that a
    bucket's pages are some hundred megabytes. Pages without URL are kept and
    found by no key. Columns other than ``page_id, url, html`` are not stored.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}/_layout"
        try:
            self.buckets, self.slots = spark.read.schema("buckets int, slots int").json(layout).first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            self.buckets, self.slots = buckets, SLOTS
            spark.createDataFrame([(buckets, SLOTS)], "buckets int, slots int").coalesce(1).write.json(layout)
        self.table = f"pages_{hashlib.md5(self.path.encode()).hexdigest()}"
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({PAGE_SCHEMA}, slot int) USING parquet "
            f"CLUSTERED BY (url, slot) SORTED BY (url) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64("page_id"), F.lit(self.slots)).cast("int")

    def _rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)  # other sessions may have added files
        return self.spark.table(self.table)

    def add(self, pages: DataFrame) -> None:
        """Append captured pages: one file per bucket that gets any. The rows are
        dealt out as the buckets are, so each task writes a single file."""
        rows = pages.select(*_COLUMNS).withColumn("slot", self._slot())
        rows.repartition(self.buckets, "url", "slot").write.insertInto(self.table)

    def pages(self) -> DataFrame:
        """All pages, as any page source gives them."""
        return self._rows().select(*_COLUMNS)

    def choose(self, keys: DataFrame) -> DataFrame:
        """Pages whose URL is in ``keys(url)``. Few keys are broadcast to the
        scan; many are dealt out to the buckets. HTML stays where it is."""
        slots = F.sequence(F.lit(0), F.lit(self.slots - 1))
        spread = keys.select("url", F.explode(slots).alias("slot"))
        return self._rows().join(spread, ["url", "slot"], "left_semi").select(*_COLUMNS)

    def forget(self) -> None:
        """Take the table's name out of the catalogue; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
