"""Result tables: column contracts, append sinks, visited keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import Store, Table, open_table

# ---- fixed values: column order of the two result tables ----
CAMPAIGN_COLUMNS = (
    "campaign_id", "campaign_url", "total_products_count", "unique_products_count",
    "brand_name", "subcategories", "end_date_text", "extraction_timestamp",
)
PRODUCT_COLUMNS = (
    "product_id", "product_url", "campaign_id", "campaign_url", "subcategory",
    "product_name", "original_price", "discount_price", "discount_percentage", "color",
    "sizes_status", "image_url", "extraction_timestamp",
)
# ---- end of fixed values ----

# Quotes doubled, empty text written as nothing: the usual CSV dialect.
CSV_WRITE = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "encoding": "UTF-8"}
CSV_READ = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "multiLine": True}


def conform(df: DataFrame, columns: Sequence[str], keep_types: Sequence[str] = ()) -> DataFrame:
    """Exactly these columns in this order; unknown ones are dropped, missing
    ones and nulls become '' (S5)."""

    def column(name: str) -> Column:
        if name not in df.columns:
            return F.lit("").alias(name)
        if name in keep_types:
            return F.col(name)
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    return df.select(*[column(c) for c in columns])


def _append(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_WRITE)
    writer.save(path)


def write_campaigns(df: DataFrame, path: str, fmt: str = "csv", mode: str = "append") -> None:
    """Append campaign rows (S3)."""
    counts = ("total_products_count", "unique_products_count")
    _append(conform(df, CAMPAIGN_COLUMNS, counts), path, fmt, mode)


def write_products(df: DataFrame, path: str, fmt: str = "csv", mode: str = "append") -> None:
    """Append product rows."""
    _append(conform(df, PRODUCT_COLUMNS), path, fmt, mode)


def stored_rows(
    spark: SparkSession, path: str, fmt: str = "csv", skip_corrupt: bool = False
) -> DataFrame | None:
    """A stored table, or ``None`` when nothing is there. Of a table that runs
    commit to, the last commit's rows; its format is known. A broken file fails
    the read, as rows lost from a history would be crawled again; only
    ``skip_corrupt`` reads the rest."""
    committed = open_table(spark, path)
    if committed is not None:
        return committed
    reader = spark.read.format(fmt).option("ignoreCorruptFiles", skip_corrupt)
    if fmt == "csv":
        reader = reader.options(**CSV_READ)
    try:
        return reader.load(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def visited_keys(
    spark: SparkSession, path: str, key: str = "campaign_url", fmt: str = "csv"
) -> DataFrame:
    """Distinct keys of a stored table; empty when the table or the column is
    missing (S6). Of a table that runs commit to, the files of its key table are read."""
    stored = open_table(spark, path, key)
    if stored is None:
        stored = stored_rows(spark, path, fmt)
    if stored is None or key not in stored.columns:
        return spark.createDataFrame([], f"{key} string")
    return stored.select(key).distinct()


def _ddl(columns: Sequence[str], whole: Sequence[str] = ()) -> str:
    return ", ".join(f"{c} {'long' if c in whole else 'string'}" for c in columns)


def crawl_store(
    spark: SparkSession, campaigns: str, products: str, fmt: str = "csv", rejects: str | None = None, pending: str | None = None,
) -> Store:
    """The tables of a crawl, which change by whole runs.

    ``campaigns`` holds a row per campaign and entry (the run that found it);
    a later run that completes its listings writes the row anew. Of the two key
    tables a run reads only the files that its candidates hash to. ``open_*``
    is work without a page: listings, products, and what is known of the
    products of campaigns with open listings, so that none is counted twice.
    """
    beside = campaigns.rstrip("/")
    pending = pending or f"{beside}-pending"
    text = {"fmt": fmt, "write": CSV_WRITE, "read": CSV_READ} if fmt == "csv" else {"fmt": fmt}
    counts = ("total_products_count", "unique_products_count")
    step = "campaign_url string, name string, end_date string, page_pos int, url string, subcategory string, entry long"
    stub = (
        "campaign_url string, page_pos int, pos int, product_url string, product_name string, subcategory string, "
        "campaign_name string, campaign_sector string, campaign_end_date string, entry long"
    )
    return Store(spark, f"{beside}/_commits", {
        "campaigns": Table(
            beside, f"{_ddl(CAMPAIGN_COLUMNS, counts)}, entry long, version long", key=("campaign_url", "entry"), columns=CAMPAIGN_COLUMNS,
            keys=f"{beside}-keys/campaigns", **text,
        ),
        "products": Table(products.rstrip("/"), _ddl(PRODUCT_COLUMNS), columns=PRODUCT_COLUMNS, keys=f"{beside}-keys/products", **text),
        "campaign_keys": Table(f"{beside}-keys/campaigns", "campaign_url string", bucket="campaign_url"),
        "product_keys": Table(f"{beside}-keys/products", "campaign_url string, product_url string", bucket="product_url"),
        "rejects": Table((rejects or f"{beside}-rejects").rstrip("/"), "page_id long, url string, error string, html string"),
        "open_listings": Table(f"{pending}/listings", step),
        "open_products": Table(f"{pending}/products", stub),
        "open_counted": Table(f"{pending}/counted", "campaign_url string, entry long, product_url string"),
    })


def run_timestamp(value: str) -> Column:
    """The run's one timestamp text, given by the caller."""
    return F.lit(value)
