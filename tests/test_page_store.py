"""The page store: layout, batches, plans, hot URLs, runs over it."""

import pytest
from pyspark.sql import functions as F
from test_crawl import HOME, PAGES, SITE, TS

from shelfmill.plans.crawl import run
from shelfmill.sources.page_store import SLOTS, PageStore
from shelfmill.sources.tables import CAMPAIGN_COLUMNS, PRODUCT_COLUMNS, stored_rows

SCHEMA = "page_id long, url string, html string"


@pytest.fixture
def unbroadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _all(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_batches_and_later_sessions(spark, tmp_path):
    rows = [(i, f"{SITE}/p/{i % 50}", f"<p>{i}</p>") for i in range(200)] + [(None, f"{SITE}/p/7", "x"), (900, None, "y"), (901, f"{SITE}/p/7", None)]
    path = f"{tmp_path}/it's a store"
    first = PageStore(spark, path, 4)
    first.add(spark.createDataFrame(rows[:120], SCHEMA).withColumn("slot", F.lit("mine")))
    first.forget()
    again = PageStore(spark, path, 99)  # the layout of the store counts
    assert again.buckets == 4
    again.add(spark.createDataFrame(rows[120:], SCHEMA))
    assert _all(again.pages()) == sorted(rows, key=repr)
    keys = spark.createDataFrame([(f"{SITE}/p/7",), (f"{SITE}/p/7",), (None,), ("elsewhere",)], "url string")
    assert _all(again.choose(keys)) == sorted([r for r in rows if r[1] == f"{SITE}/p/7"], key=repr)
    assert again.choose(keys.limit(0)).count() == 0


def test_an_empty_store(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/none")
    store.add(spark.createDataFrame([], SCHEMA))
    assert store.pages().count() == 0 and store.pages().columns == ["page_id", "url", "html"]


def test_html_is_not_shuffled(spark, tmp_path, unbroadcast):
    store = PageStore(spark, f"{tmp_path}/store", 4)
    store.add(spark.createDataFrame([(i, f"{SITE}/p/{i}", "<p>") for i in range(100)], SCHEMA))
    keys = spark.range(10).select(F.concat(F.lit(f"{SITE}/p/"), F.col("id").cast("string")).alias("url"))
    chosen = store.choose(keys)
    assert chosen.count() == 10
    plan = chosen._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # The only exchange deals out the keys, into as many parts as there are buckets.
    assert plan.count("Exchange") == 1 and "Range" in plan[plan.index("Exchange"):]
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 4 out of 4" in plan


def test_a_hot_url_lies_in_several_files(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/hot", 16)
    store.add(spark.createDataFrame([(i, f"{SITE}/", "<p>") for i in range(4000)], SCHEMA))
    per_file = [r["count"] for r in store.pages().groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) >= SLOTS // 2 and max(per_file) < 2000 and sum(per_file) == 4000


def test_a_run_over_the_store_gives_the_same_tables(spark, tmp_path, unbroadcast):
    pages = spark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(PAGES)], SCHEMA)
    store = PageStore(spark, f"{tmp_path}/store", 4)
    for batch in (pages.filter("page_id < 5"), pages.filter("page_id >= 5")):
        store.add(batch)
    assert HOME in [r.html for r in store.pages().collect()]
    got = []
    for name, source, choose in (("plain", pages, None), ("store", store.pages(), store.choose)):
        counters = run(source, [f"{SITE}/"], f"{tmp_path}/{name}/c", f"{tmp_path}/{name}/p", TS, fmt="parquet", choose=choose)
        tables = [_all(stored_rows(spark, f"{tmp_path}/{name}/{t}", "parquet").select(*c)) for t, c in (("c", CAMPAIGN_COLUMNS), ("p", PRODUCT_COLUMNS))]
        got.append((counters, tables))
    assert got[0] == got[1] and got[0][0]["products"] > 0
