"""Whole runs over captured pages: results, resume, sinks, streams."""

import pytest
from pyspark.sql import functions as F

from shelfmill import SiteProfile
from shelfmill.plans.crawl import (
    crawl_tables, extract, extract_chosen, extract_details, extract_links, run,
)
from shelfmill.session import cut
from shelfmill.sources.pages import balanced, read_pages, stream_pages
from shelfmill.sources.tables import (
    CAMPAIGN_COLUMNS, PRODUCT_COLUMNS, conform, stored_rows, visited_keys, write_campaigns, write_products,
)
from shelfmill.streaming.extract import stream_details, stream_links, stream_table

SITE = "https://shop.example.com"
TS = "2024-05-01 12:00:00"
LINKED = "<script type='application/ld+json'>{}</script>".format


def card(path, name):
    return f"<article><a href='{path}'><h3>{name}</h3></a></article>"


def listing(*keys):
    return "".join(f"<div class='product-card'><a href='/p/{k}'><h3>Item {k}</h3></a></div>" for k in keys)


def product(key, name):
    return f"<h1>{name}</h1>" + LINKED(f'{{"price": {key}.5, "highPrice": {2 * key + 1}}}')


HOME = card("/catalog/1", "Uno") + card("/catalog/2", "Dos") + card("/catalog/3", "Tres") + card("/catalog/4", "Cuatro")
CAMPAIGN = (
    "<ul data-testid='CatalogTree'><li><a href='/catalog/1/a'>Moda</a></li><li><a href='/catalog/1/b'></a></li></ul>"
)
PAGES = [
    (f"{SITE}/", HOME),
    (f"{SITE}/catalog/1", CAMPAIGN + listing(1, 2)),
    (f"{SITE}/catalog/1/a", listing(2, 3, 4)),
    (f"{SITE}/catalog/1/b", listing(4, 5)),
    (f"{SITE}/catalog/2", listing(1)),
    (f"{SITE}/catalog/3", "<p>empty</p>"),
    *[(f"{SITE}/p/{k}", product(k, f"Producto {k} - azul" if k == 2 else f"Producto {k}")) for k in (1, 2, 3, 5)],
    # Later captures of known URLs: the first one counts.
    (f"{SITE}/catalog/2", listing(1, 5)),
    (f"{SITE}/p/1", product(1, "Copia")),
]


@pytest.fixture
def pages(spark):
    rows = [(i, url, html) for i, (url, html) in enumerate(PAGES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_tables_of_a_run(pages):
    extracts = cut(extract(pages, [f"{SITE}/"]), "extracts")
    campaigns, products = crawl_tables(extracts, TS)
    assert campaigns.columns == list(CAMPAIGN_COLUMNS) and products.columns == list(PRODUCT_COLUMNS)
    # Campaign 1: its own page, then each sub-page twice (tree and by URL).
    # Campaign 4 has no captured page yet, so it stays open.
    assert rows(campaigns, "campaign_id", "total_products_count", "unique_products_count", "subcategories") == [
        ("1", 2 + 2 * (3 + 2), 5, "Moda, Moda"), ("2", 1, 1, ""), ("3", 0, 0, ""),
    ]
    assert rows(products, "campaign_id", "product_id", "product_name", "subcategory", "original_price",
                "discount_price", "discount_percentage", "color") == [
        ("1", "1", "Producto 1", "principal", "3.00", "1.50", "-50%", ""),
        ("1", "2", "Producto 2 - azul", "principal", "5.00", "2.50", "-50%", "azul"),
        ("1", "3", "Producto 3", "Moda", "7.00", "3.50", "-50%", ""),
        ("1", "5", "Producto 5", "subpagina_3", "11.00", "5.50", "-50%", ""),
        ("2", "1", "Producto 1", "principal", "3.00", "1.50", "-50%", ""),
    ]


def test_limits(pages):
    tight = SiteProfile(max_campaigns=1, max_subpages=1, max_products=2)
    extracts = cut(extract(pages, [f"{SITE}/"], tight), "extracts")
    campaigns, products = crawl_tables(extracts, TS, tight)
    # Own page in front of the one sub-page; counts are whole, rows are cut.
    assert rows(campaigns, "campaign_id", "total_products_count", "unique_products_count") == [("1", 5, 4)]
    assert rows(products, "product_id") == [("1",), ("2",)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_run_and_resume(spark, pages, tmp_path, fmt):
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    one = SiteProfile(max_campaigns=1)
    go = lambda profile, **kw: run(pages, [f"{SITE}/"], *paths, TS, profile, fmt, **kw)
    stored = lambda i: stored_rows(spark, paths[i], fmt)
    go(one)
    assert rows(stored(0), "campaign_id") == [("1",)]
    assert stored(1).count() == 4
    go(one)  # the next new campaign
    assert rows(stored(0), "campaign_id") == [("1",), ("2",)]
    go(SiteProfile())
    assert rows(stored(0), "campaign_id") == [("1",), ("2",), ("3",)]
    go(SiteProfile())  # nothing is new
    assert (stored(0).count(), stored(1).count()) == (3, 5)
    go(one, allow_duplicates=True)
    assert (stored(0).count(), stored(1).count()) == (4, 9)
    expected = "" if fmt == "parquet" else None  # an empty CSV field reads as null
    assert stored(1).filter("product_id = '1'").first().color == expected


def test_open_work_is_taken_up(spark, pages, tmp_path):
    """A listing and products that were not captured at first are completed."""
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    late = F.col("url").isin(f"{SITE}/catalog/1/b", f"{SITE}/p/2")
    run(pages.filter(~late), [f"{SITE}/"], *paths, TS)
    assert rows(stored_rows(spark, paths[1]), "campaign_id", "product_id") == [("1", "1"), ("1", "3"), ("2", "1")]
    left = lambda name: stored_rows(spark, f"{paths[0]}-pending/{name}", "parquet")
    # The sub-page stands twice in the plan; product 4 is never captured.
    assert {r.url for r in left("listings").collect()} == {f"{SITE}/catalog/1/b"}
    assert rows(left("products"), "product_url") == [(f"{SITE}/p/2",), (f"{SITE}/p/4",)]
    run(pages.filter(late | F.col("url").isin(f"{SITE}/", f"{SITE}/p/5")), [f"{SITE}/"], *paths, TS)
    assert rows(stored_rows(spark, paths[1]), "campaign_id", "product_id") == [
        ("1", "1"), ("1", "2"), ("1", "3"), ("1", "5"), ("2", "1")]
    assert left("listings").count() == 0 and rows(left("products"), "product_url") == [(f"{SITE}/p/4",)]
    assert stored_rows(spark, paths[0]).count() == 3


def test_only_chosen_pages_are_parsed(spark, pages):
    """Campaigns 1 and 3 are stored: only what campaign 2 calls for is read."""
    known = spark.createDataFrame([(f"{SITE}/catalog/1",), (f"{SITE}/catalog/3",)], "campaign_url string")
    got = extract_chosen(pages, [f"{SITE}/"], visited=known)
    # Campaign 2 and product 1 were captured twice.
    assert rows(got, "url") == [(f"{SITE}/",), *[(f"{SITE}/catalog/2",)] * 2, *[(f"{SITE}/p/1",)] * 2]
    full = extract(pages, [f"{SITE}/"])
    assert [(n, t.simpleString()) for n, t in ((f.name, f.dataType) for f in got.schema)] == [
        (n, t.simpleString()) for n, t in ((f.name, f.dataType) for f in full.schema)]


def test_unread_capture_hides_nothing(spark, tmp_path):
    bad = "<![foo[bar]]>"
    captures = [(f"{SITE}/", card("/catalog/1", "Uno")), (f"{SITE}/catalog/1", bad), (f"{SITE}/catalog/1", listing(1)),
                (f"{SITE}/p/1", bad), (f"{SITE}/p/1", product(1, "Producto 1"))]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(captures)], "page_id long, url string, html string")
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    run(frame, [f"{SITE}/"], *paths, TS)
    assert rows(stored_rows(spark, paths[1]), "product_name", "original_price") == [("Producto 1", "3.00")]
    bad = extract(frame, [f"{SITE}/"]).filter("error is not null").count()
    assert stored_rows(spark, f"{paths[0]}-rejects", "parquet").count() == bad


def test_no_campaign_is_an_error(spark, tmp_path):
    frame = spark.createDataFrame([(1, f"{SITE}/", "<p>closed</p>")], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="no campaign"):
        run(frame, [f"{SITE}/"], str(tmp_path / "c"), str(tmp_path / "p"), TS)


def test_no_limits_by_default():
    assert (SiteProfile().max_campaigns, SiteProfile().max_subpages, SiteProfile().max_products) == (None, None, None)


def test_lost_run_adds_nothing_twice(spark, pages, tmp_path):
    """Products were stored, the campaign rows were not: run again."""
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    extracts = cut(extract(pages, [f"{SITE}/"]), "extracts")
    write_products(crawl_tables(extracts, TS)[1], paths[1])
    run(pages, [f"{SITE}/"], *paths, TS)
    assert stored_rows(spark, paths[1]).count() == 5
    assert stored_rows(spark, paths[0]).count() == 3


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored_rows(spark, path) is None
    assert visited_keys(spark, path).collect() == []
    row = spark.createDataFrame(
        [('a "b", c', 3, None, "x")], "brand_name string, total_products_count long, campaign_url string, other string"
    )
    assert conform(row, CAMPAIGN_COLUMNS).columns == list(CAMPAIGN_COLUMNS)
    write_campaigns(row, path)
    write_campaigns(row.withColumn("campaign_url", F.lit("u")), path)
    back = stored_rows(spark, path)
    assert back.columns == list(CAMPAIGN_COLUMNS) and back.count() == 2
    assert back.first().brand_name == 'a "b", c' and back.first().total_products_count == "3"
    assert visited_keys(spark, path, "no_such_column").collect() == []
    assert {r.campaign_url for r in visited_keys(spark, path).collect()} == {None, "u"}


def test_page_sources(spark, pages, tmp_path):
    for fmt in ("parquet", "json", "orc"):
        pages.write.format(fmt).save(str(tmp_path / fmt))
        assert rows(read_pages(spark, str(tmp_path / fmt), fmt), "url", "html") == rows(pages, "url", "html")
    folder = tmp_path / "html"
    folder.mkdir()
    for place in ("p", "q"):
        (folder / place).mkdir()
        (folder / place / "1+1 é.html").write_text(place, encoding="utf-8")
    (folder / "home.html").write_text("<p>a\nb</p>", encoding="utf-8")
    saved = read_pages(spark, str(folder), "html")
    assert rows(saved, "url", "html") == [("home", "<p>a\nb</p>"), ("p/1+1 é", "p"), ("q/1+1 é", "q")]
    named = read_pages(spark, str(folder), "html", lambda place: F.concat(F.lit(f"{SITE}/"), place))
    assert rows(named, "url")[0] == (f"{SITE}/home",)
    assert balanced(pages.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert balanced(pages.repartition(20)).rdd.getNumPartitions() == 20


def test_batch_equals_stream(spark, pages, tmp_path):
    source = str(tmp_path / "pages")
    unique = pages.filter("page_id < 10")
    for i in range(3):
        unique.filter(F.col("page_id") % 3 == i).write.mode("append").parquet(source)
    # The same pages once more: their URLs are known.
    unique.write.mode("append").parquet(source)
    streamed = lambda: stream_pages(spark, source, max_files=2)
    out, state = str(tmp_path / "links"), str(tmp_path / "s1")
    for _ in range(2):  # the second start finds nothing new
        stream_links(streamed(), out, state).awaitTermination()
        got = spark.read.parquet(out)
        assert rows(got, "url") == rows(extract_links(unique).select("url").distinct(), "url")
    out, state = str(tmp_path / "details"), str(tmp_path / "s2")
    stream_details(streamed().filter(F.col("url").contains("/p/")), out, state).awaitTermination()
    columns = ["url", "detail_name", "original_price", "discount_price", "sizes_status"]
    batch = extract_details(unique.filter(F.col("url").contains("/p/")))
    assert rows(spark.read.parquet(out), *columns) == rows(batch, *columns)


def test_hot_key_in_a_stream(spark, tmp_path):
    """A third of all rows share one key; each key comes out once."""
    source = str(tmp_path / "in")
    rows_in = spark.range(3000).selectExpr("id page_id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) url", "'' html")
    rows_in.repartition(6).write.parquet(source)
    out = str(tmp_path / "out")
    stream_table(stream_pages(spark, source, max_files=2), out, str(tmp_path / "s"), ["url"]).awaitTermination()
    assert rows(spark.read.parquet(out), "url") == rows(rows_in.select("url").distinct(), "url")


def test_lowest_capture_wins_in_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    many = spark.range(1, 41).selectExpr("41 - id page_id", "'u' url", "cast(id as string) html")
    many.repartition(5).write.parquet(source)
    go = lambda: stream_table(stream_pages(spark, source), out, str(tmp_path / "s"), ["url"]).awaitTermination()
    go()
    assert rows(spark.read.parquet(out), "page_id", "html") == [(1, "40")]
    many.withColumn("html", F.lit("later")).write.mode("append").parquet(source)
    go()
    assert rows(spark.read.parquet(out), "page_id", "html") == [(1, "40")]


def test_result_is_the_same_for_any_partitioning(spark, pages):
    seen = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        extracts = cut(extract(pages.repartition(n), [f"{SITE}/"]), "extracts")
        campaigns, products = crawl_tables(extracts, TS)
        seen.append((rows(campaigns, *CAMPAIGN_COLUMNS), rows(products, *PRODUCT_COLUMNS)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] == seen[2]


def test_pages_are_parsed_without_a_shuffle(pages):
    plan = extract(pages, [f"{SITE}/"])._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in after
    assert plan.count("MapInArrow") == 1
