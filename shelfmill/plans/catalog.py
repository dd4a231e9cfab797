"""Named queries over the test tables, each an operator put to work."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.colors import color_from_name, color_from_phrase, is_bad_color
from ..functions.columns import let, strings
from ..functions.jsonwalk import walk_json
from ..functions.prices import (
    discount_label, discount_pct, format_price, normalize_price, price_candidates,
    price_pair, score_pair, source_bonus, to_float,
)
from ..functions.sizes import size_tokens, sorted_size_text, stock_status
from ..functions.sql import register
from ..functions.text import clean_text, end_date_text, few_words, word_count
from ..functions.urls import (
    is_blocked_url, is_campaign_url, is_http, is_listing_url, is_product_url, is_site_url, page_kinds,
    resolve_url, same_url_key, url_host, url_id,
)
from ..operators.cards import labels_text, listing_plan, page_links
from ..operators.detail import detail_name
from ..operators.nodes import marked
from ..operators.page import Page, matches
from ..operators.tables import (
    best_pair, first_label, first_per_key, found_and_skipped, frontier, limit_per_key,
    listed_and_distinct, shortest_text, strongest_status, unseen, with_position,
)
from ..operators.tree import nodes, shred
from ..rules import LINK, SiteProfile, css_class, equals, has, part, tag
from ..session import configure, cut, shared_folder
from ..sources import rendered
from ..sources.page_store import PageStore
from ..sources.pages import balanced, read_pages, stream_pages
from ..sources.tables import CAMPAIGN_COLUMNS, PRODUCT_COLUMNS, conform, run_timestamp, stored_rows, visited_keys
from ..streaming.extract import stream_links
from .crawl import (
    PARTS, crawl_tables, extract, extract_campaigns, extract_chosen, extract_details, extract_links,
    extract_products, extract_subpages, product_details, run,
)
from .sql_pages import register_pages

Query = Callable[[SparkSession, str], DataFrame]

# The test pages lie on example hosts, with the language as first folder.
TEST_SITE = SiteProfile(
    base_url="https://site.example.com",
    domain="example",
    blocked_parts=("/es/1", "#top", "?print"),
    campaign_parts=("/en/", "/de/"),
    listing_parts=("/de/", "/es/", "?page="),
    product_parts=("/fr/", "/en/1"),
)
RUN_TS = "2024-05-01 12:00:00"

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(configure(spark), sf)

    _REGISTRY[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return balanced(read_pages(spark, f"{sf}/pages.parquet"))


def _product_pages(spark: SparkSession, sf: str) -> DataFrame:
    return rendered.product_pages(balanced(_table(spark, sf, "part")))


def _shop_pages(spark: SparkSession, sf: str) -> DataFrame:
    return rendered.shop_pages(balanced(_table(spark, sf, "supplier")))


# -- sources and sinks -------------------------------------------------
@query
def page_source(spark, sf):
    """S1"""
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", "url", F.length("html").alias("html_chars")
    )


@query
def stored_keys(spark, sf):
    """S6"""
    return visited_keys(spark, f"{sf}/orders.parquet", "o_custkey", "parquet")


@query
def conformed_products(spark, sf):
    """S5, S7"""
    part_rows = _table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        format_price("p_retailprice").alias("original_price"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("color"),
        F.col("p_size").alias("unknown_field"),
        run_timestamp(RUN_TS).alias("extraction_timestamp"),
    )
    return conform(part_rows, PRODUCT_COLUMNS)


@query
def streamed_links(spark, sf):
    """S2, ST1: the first link to each target, read as a stream to a table."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    stream = stream_pages(spark, f"{sf}/pages*.parquet")
    stream_links(stream, f"{base}/rows", f"{base}/state", TEST_SITE).awaitTermination()
    return spark.read.parquet(f"{base}/rows").select("url", "page_id", "pos", "label")


# -- trees and selections ----------------------------------------------
@query
def node_counts(spark, sf):
    """D1"""
    flat = nodes(shred(_pages(spark, sf)))
    count = lambda t: F.count_if(F.col("tag") == t).cast("long").alias(f"n_{t}")
    return flat.groupBy("page_id").agg(*[count(t) for t in ("a", "li", "h1", "p", "br", "script")])


@query
def node_texts(spark, sf):
    """Text of the navigation block."""
    page = Page()
    nav = page.find(F.col("nodes"), tag("nav"))
    return shred(_pages(spark, sf)).select(
        "page_id", let(nav, page.text).alias("nav_text")
    )


@query
def node_attributes(spark, sf):
    """D3"""
    page = Page()
    top = page.find(F.col("nodes"), tag("html"))
    value = lambda name: let(top, lambda n: page.attr(n, name)).alias(name)
    return shred(_pages(spark, sf)).select("page_id", value("lang"), value("dir"))


@query
def selector_counts(spark, sf):
    """D4"""
    count = lambda sel, name: F.size(F.filter("nodes", lambda n: matches(n, sel))).alias(name)
    return shred(_pages(spark, sf)).select(
        "page_id",
        count(has("charset", "meta"), "with_charset"),
        count(css_class("ad"), "class_ad"),
        count(part("class", "a"), "class_part"),
        count(part("href", "th", "a"), "href_th"),
        count(equals("lang", "en", "html"), "english"),
    )


@query
def nav_links(spark, sf):
    """Links inside the navigation, and list items inside articles."""
    page = Page()
    inside = LINK.under(tag("nav"))
    item = tag("li").under(tag("article"))
    found = page.with_spans(
        (inside, item),
        lambda spans: F.struct(
            F.size(page.select(page.nodes, inside, spans)).alias("nav_links"),
            F.size(page.select(page.nodes, item, spans)).alias("article_items"),
        ),
    )
    return shred(_pages(spark, sf)).select("page_id", found.alias("f")).select("page_id", "f.*")


@query
def nav_link_nodes(spark, sf):
    """The same selections on the table of nodes."""
    pages = _pages(spark, sf)
    flat = marked(nodes(shred(pages)), LINK.under(tag("nav")), "link")
    flat = marked(flat, tag("li").under(tag("article")), "item")
    counts = flat.groupBy("page_id").agg(F.count_if("link").alias("link"), F.count_if("item").alias("item"))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    return pages.select("page_id").join(counts, "page_id", "left").select(
        "page_id", count("link").alias("nav_links"), count("item").alias("article_items")
    )


@query
def ranked_matches(spark, sf):
    """D7, E1s: each node once, at its first selector."""
    sels = (part("class", "ad"), tag("h1"), LINK, tag("div"), tag("footer"))
    tree = shred(_pages(spark, sf))
    rows = tree.select("page_id", F.posexplode(Page().all_matches(sels)).alias("pos", "m"))
    return rows.select("page_id", "pos", F.col("m.rank").alias("sel_rank"), F.col("m.tag").alias("tag"))


@query
def card_anchors(spark, sf):
    """Each list item's anchor."""
    page = Page()
    items = page.select(page.nodes, tag("li"))
    hrefs = let(
        page.links(),
        lambda links: F.transform(
            items, lambda li: let(page.anchor(links, li), lambda a: page.attr(a, "href"))
        ),
    )
    return shred(_pages(spark, sf)).select("page_id", F.posexplode(hrefs).alias("pos", "href"))


# -- URLs --------------------------------------------------------------
@query
def links(spark, sf):
    """The flagship: every link of every page, resolved and named."""
    found = extract_links(_pages(spark, sf), TEST_SITE)
    return found.select("page_id", "pos", "url", "label")


def _link_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Each form of link, made from the URL of each page."""
    path = F.regexp_extract("url", r"^https?://[^/]+(/[^#]*)", 1)
    forms = F.array(
        F.col("url"), path, F.concat(F.lit("//cdn.example.com"), path), F.regexp_replace(path, "^/", ""),
        F.concat(F.lit("?id="), F.col("page_id").cast("string")), F.lit("#top"), F.lit(""),
        F.concat(F.lit("/a/b/../"), F.regexp_replace(path, "^/", "")), F.lit("mailto:x@example.com"),
        F.concat(F.lit("./x/./"), F.regexp_replace(path, "^/", "")),
    )
    return read_pages(spark, f"{sf}/pages.parquet").select("page_id", F.posexplode(forms).alias("form", "href"))


@query
def resolved_urls(spark, sf):
    """U1 on each form of link."""
    return _link_forms(spark, sf).select("page_id", "form", resolve_url("href", TEST_SITE.base_url).alias("url"))


@query
def url_kinds(spark, sf):
    """U2, U4-U7"""
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id",
        is_site_url("url", "example.com").alias("on_site"),
        is_campaign_url("url", TEST_SITE).alias("campaign"),
        is_listing_url("url", TEST_SITE).alias("listing"),
        is_product_url("url", TEST_SITE).alias("product"),
        F.array_join(page_kinds("url", TEST_SITE), ",").alias("kinds"),
    )


@query
def blocked_urls(spark, sf):
    """U3, with the shop's own rules"""
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", is_blocked_url("url").alias("blocked"),
        is_blocked_url(F.concat("url", F.lit("/Help"))).alias("blocked_help"),
    )


@query
def url_ids(spark, sf):
    """U8"""
    shop = F.regexp_replace("url", r"/(en|de|fr|es)/", "/catalog/item-")
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", url_id("url").alias("id"), url_id(shop).alias("segment_id")
    )


@query
def url_forms(spark, sf):
    """U9, U10"""
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", is_http(F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("ftp:"), "url"))).alias("http"),
        same_url_key(F.concat("url", F.lit("//"))).alias("same_as"), url_host("url").alias("host"),
    )


@query
def sql_urls(spark, sf):
    """U4-U6, U8, U10 called from SQL."""
    register(spark, TEST_SITE)
    return spark.sql(
        """SELECT page_id, is_campaign_url(url) AS campaign, is_listing_url(url) AS listing,
                  is_product_url(url) AS product, url_id(url) AS id, url_host(url) AS host FROM {pages}""",
        pages=read_pages(spark, f"{sf}/pages.parquet"),
    )


# -- text and prices ---------------------------------------------------
@query
def sql_texts(spark, sf):
    """T1, T3, T4, T7 called from SQL."""
    register(spark)
    return spark.sql(
        """SELECT p_partkey, clean_text(concat('  ', p_name, ' ')) AS clean, word_count(p_name) AS words,
                  discount_label(concat(p_name, ' -', p_partkey % 130, ' % y -15%')) AS label,
                  normalize_price(concat('€ ', p_size, ' , 50')) AS price FROM {part}""",
        part=_table(spark, sf, "part"),
    )


@query
def sql_resolved(spark, sf):
    """U1 called from SQL."""
    register(spark, TEST_SITE)
    return spark.sql(
        "SELECT page_id, form, resolve_url(href) AS url FROM {forms}", forms=_link_forms(spark, sf)
    )


@query
def sql_links(spark, sf):
    """Pages read and their links taken from SQL."""
    register_pages(spark, TEST_SITE)
    return spark.sql(
        """SELECT page_id, k.pos, k.url, k.label
           FROM (SELECT page_id, explode(found) AS k
                 FROM (SELECT page_id, links_of(page_tree(html)) AS found FROM {pages}))""",
        pages=_pages(spark, sf),
    )


@query
def sql_prices(spark, sf):
    """T8, T9, T10 called from SQL."""
    register(spark, TEST_SITE)
    return spark.sql(
        """SELECT doc_id, size(p) AS n_prices, pair.original, pair.current,
                  array_join(transform(p, x -> format_string('%.2f', x)), ' ') AS prices
           FROM (SELECT doc_id, p, price_pair(p) AS pair
                 FROM (SELECT doc_id, price_candidates(text) AS p FROM {docs}))""",
        docs=balanced(_table(spark, sf, "documents").select("doc_id", "text")),
    )


@query
def sql_sizes(spark, sf):
    """T12 called from SQL."""
    register(spark, TEST_SITE)
    return spark.sql(
        """SELECT p_partkey, array_join(size_tokens(concat(
                      p_name, ' talla ', p_size, CASE WHEN p_partkey % 3 = 0 THEN ' XL o m' ELSE ' y 40 (EU)' END
                  )), ' ') AS sizes FROM {part}""",
        part=_table(spark, sf, "part"),
    )


@query
def sql_colors(spark, sf):
    """T14, T15 called from SQL."""
    register(spark, TEST_SITE)
    return spark.sql(
        """SELECT p_partkey, color_from_name(concat(
                      replace(p_name, ' ', ' - '), CASE WHEN p_partkey % 5 = 0 THEN ' - talla' ELSE '' END
                  )) AS color, is_bad_color(p_brand) AS bad_brand,
                  is_bad_color(cast(p_size AS string)) AS bad_size FROM {part}""",
        part=_table(spark, sf, "part"),
    )


@query
def clean_documents(spark, sf):
    """T1"""
    return balanced(_table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", clean_text("text").alias("clean"))


@query
def word_counts(spark, sf):
    """T3"""
    return _table(spark, sf, "part").select(
        "p_partkey", word_count("p_name").alias("words"),
        few_words(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("few"),
    )


@query
def end_dates(spark, sf):
    """T2"""
    lead = F.element_at(
        strings(("Acaba en", "TERMINA EN", "finaliza en", "Hasta", "Ends in", "Desde")),
        (F.col("p_partkey") % 6 + 1).cast("int"),
    )
    text = F.concat_ws(" ", F.lit("Outlet"), lead, F.lit(" el"), "p_size", F.lit("| hasta"), "p_name")
    return _table(spark, sf, "part").select("p_partkey", end_date_text(text).alias("end_date"))


@query
def discount_texts(spark, sf):
    """T4"""
    text = F.concat(
        "p_name", F.lit(" -"), (F.col("p_partkey") % 130).cast("string"), F.lit(" % y -15%")
    )
    return _table(spark, sf, "part").select("p_partkey", discount_label(text).alias("label"))


@query
def float_texts(spark, sf):
    """T5"""
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return _table(spark, sf, "part").select("p_partkey", to_float(text).alias("number"))


@query
def discount_labels(spark, sf):
    """Labels from a price and its discounted price."""
    now = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        format_price("l_extendedprice").alias("original_price"),
        discount_pct("l_extendedprice", now).alias("discount_percentage"),
    )


@query
def normalized_prices(spark, sf):
    """T7 on each way to write a price."""
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    whole, rest = F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    big = F.regexp_replace(whole, r"(\d)(\d{3})$", "$1.$2")
    forms = F.array(
        F.concat(big, F.lit(","), rest, F.lit(" €")),
        F.concat(whole, F.lit(" "), rest),
        F.concat(F.replace(big, F.lit("."), F.lit(",")), F.lit(" . "), rest),
        F.concat(F.lit("€ "), whole, F.lit(" , "), rest),
        F.concat(F.lit("-"), whole),
        F.concat(whole, F.lit("-"), rest),
        F.concat(F.lit("9"), whole, F.lit("0.00")),
        F.col("p_name"),
    )
    rows = _table(spark, sf, "part").select("p_partkey", F.posexplode(forms).alias("form", "raw"))
    return rows.select("p_partkey", "form", normalize_price("raw").alias("price"))


@query
def doc_prices(spark, sf):
    """T8, T9, T10 on the documents' whole texts."""
    found = balanced(_table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", price_candidates("text").alias("p"))
    pair = price_pair("p")
    return found.select(
        "doc_id", F.size("p").alias("n_prices"),
        F.array_join(F.transform("p", format_price), " ").alias("prices"),
        pair["original"].alias("original"), pair["current"].alias("current"),
    )


_SOURCES = ("json", "meta", "local_node", "local_text", "page", "other", "json")


def _priced_lines(spark: SparkSession, sf: str) -> DataFrame:
    now = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 10) / 100
    was = F.floor(F.col("l_extendedprice") * 10) / 100
    label = F.concat(F.lit("-"), (F.col("l_quantity") % 12).cast("int").cast("string"), F.lit("%"))
    return balanced(_table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "R", was).alias("original"), now.alias("current"),
        F.when(F.col("l_linestatus") == "F", label).otherwise("").alias("discount"),
        F.get(strings(_SOURCES), F.col("l_linenumber") - 1).alias("source"),
    )


@query
def price_scores(spark, sf):
    """C12, C13"""
    return _priced_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", source_bonus("source").alias("bonus"),
        score_pair("original", "current", "discount", "source").alias("score"),
    )


@query
def best_pairs(spark, sf):
    """A4: best pair per order, the first line on a tie."""
    ord_ = ["l_linenumber", "l_partkey", "l_suppkey"]
    return best_pair(_priced_lines(spark, sf), ["l_orderkey"], ord_)


# -- sizes and colours -------------------------------------------------
@query
def part_sizes(spark, sf):
    """Bare numbers, letters and region sizes."""
    text = F.concat(
        F.col("p_name"), F.lit(" talla "), F.col("p_size").cast("string"),
        F.when(F.col("p_partkey") % 3 == 0, " XL o m").otherwise(" y 40 (EU)"),
    )
    return _table(spark, sf, "part").select(
        "p_partkey", F.array_join(size_tokens(text), " ").alias("sizes")
    )


@query
def stock_states(spark, sf):
    """T13"""
    key = F.col("p_partkey")
    words = F.element_at(
        strings(("", "Agotado", "Última unidad", "quedan pocas", "Sold", "casi agotado", "low stock")),
        (key % 7 + 1).cast("int"),
    )
    attrs = F.create_map(
        F.lit("class"), F.when(key % 2 == 0, "x hczgyp").otherwise("sold out"), F.lit("title"), words
    )
    name = F.when(key % 3 == 0, "li").otherwise("option")
    status = stock_status(F.col("p_name"), attrs, name, F.lit(""))
    return _table(spark, sf, "part").select("p_partkey", status.alias("status"))


@query
def part_colors(spark, sf):
    """T14, T15"""
    dashed = F.replace("p_name", F.lit(" "), F.lit(" - "))
    last = F.when(F.col("p_partkey") % 5 == 0, F.concat(dashed, F.lit(" - talla"))).otherwise(dashed)
    return _table(spark, sf, "part").select(
        "p_partkey", color_from_name(last).alias("color"), is_bad_color("p_brand").alias("bad_brand"),
        is_bad_color(F.col("p_size").cast("string")).alias("bad_size"),
    )


@query
def color_phrases(spark, sf):
    """T16"""
    text = F.concat(F.col("p_type"), F.lit(", Color: "), "p_name", F.lit("; "), "p_brand")
    return _table(spark, sf, "part").select(
        "p_partkey", color_from_phrase(text).alias("color"), color_from_phrase("p_name").alias("none")
    )


@query
def size_status(spark, sf):
    """A5: strongest state per brand and size."""
    state = F.element_at(strings(("OK", "ALMOST", "LAST", "OUT")), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = _table(spark, sf, "part").select("p_brand", "p_size", state.alias("status"))
    return strongest_status(rows, ["p_brand", "p_size"])


@query
def size_texts(spark, sf):
    """Numbers first, then letters."""
    one = lambda size, status: F.struct(size.alias("size"), F.lit(status).alias("status"))
    number = lambda add: (F.col("p_size") + add).cast("string")
    sizes = F.array(
        one(F.lit("XL"), "OK"), one(number(60), "OUT"), one(number(0), "LAST"), one(F.lit("M"), "OK")
    )
    return _table(spark, sf, "part").select("p_partkey", sorted_size_text(sizes).alias("sizes"))


@query
def shortest_names(spark, sf):
    """A7"""
    return shortest_text(_table(spark, sf, "part"), ["p_brand"], "p_name")


# -- JSON --------------------------------------------------------------
@query
def json_walk(spark, sf):
    """Every object of the event properties, at any depth."""
    wrapped = F.concat(F.lit('[{"id": '), F.col("event_id").cast("string"), F.lit(', "in": '), "props", F.lit("}]"))
    walked = balanced(_table(spark, sf, "events")).select("event_id", F.inline(walk_json(wrapped)))
    rows = walked.select("event_id", "obj", F.posexplode("members").alias("pos", "m"))
    scalar = rows.filter("m.kind != 'nested'")
    return scalar.select(
        "event_id", "obj", "pos", F.col("m.key").alias("key"), F.col("m.value").alias("value")
    )


# -- rows: firsts, limits, joins, counts -------------------------------
@query
def first_link_per_url(spark, sf):
    """W1"""
    found = extract_links(_pages(spark, sf), TEST_SITE)
    first = first_per_key(found, ["url"], ["page_id", "pos"])
    return first.select("url", "page_id", "pos", "label")


@query
def first_link_labels(spark, sf):
    """C26"""
    found = extract_links(_pages(spark, sf), TEST_SITE)
    return first_label(found, ["url"], "label", ["page_id", "pos"])


@query
def link_counts(spark, sf):
    """A1, A2: per host, links counted once per page, and distinct links."""
    tree = shred(_pages(spark, sf), profile=TEST_SITE)
    found = tree.select("page_id", url_host("url").alias("host"), F.explode(page_links(TEST_SITE)).alias("k"))
    hits = found.select("page_id", "host", F.col("k.url").alias("link"))
    return listed_and_distinct(hits, ["host"], "page_id", "link")


def _link_lists(spark: SparkSession, sf: str) -> DataFrame:
    tree = shred(_pages(spark, sf).select("page_id", "html"), profile=TEST_SITE)
    pair = lambda k: F.struct(k["url"].alias("url"), k["label"].alias("label"))
    return tree.select("page_id", F.transform(page_links(TEST_SITE), pair).alias("pairs"))


@query
def page_labels(spark, sf):
    """A3"""
    return _link_lists(spark, sf).select("page_id", labels_text("pairs").alias("labels"))


@query
def listing_plans(spark, sf):
    """Four listings, and the page's own in front if missing."""
    own = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://site.example.com/p"), "page_id")).otherwise(
        F.concat(F.get("pairs", F.lit(1))["url"], F.lit("/"))
    )
    plan = listing_plan("pairs", F.coalesce(own, F.lit("https://site.example.com")), 4)
    rows = _link_lists(spark, sf).select("page_id", F.posexplode(plan).alias("pos", "p"))
    return rows.select("page_id", "pos", "p.url", "p.label")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "orders")


@query
def unseen_orders(spark, sf):
    """X1, E3s: orders of customers without a filled order."""
    done = _orders(spark, sf).filter("o_orderstatus = 'F'")
    return unseen(_orders(spark, sf), done, "o_custkey").select("o_orderkey", "o_custkey")


@query
def order_frontier(spark, sf):
    """First 50 orders that are not done; the last test uses up the limit."""
    done = _orders(spark, sf).filter("o_orderstatus = 'F'")
    urgent = ~F.col("o_orderpriority").startswith("5")
    chosen = frontier(_orders(spark, sf), done, "o_orderkey", ["o_orderdate", "o_orderkey"], 50, urgent)
    return chosen.select("o_orderkey", "o_orderpriority")


@query
def every_order(spark, sf):
    """Duplicates allowed."""
    done = _orders(spark, sf)
    return unseen(_orders(spark, sf), done, "o_orderkey", True).select("o_orderkey")


@query
def orders_with_customers(spark, sf):
    """X2"""
    buyers = _table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return _orders(spark, sf).join(buyers, "o_custkey").select("o_orderkey", "o_custkey", "c_name")


@query
def limit_per_parent(spark, sf):
    """W2, L3"""
    return limit_per_key(
        _orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3, "position"
    ).select("o_custkey", "o_orderkey", "position")


@query
def event_positions(spark, sf):
    """Position of every event in its type."""
    events = _table(spark, sf, "events").select("event_type", "ts", "event_id")
    return with_position(events, ["event_type"], ["ts", "event_id"]).select(
        "event_type", "event_id", "position"
    )


@query
def run_counters(spark, sf):
    """A9"""
    done = _orders(spark, sf).filter("o_orderstatus = 'F'").select("o_orderkey")
    return found_and_skipped(_orders(spark, sf), done, "o_orderkey")


@query
def appended_orders(spark, sf):
    """E2s: union of two sources in order, repeats kept."""
    open_ = _orders(spark, sf).filter("o_orderstatus = 'O'").select("o_orderkey", F.lit(0).alias("src"))
    big = _orders(spark, sf).filter("o_totalprice > 200000").select("o_orderkey", F.lit(1).alias("src"))
    return open_.unionByName(big)


# -- whole pages -------------------------------------------------------
@query
def page_names(spark, sf):
    """C8, D6"""
    return shred(_pages(spark, sf)).select("page_id", detail_name().alias("name"))


@query
def shop_details(spark, sf):
    """Whole product pages."""
    pages = _product_pages(spark, sf)
    stubs = _table(spark, sf, "part").select(
        F.concat(F.lit(f"{rendered.SITE}/p/"), F.col("p_partkey").cast("string")).alias("product_url"),
        F.lit("stub").alias("product_name"),
    )
    return product_details(extract_details(pages), stubs)


@query
def shop_campaigns(spark, sf):
    """Campaign cards of the home pages, or their links where they have none."""
    pages = _shop_pages(spark, sf).filter(rendered.is_home())
    return extract_campaigns(pages).select("page_id", "pos", "name", "url", "end_date")


@query
def shop_subpages(spark, sf):
    """C6"""
    campaign = F.col("url").rlike(r"/catalog/\d+$")
    return extract_subpages(_shop_pages(spark, sf).filter(campaign))


@query
def shop_listings(spark, sf):
    """C3, C7"""
    listing = F.col("url").contains("/catalog/")
    return extract_products(_shop_pages(spark, sf).filter(listing)).select(
        "url", "pos", "product_url", "product_name"
    )


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return rendered.corpus(balanced(_table(spark, sf, "part")), balanced(_table(spark, sf, "supplier")))


@query
def crawl_campaigns(spark, sf):
    """Campaign rows of a whole run; they need no product page."""
    found = extract(_corpus(spark, sf), rendered.is_home(), parts=PARTS[:3])
    return crawl_tables(cut(found, "extracts"), RUN_TS)[0]


@query
def crawl_products(spark, sf):
    """Product rows of a whole run, each stage's pages chosen by the one before."""
    return crawl_tables(extract_chosen(_corpus(spark, sf), rendered.is_home()), RUN_TS)[1]


def _crawl_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/crawl-{uuid.uuid4().hex}"


def _runs(spark: SparkSession, sf: str, *captured: DataFrame) -> str:
    """Folder of the tables after runs over these pages, one after another."""
    base = _crawl_folder(spark)
    for pages in captured:
        run(pages, rendered.is_home(), f"{base}/campaigns", f"{base}/products", RUN_TS, fmt="parquet")
    return base


def _listing_runs(spark: SparkSession, sf: str) -> tuple[str, list[dict[str, int]]]:
    """Folder and counters of two runs that take no product: the first without
    every second listing `/b`, the second without every tenth."""
    base, pages = _crawl_folder(spark), _shop_pages(spark, sf)
    found = [
        run(
            pages.filter(~F.col("url").rlike(late)), rendered.is_home(), f"{base}/campaigns", f"{base}/products", RUN_TS,
            SiteProfile(max_products=0), "parquet",
        )
        for late in ("[02468]/b$", "0/b$")
    ]
    return base, found


def _early(pages: DataFrame) -> DataFrame:
    """Without every third product page and every second listing `/b`."""
    late = F.col("url").rlike(r"/p/\d+$") & (F.substring_index("url", "/", -1).cast("long") % 3 == 0)
    later = F.col("url").rlike(r"[02468]/b$")
    return pages.filter(~(late | later))


@query
def pages_by_url(spark, sf):
    """Names on the pages that ordered parts point at, from a store laid out by URL and filled in two batches."""
    store, pages = PageStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", 8), _product_pages(spark, sf)
    for odd in (0, 1):
        store.add(pages.filter(F.col("page_id") % 2 == odd))
    ordered = _table(spark, sf, "lineitem").filter("l_quantity >= 45").select(
        F.concat(F.lit(f"{rendered.SITE}/p/"), F.col("l_partkey").cast("string")).alias("url")
    )
    return shred(store.choose(ordered.distinct())).select("page_id", "url", detail_name().alias("name"))


@query
def crawl_pending(spark, sf):
    """Products that a run left open because their page was not there."""
    base = _runs(spark, sf, _early(_corpus(spark, sf)))
    return stored_rows(spark, f"{base}/campaigns-pending/products", "parquet").select(
        "campaign_url", "page_pos", "pos", "product_url", "product_name", "subcategory"
    )


@query
def crawl_resume(spark, sf):
    """S4, S6, E4s: what a first run left open, a second one appends; read back."""
    pages = _corpus(spark, sf)
    base = _runs(spark, sf, _early(pages), pages)
    return stored_rows(spark, f"{base}/products", "parquet").select(*PRODUCT_COLUMNS)


@query
def crawl_counts_resumed(spark, sf):
    """Campaigns read back after a second run brought open listings."""
    base, _ = _listing_runs(spark, sf)
    return stored_rows(spark, f"{base}/campaigns", "parquet").select(*CAMPAIGN_COLUMNS)


@query
def crawl_counters(spark, sf):
    """What each of two runs reports."""
    _, found = _listing_runs(spark, sf)
    names = ("found", "skipped", "new", "campaigns", "corrected", "open_listings")
    rows = [(i + 1, name, counters[name]) for i, counters in enumerate(found) for name in names]
    return spark.createDataFrame(rows, "run int, counter string, value long")


@query
def crawl_visited(spark, sf):
    """Keys of stored campaigns, from the files of the key table alone."""
    base, _ = _listing_runs(spark, sf)
    return visited_keys(spark, f"{base}/campaigns")
