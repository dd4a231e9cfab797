"""Selectors on the table of nodes against the same on a page's array."""

import pytest
from pyspark.sql import functions as F

from shelfmill.operators.nodes import marked, select_nodes
from shelfmill.operators.page import Page
from shelfmill.operators.tree import nodes
from shelfmill.rules import LINK, css_class, equals, has, tag

HTML = (
    "<nav><ul><li><a href='1'>x</a></li><li class='b c'><a>no</a></li></ul></nav><a href='2'>out</a>"
    "<article class='b'><nav><a href='3'>in both</a></nav><ul><li><b id='k'>t</b></li></ul></article><nav></nav><a href='4'>after</a>"
)


@pytest.mark.parametrize("sel", [
    LINK, LINK.under(tag("nav")), tag("li").under(tag("article")),
    has("id").under(css_class("b")), tag("a").under(css_class("c")), equals("id", "k").under(tag("nav")),
])
def test_as_on_the_array(trees, sel):
    tree = trees(HTML, "<p>none</p>", HTML.replace("nav", "div"))
    page = Page()
    found = page.with_spans((sel,), lambda spans: F.transform(page.select(page.nodes, sel, spans), lambda n: n["pre"]))
    expected = sorted((r.page_id, p) for r in tree.select("page_id", found.alias("f")).collect() for p in r.f)
    got = sorted((r.page_id, r.pre) for r in select_nodes(nodes(tree), sel).collect())
    assert got == expected


def test_three_levels(trees):
    found = select_nodes(nodes(trees(HTML)), LINK.under(tag("nav").under(tag("article")))).collect()
    assert [r.attrs["href"] for r in found] == ["3"]


def test_a_page_of_a_million_nodes(spark):
    """Every thousandth node is a `nav` over the next nine; every third node is a link."""
    place = F.col("id").cast("int")
    rows = spark.range(1_000_000).select(
        F.floor(F.col("id") / 1_000_000).alias("page_id"), place.alias("pre"),
        F.when(F.col("id") % 1000 == 0, place + 9).otherwise(place).alias("last"),
        F.when(F.col("id") % 1000 == 0, "nav").when(F.col("id") % 3 == 0, "a").otherwise("p").alias("tag"),
        F.create_map(F.lit("href"), F.lit("x")).alias("attrs"),
    )
    got = marked(rows, LINK.under(tag("nav")), "hit").filter("hit")
    expected = sum(1 for n in range(0, 1_000_000, 1000) for i in range(n + 1, n + 10) if i % 3 == 0)
    assert got.count() == expected
    plan = marked(marked(rows, LINK.under(tag("nav")), "one"), tag("p").under(tag("nav")), "two")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
