"""Marks set while a page is read are what the selectors give on its nodes."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfmill.operators.detail import detail_name
from shelfmill.operators.page import Page, marked_any, matches
from shelfmill.rules import DEFAULT_PROFILE, MARK_BITS, Sel, SiteProfile, css_class, equals, has, part, tag

PLAIN = (
    tag("h1"), has("data-x"), has("alt", "img"), equals("role", "option"), equals("name", "description", "meta"),
    part("class", "name"), part("class", "Ärger"), part("class", ""), css_class("two"), css_class(""),
)
HTML = """<html><body><main class="Product name two"><h1 class="two  three">A</h1><h1>B</h1>text<!-- c -->
<img alt src="x"><img data-x="" class="one two"><p data-x class="rename">x</p><div class="">y</div><div class>z</div>
<ul role="listbox"><li role="option" class="Ärgernis">1</li><li role="options">2</li></ul>
<meta name="description" content="d"><p name="description" class="two\tthree">q</p></main></body></html>"""


def _check(trees, profile, sels):
    tree = trees(HTML, "", "<p>" + HTML * 3, "plain text", profile=profile)
    flat = tree.select(F.explode("nodes").alias("n"))
    n = F.col("n")
    pairs = [F.count_if(marked_any(n, [s], profile.marks) != matches(n, Sel(s.tag, s.attr, s.how, s.value))).alias(f"d{i}") for i, s in enumerate(sels)]
    hits = [F.count_if(marked_any(n, [s], profile.marks)).alias(f"h{i}") for i, s in enumerate(sels)]
    row = flat.select(*pairs, *hits).first()
    assert [row[f"d{i}"] for i in range(len(sels))] == [0] * len(sels)
    return [row[f"h{i}"] for i in range(len(sels))]


def test_marks_are_the_selectors(trees):
    hits = _check(trees, SiteProfile(detail_name=PLAIN), PLAIN)
    assert all(hits)
    _check(trees, DEFAULT_PROFILE, DEFAULT_PROFILE.marks.sels)


def test_selectors_beyond_the_bits_are_evaluated(trees):
    many = tuple(part("class", f"c{i}") for i in range(MARK_BITS + 20)) + (part("class", "rename"),)
    profile = SiteProfile(detail_name=many)
    assert len(profile.marks.sels) == MARK_BITS and profile.marks.mask([many[-1]]) is None
    assert trees(HTML, profile=profile).select(detail_name(profile).alias("v")).first().v == "x"


def test_outer_selectors_still_count(trees):
    inner = tag("li").under(equals("role", "listbox"))
    profile = SiteProfile(detail_name=(inner, tag("h1").under(tag("nav")), tag("h1")))
    page = Page(profile)
    found = trees(HTML, profile=profile).select(F.transform(page.all_matches(profile.detail_name), lambda m: m["rank"]).alias("v")).first().v
    assert found == [0, 0, 2, 2]


def test_a_tree_marked_for_other_selectors_is_refused(trees):
    with pytest.raises(AnalysisException):
        trees(HTML).select(detail_name(SiteProfile(detail_name=(tag("h2"),)))).collect()
