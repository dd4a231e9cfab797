"""Plain tags are read without the standard tokenizer, and to the same trees."""

import random
from html.parser import HTMLParser

import pytest

from shelfmill.operators.tree import _Shredder

PIECES = (
    "<div>", "</div>", "<p class=' a  b '>", "</p >", "</P>", "<A HREF=\"/x?a=1&amp;b=2\">", "</a>", "<br>", "<br/>", "<img src=x>",
    "<i data-a data-b='1'>", "<b title=\"x > y\">", "<b title='a<b'>", "<u a=\"1\"b='2'>", "<s a = '1'>", "<q a='1' a='2'>", "</q x>", "</>", "</ p>",
    "<", ">", "a < b", "&amp;", "&am", "p;", "&", " text ", "ü €", "\x0b", "\x00", "<!DOCTYPE html>", "<!-- a > b -->", "<!-->", "<!--x--!>", "<!--",
    "<?pi x?>", "<![CDATA[ x ]]>", "<!x>", "<script>", "<script type=\"application/json\">{\"size\": \"<b>\", \"color\": \"&amp;\"}</script>", "</script>", "</SCRIPT >",
    "<style>p > a {}</style>", "<title>x <b> &lt; y</title>", "<title>", "<textarea><p></textarea>", "<plaintext>", "<noscript><p>x</p></noscript>",
    "<svg><path d='M0'/></svg>", "<x-y z:w.v=\"1\">", "<p\n\tid='1'\n>", "<p id='1'>", "<p id='1'", "<option selected>", "<template><b>t</b></template>",
)


class Standard(_Shredder):
    goahead = HTMLParser.goahead


def trees(kind, pages):
    reader = kind(frozenset(("size", "color")))
    for page in pages:
        reader.read(page)
    return [column.to_pylist() for column in reader.arrays()]


def test_same_trees_as_the_standard_tokenizer():
    draw = random.Random(7)
    pages = ["".join(draw.choices(PIECES, k=draw.randint(1, 14))) for _ in range(8000)]
    pages += [a + b for a in PIECES for b in PIECES] + [None, ""]
    fast, slow = trees(_Shredder, pages), trees(Standard, pages)
    for column, (a, b) in enumerate(zip(fast, slow)):
        assert [(pages[i], column, x, y) for i, (x, y) in enumerate(zip(a, b)) if x != y][:3] == []


def test_no_pages():
    assert trees(_Shredder, []) == [[], [], [], []]


def test_plain_tags_never_reach_the_standard_tokenizer(monkeypatch):
    def fail(self, i):
        pytest.fail("a plain tag went to the standard tokenizer")

    monkeypatch.setattr(HTMLParser, "parse_starttag", fail)
    monkeypatch.setattr(HTMLParser, "parse_endtag", fail)
    nodes = trees(_Shredder, ["<!DOCTYPE html><main><p class='a' hidden>x<b>y</b></p><a href=\"/1?a&amp;b\">z</a></main>"])[0][0]
    assert [n["tag"] for n in nodes] == ["#root", "main", "p", "#text", "b", "#text", "a", "#text"]
