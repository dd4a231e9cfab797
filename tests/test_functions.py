"""Scalar functions against answers worked out by hand."""

import pytest
from pyspark.sql import functions as F

from shelfmill import SiteProfile
from shelfmill.functions.colors import color_from_name, color_from_phrase, is_bad_color
from shelfmill.functions.prices import (
    discount_label, discount_pct, format_price, normalize_price, price_candidates, price_pair,
    score_pair, to_float,
)
from shelfmill.functions.sizes import size_tokens, sorted_size_text, stock_status
from shelfmill.functions.text import clean_text, end_date_text, few_words, word_count
from shelfmill.functions.urls import (
    is_blocked_url, is_campaign_url, is_http, is_listing_url, is_product_url, is_site_url,
    page_kinds, resolve_url, same_url_key, url_id,
)

STRICT = SiteProfile(strict_fix=True)


def check(values, fn, cases):
    texts = list(cases)
    assert dict(zip(texts, values(texts, fn))) == cases


def test_clean_text(values):
    check(values, clean_text, {
        "  a   b\n": "a b", None: "", "": "", "a  b\x1cc\x1f": "a b c", "\t\r\n": "",
        "x": "x", "　ä\u0085ö ": "ä ö",
    })
    twice = lambda c: clean_text(clean_text(c))
    texts = ["  a   b\n", " x  ", "a\x1d b"]
    assert values(texts, twice) == values(texts, clean_text)


def test_words(values):
    assert values(["", "a", "a b c", "a b c d"], word_count) == [0, 1, 3, 4]
    assert values(["a b c", "a b c d"], few_words) == [True, False]


def test_end_date(values):
    check(values, end_date_text, {
        "Outlet Acaba en 2 días | nuevo": "acaba en 2 días", "Hasta -70%": "hasta -70%",
        "Hasta hoy, acaba en 3 h": "acaba en 3 h", "ENDS IN  5 days": "ends in 5 days",
        "acaba en|x": "", "mañana": "", None: "",
    })


def test_discount_label(values):
    check(values, discount_label, {
        "Ahora - 30 % hoy": "-30%", "-05%": "-5%", "-0% -20%": "", "-99%": "", "-100%": "",
        "30%": "", None: "", "a-95%b": "-95%", "-96% -10%": "",
    })


def test_normalize_price(values):
    check(values, normalize_price, {
        "1.299,99 €": 1299.99, "1,299.99": 1299.99, "18 99": 18.99, "18,9": 18.9, "1.299": 1.3,
        "-20": None, "12-15": None, "10001": None, "0": None, "10000": 10000.0, "": None, None: None,
        "€ 12 , 50": 12.5, "1.234.567,89": None, "1.2.3,4": 123.4, "abc": None, "5.": 5.0,
        "1,234,5": 1234.5, "9.999.99": 9999.99, "12 34 56": None, "True": None,
    })
    shown = lambda c: format_price(normalize_price(format_price(normalize_price(c))))
    assert values(["1.299,99 €", "18 99"], shown) == ["1299.99", "18.99"]


def test_price_candidates(values):
    check(values, price_candidates, {
        "1.299,99 €": [299.99], "29,99 € 59,99 €": [59.99, 29.99], "€ 20,00 10,00 €": [20.0, 10.0, 0.1],
        "59,99 29,99 €": [29.99, 59.99, 99.29], "59,99 € -50% 29,99 €": [59.99, 29.99],
        "talla 40 42": [40.42], "12.05.2024": [12.05], "": [], None: [], "a1,99b": [],
    })
    strict = lambda c: price_candidates(c, STRICT)
    assert values(["1.299,99 €"], strict)[0][0] == 1299.99


def test_price_pair(values):
    pair = lambda c: price_pair(price_candidates(c))
    assert values(["29,99 € 59,99 €", "9,99 €", "none"], pair) == [(59.99, 29.99), (None, 9.99), None]


def test_format_and_cast(spark, values):
    assert values(["1.5", "x", None], to_float) == [1.5, None, None]
    texts = ["1d", "2f", "1_000", "_1", "1__0", " 7 ", "1e3", ".5", "5.", ".", "-2.5", "0x1p3", "", "1L"]

    def standard(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert values(texts, to_float) == [standard(t) for t in texts]
    as_price = lambda c: format_price(F.col(c).try_cast("double"))
    assert values(["1234567.5", None, "0.005"], as_price)[:2] == ["1234567.50", ""]


@pytest.mark.parametrize("o, c, label", [
    (59.99, 29.99, "-50%"), (10.0, 10.0, ""), (200.0, 197.0, "-2%"), (8.0, 7.0, "-12%"), (8.0, 5.0, "-38%"), (100.0, 1.0, ""),
])
def test_discount_pct(spark, o, c, label):
    row = spark.range(1).select(discount_pct(F.lit(o), F.lit(c)).alias("v")).first()
    assert row.v == label


@pytest.mark.parametrize("o, c, d, source, score", [
    (59.99, 29.99, "-50%", "json", 135), (None, 29.99, "-50%", "meta", 55), (59.99, 29.99, "-48%", "page", 60),
    (59.99, 29.99, "-20%", "local_node", 40), (10.0, 10.0, "", "json", 80), (20.0, None, "", "json", -999),
    (10.0, 20.0, "", "page", -15), (10.0, 0.5, "", "other", 25), (10.0, 0.4, "", "other", 0), (100.0, 96.0, "x%", "page", 35),
    (8000.0, 6000.0, "-20%", "local_text", 20 + 10 + 15 + 10), (1000.0, 999.0, "", "page", 10),
])
def test_score_pair(spark, o, c, d, source, score):
    rows = spark.createDataFrame([(o, c, d, source)], "o double, c double, d string, s string")
    assert rows.select(score_pair("o", "c", "d", "s").alias("v")).first().v == score


def test_size_tokens(values):
    check(values, size_tokens, {
        "40 (EU) - 40 (ES)": ["40"], "38, 40": [], "TALLA 38 40": ["38", "40"], "Elige tu talla": ["TU"],
        "XL M 42": ["XL", "M", "42"], "36/38 (EU)": ["36", "38"], "Camisa L'Oréal 38": ["L", "38"],
        "40 (EU)X": ["40"], "": [], None: [], "9 53 10 52": ["10", "52"], "38 ............ 40": [],
        "38 a b c d e f g 40%": ["38"], "one size": ["ONE SIZE"], "29,99 € talla larga 38": ["38"],
    })
    strict = lambda c: size_tokens(c, STRICT)
    assert values(["M/L (IT) - M/L (ES)", "36/38 (EU)"], strict) == [["M/L", "M", "L"], ["36/38", "36", "38"]]


def test_size_context_by_brute_force(values):
    """The look-around test equals a look at 12 characters on each side."""
    import random
    import re

    random.seed(7)
    texts = ["".join(random.choice("14 0a€%.,bX3 ") for _ in range(40)) for _ in range(300)]

    def expected(text):
        upper, out = " ".join(text.split()).upper(), []
        for m in re.finditer(r"\b(1\d|2\d|3\d|4\d|50|51|52)\b", upper):
            around = upper[max(0, m.start() - 12): m.end() + 12]
            if not set("€%.,") & set(around) and m[1] not in out:
                out.append(m[1])
        return out

    numbers = lambda c: F.filter(size_tokens(c), lambda t: t.rlike(r"^\d+$"))
    assert values(texts, numbers) == [expected(t) for t in texts]


@pytest.mark.parametrize("tag, attrs, text, status", [
    ("option", {}, "38", "OK"), ("li", {"class": "a"}, "38", "OUT"), ("li", {"class": "a hczgyp"}, "38", "OK"),
    ("option", {"disabled": "disabled"}, "38", "OUT"), ("option", {"disabled": ""}, "38", "OK"),
    ("span", {}, "Última unidad", "LAST"), ("span", {"title": "quedan pocas"}, "M", "ALMOST"),
    ("span", {"class": "sold out"}, "M", "OK"), ("span", {"aria-label": "Sold Out"}, "M", "OUT"),
    ("button", {"role": "option"}, "M", "OUT"), ("span", {}, "casi agotado", "OUT"),
])
def test_stock_status(spark, tag, attrs, text, status):
    rows = spark.createDataFrame([(tag, attrs, text)], "tag string, attrs map<string,string>, t string")
    got = rows.select(stock_status(F.col("t"), F.col("attrs"), F.col("tag"), F.col("t")).alias("v")).first().v
    assert got == status


def test_sorted_size_text(spark):
    sizes = [("XL", "OK"), ("40", "OUT"), ("8", "LAST"), ("M", "OK")]
    rows = spark.createDataFrame([(sizes,)], "s array<struct<size:string,status:string>>")
    assert rows.select(sorted_size_text(F.col("s")).alias("v")).first().v == "8:LAST, 40:OUT, M:OK, XL:OK"


def test_colors(values):
    check(values, is_bad_color, {
        "azul": False, "#fff": True, "Talla": True, "12,5": True, "a - b - c": True, "": True, None: True,
        "x" * 41: True, "rgb(1,2,3)": True, "http://x": True, "5 €": True, "azul - verde": False, "--c": True,
        "azul 2": False, "10/20 %": True,
    })
    check(values, color_from_name, {
        "Camisa - algodón - azul": "azul", "Camisa": "", "Camisa - ": "", "Camisa - talla": "", None: "",
        "a - b -  rojo  vivo ": "rojo vivo",
    })
    check(values, color_from_phrase, {
        "Color: azul; talla M": "azul", "COLOUR - rojo | x": "rojo", "multicolor: x": "", "sin": "", None: "",
        "Colores: rojo, azul": "rojo",
    })


def test_resolve_url(values):
    base = "https://shop.example.com"
    cases = {
        "": "", None: "", "/a/b": f"{base}/a/b", "a/b": f"{base}/a/b", "//cdn.x.org/i": "https://cdn.x.org/i",
        "?q=1": f"{base}?q=1", "#top": f"{base}#top", "http://o.org/x": "http://o.org/x",
        "HTTPS://o.org/x": "https://o.org/x", "mailto:a@b.c": "mailto:a@b.c", "javascript:void(0)": "javascript:void(0)",
        "/a/../b": f"{base}/b", "../../x": f"{base}/x", "/a/b/..": f"{base}/a/", "/a/./b/.": f"{base}/a/b/",
        "a//b": f"{base}/a/b", "/a//b": f"{base}/a//b", "https://o.org/a/../b": "https://o.org/a/../b",
        "/x?": f"{base}/x", "/x#": f"{base}/x", "/x?a=../b": f"{base}/x?a=../b", "/..": f"{base}/",
        "/a.b/..c/d": f"{base}/a.b/..c/d", "  /x": f"{base}/x", "https:p/q": f"{base}/p/q",
        "/a/../b?x=1#f": f"{base}/b?x=1#f", "/x?#f": f"{base}/x#f",
    }
    check(values, resolve_url, cases)


def test_resolve_url_against_the_standard_library(values):
    import itertools
    import random
    from urllib.parse import urljoin

    parts = ["a", "..", ".", "", "b.html", "x?q=1", "y#f"]
    hrefs = ["/".join(p) for n in (1, 2, 3) for p in itertools.product(parts, repeat=n)]
    hrefs += ["/" + h for h in hrefs if not h.startswith("/")]
    draw = random.Random(3)
    atoms = ["/", "//", "a", "b.c", "..", ".", "?", "#", "x=1", "http:", "https:", "HTTPS:", "mailto:", ";", "h.com", " ", "é", "&", ":"]
    hrefs += ["".join(draw.choices(atoms, k=draw.randint(1, 6))) for _ in range(3000)]
    hrefs = [h for h in dict.fromkeys(hrefs + ["///x", "//?q", " ", "////h.com"]) if h]
    expected = [urljoin("https://shop.example.com", h) for h in hrefs]
    got = values(hrefs, resolve_url)
    assert [x for x in zip(hrefs, got, expected) if x[1] != x[2]] == []


def test_url_rules(values):
    site = "https://shop.example.com"
    check(values, lambda c: is_site_url(c), {
        f"{site}/x": True, "https://shop.example.com.evil.net/": True, "https://o.org/?u=shop.example.com": False,
        "https://SHOP.example.com/": False, "": False, None: False,
    })
    check(values, lambda c: is_blocked_url(c), {
        f"{site}/helpful-hats": True, f"{site}/a#b": True, "": True, None: True, f"{site}/CART": True,
        f"{site}/catalog/1": False,
    })
    check(values, lambda c: page_kinds(c), {
        f"{site}/catalog/1": ["campaign", "listing"], f"{site}/catalog/1/p/2": ["campaign", "product"],
        f"{site}/p/2": ["product"], f"{site}/x?category=3": ["listing"], f"{site}/x": [],
        "https://o.org/catalog/1": [], f"{site}/catalog/1/help": [], None: [],
    })
    for fn, url in ((is_campaign_url, "/Sale/x"), (is_listing_url, "/TODOS"), (is_product_url, "/Producto/1")):
        assert values([site + url, site + "/other"], lambda c: fn(c)) == [True, False]
    assert values(["http://x", "ftp://x", None], is_http) == [True, False, False]
    assert values(["https://x/a//", "https://x/a"], same_url_key) == ["https://x/a"] * 2


def test_url_id(values):
    site = "https://shop.example.com"
    check(values, lambda c: url_id(c), {
        f"{site}/catalog/12345": "12345", f"{site}/catalog/55?x=1": "55", f"{site}/campaign/nike-777/x": "777",
        f"{site}/campaign/nike?x=1": "nike", f"{site}/p/77?c=1": "77", f"{site}/a/b.html": "b.html", site: "",
        f"{site}/catalog/12/": "12", "": "", None: "", f"{site}/a/b;v=1": "b", f"{site}/a/b/": "b",
    })


def test_nested_json_stays_linear():
    """Members of a deep script take about as much room as the script."""
    from shelfmill.functions.jsonwalk import script_objects

    deep = '{"price": ' * 900 + "1" + "}" * 900
    found = [m for _, kept in script_objects("application/json", deep, frozenset({"price", "color"}), frozenset({"color"})) for m in kept]
    assert len(found) == 900 and sum(len(m["value"]) for m in found) <= len(deep)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from shelfmill.session import shared_folder

    made = []
    session = lambda master: SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=made.append),
    )
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
    assert shared_folder(session("local[2]")) == made[0]


def test_resolved_urls_keep_long_paths(spark, tmp_path):
    from shelfmill.plans.catalog import resolved_urls

    path = "/" + "long/" * 40 + "end"
    spark.createDataFrame([(1, f"https://site.example.com{path}", "")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.form: r.url for r in resolved_urls(spark, str(tmp_path)).collect()}
    assert all(got[form].endswith(path) for form in (0, 1, 2, 3, 7, 9))
