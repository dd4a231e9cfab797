"""Trees, selections and page operators on small hand-written pages."""

from pyspark.sql import functions as F

from shelfmill import SiteProfile
from shelfmill.functions.columns import let
from shelfmill.operators import cards, detail
from shelfmill.operators.page import Page, outermost
from shelfmill.operators.tree import _Shredder, nodes, rejects
from shelfmill.rules import LINK, part, tag

SITE = "https://shop.example.com"


def plain(rows):
    return [tuple(r) for r in rows]


# -- trees (D1-D3) -----------------------------------------------------
def rows_of(trees, html):
    found = nodes(trees(html)).orderBy("pre").collect()
    return [(r.pre, r.last, r.parent, r.depth, r.tag, r.text) for r in found]


def test_tree_intervals(trees):
    assert rows_of(trees, "<ul><li>a <b>b</b></li><li>c</ul>") == [
        (0, 7, -1, 0, "#root", None), (1, 7, 0, 1, "ul", None), (2, 5, 1, 2, "li", None),
        (3, 3, 2, 3, "#text", "a"), (4, 5, 2, 3, "b", None), (5, 5, 4, 4, "#text", "b"),
        (6, 7, 1, 2, "li", None), (7, 7, 6, 3, "#text", "c"),
    ]


def test_unclosed_stray_and_void_tags(trees):
    tags = lambda html: [(r[4], r[3]) for r in rows_of(trees, html) if not r[4].startswith("#")]
    assert tags("<p>a<p>b") == [("p", 1), ("p", 2)]  # an open p is not closed by the next
    assert tags("<div></span><i></div><b>") == [("div", 1), ("i", 2), ("b", 1)]
    assert tags("<br>a<img><hr/></br><div/>x<p>") == [("br", 1), ("img", 1), ("hr", 1), ("div", 1), ("p", 1)]
    assert tags('<script>var t="</p>";</script><p>') == [("script", 1), ("p", 1)]


def test_empty_and_null_pages(trees):
    tree = trees("", None)
    assert [r.tag for r in nodes(tree).collect()] == ["#root", "#root"]
    assert rejects(tree).count() == 0


def test_bad_page_becomes_a_reject():
    class Failing(_Shredder):
        def handle_comment(self, data):
            raise ValueError("broken")

    reader = Failing(frozenset())
    for html in ("<p>a</p>", "<p>b<!-- x -->", "<p>c</p>"):
        reader.read(html)
    assert reader.errors == [None, "ValueError: broken", None]
    assert reader.sizes == [3, 1, 3]
    assert reader.tags == ["#root", "p", "#text", "#root", "#root", "p", "#text"]
    assert reader.texts == [["a"], [], ["c"]]


def test_script_text_that_no_column_can_hold(page_cases):
    page_cases(F.size("objects"), [
        ('<script type="application/json">{"color": "a\\ud83d", "\\ud83dx": {"size": "\\ud83d\\ude00"}}</script>', 2),
        ('<script type="application/json">{"price": ' + "[" * 100000 + "</script>", 0),
    ])


def test_node_text(page_value):
    page = Page()
    text = lambda t: let(page.find(page.nodes, tag(t)), page.text)
    html = (
        "<div> a <!-- no -->\n<b>b&amp; c</b><script>s = 1</script><style>x{}</style>"
        "<template><i>t</i></template> d</div>"
    )
    assert page_value(html, text("div")) == "a b& c d"
    assert page_value(html, text("script")) == "s = 1"
    assert page_value(html, text("i")) == ""
    assert page_value(html, text("template")) == "t"
    assert page_value(html, text("table")) is None


def test_attributes(page_value):
    page = Page()
    attr = lambda name: let(page.find(page.nodes, tag("a")), lambda n: page.attr(n, name))
    html = "<a class=' x \n y ' href=' /p ' disabled>"
    assert [page_value(html, attr(n)) for n in ("class", "href", "disabled", "id")] == ["x y", "/p", "", ""]


# -- selections (D4-D13) -----------------------------------------------
def test_descendants_and_outermost(page_value):
    page = Page()
    spans = outermost(page.select(page.nodes, tag("div")))
    html = "<div><div><p>1</p></div></div><p>2</p><div><p>3</p></div>"
    assert len(page_value(html, spans)) == 2
    sel = tag("p").under(tag("div"))
    inside = page.with_spans([sel], lambda s: F.transform(page.select(page.nodes, sel, s), page.text))
    assert page_value(html, inside) == ["1", "3"]


def test_first_match_and_loop_differ(page_value):
    page = Page()
    sels = (tag("h1"), part("class", "title"))
    html = "<p class='title'>two</p><h1></h1>"
    strict = let(page.first_match(sels), page.text)
    assert page_value(html, strict) == ""  # the first node counts, though empty
    loop = F.coalesce(*page.first_passing(page.nodes, sels, lambda n: F.when(n["chars"] > 0, page.text(n))))
    assert page_value(html, loop) == "two"
    # The loop looks only at the first node of each selector.
    assert page_value("<h1></h1><h1>late</h1>", loop) is None


def test_all_matches_order(page_value):
    page = Page()
    sels = (part("class", "x"), tag("p"), tag("div"))
    found = F.transform(page.all_matches(sels), lambda r: F.struct(r["rank"], r["pre"]))
    html = "<div class='x'><p>1</p></div><p class='xx'>2</p><div></div>"
    assert plain(page_value(html, found)) == [(0, 1), (0, 4), (1, 2), (2, 6)]


def test_anchor_lookup_equals_search(trees):
    """The counted lookup finds the same anchor as a search of the subtree."""
    page = Page()
    searched = lambda c: F.when(c["tag"] == "a", c).otherwise(page.find(page.below(c), LINK))
    both = let(
        page.links(),
        lambda links: F.transform(
            F.filter(page.nodes, lambda n: n["tag"].isin("div", "li", "a")),
            lambda c: F.struct(
                page.anchor(links, c)["pre"].alias("l"), searched(c)["pre"].alias("r")
            ),
        ),
    )
    html = (
        "<div><a>no</a><li><a href=1>x</a></li></div><div><p></p></div><li><div><a href=2><a href=3></a></a></div>"
        "</li><div></div><a href=4></a>"
    )
    pairs = trees(html).select(both.alias("v")).first().v
    assert len(pairs) == 11 and all(p.l == p.r for p in pairs)


# -- cards (C1-C7) -----------------------------------------------------
HOME = """<div>
<section><a href='/catalog/12'>late</a></section>
<article title='Banner #1'><a href='/catalog/12'><img alt='Brand with a long text'></a>
  <span class='trending'></span><time>Acaba en 2 días | x</time></article>
<article title='Small Brand'><a href='/campaign/foo-77'>x</a><span class='date'>mañana</span></article>
<article><a href='/campaign/nameless'></a></article>
<article><a href='/catalog/77'></a></article>
<article><span class='InfoBannerSubtitle'>One</span><h3>Two</h3><a href='/sale/9'>x</a> hasta hoy</article>
<article><span class='InfoBannerSubtitle'>A name of four</span><h3>Short</h3><a href='/sale/10'>x</a></article>
<article><h3>Out</h3><a href='/help/catalog/1'>x</a></article>
</div>"""


def test_campaign_cards(page_value):
    got = plain(page_value(HOME, cards.campaign_cards()))
    assert got == [
        (0, "Brand with a long text", f"{SITE}/catalog/12", "acaba en 2 días"),
        (1, "Small Brand", f"{SITE}/campaign/foo-77", "mañana"),
        (2, "Campanya #77", f"{SITE}/catalog/77", ""),
        (3, "One", f"{SITE}/sale/9", "hasta hoy"),
        (4, "Short", f"{SITE}/sale/10", ""),
    ]


def test_campaign_cards_fall_back_to_links(page_value):
    html = "<p><a href='/sale/1' title='Shoes'>x</a><a href='/sale/1' title='Again'></a><a>none</a></p>"
    assert plain(page_value(html, cards.campaign_cards())) == [(0, "Shoes", f"{SITE}/sale/1", "")]


def test_nameless_card_does_not_claim_its_url(page_value):
    html = "<article><a href='/sale/1'></a></article><article><h2>Late</h2><a href='/sale/1'></a></article>"
    assert plain(page_value(html, cards.campaign_cards()))[0][1] == "Late"


def test_product_cards(page_value):
    html = """<div><div class='product-card'><a href='/p/1'></a></div>
      <div class='product-card'><a href='/p/1'><h3>One</h3></a></div>
      <div class='product-card'><div class='name'>Name</div><a href='/p/2'></a></div>
      <li><a href='/p/3'><img alt='Image three'></a></li><li><a href='/p/4' title='Four'></a></li>
      <li><a href='/p/5'>Five</a></li><li><a href='/p/6'>6</a></li><li><a href='/catalog/1'>no</a></li></div>"""
    got = plain(page_value(html, cards.product_cards()))
    names = {url: name for _, url, name in got}
    assert names == {
        f"{SITE}/p/1": "One", f"{SITE}/p/2": "Name", f"{SITE}/p/3": "Image three", f"{SITE}/p/4": "Four",
        f"{SITE}/p/5": "Five",
    }
    assert [p for p, _, _ in got] == [0, 1, 2, 3, 4]


def test_product_name_looks_above_the_card(page_value):
    """A compound selector may find its ancestor outside the card."""
    html = "<div class='product-list'><li><a href='/p/1'><i class='xname'>In</i><h2>Head</h2></a></li></div>"
    assert plain(page_value(html, cards.product_cards())) == [(0, f"{SITE}/p/1", "In")]


TREE = """<nav data-testid='CatalogTree'><ul><li>Todo</li><li>Otro</li>
<li><a href='/catalog/1/a'>Moda</a></li><li><a href='/x'>no</a></li></ul></nav>
<div class='Category'><a href='/catalog/1/b'>B</a></div>"""


def test_subpages(page_value):
    own = F.lit(f"{SITE}/catalog/1")
    got = plain(page_value(TREE, cards.subpages(own)))
    assert got == [
        (f"{SITE}/catalog/1", "Todo"), (f"{SITE}/catalog/1/a", "Moda"),  # tree
        (f"{SITE}/catalog/1/a", "Moda"),  # nav
        (f"{SITE}/catalog/1/b", "B"),  # Category block
        (f"{SITE}/catalog/1/a", "Moda"), (f"{SITE}/catalog/1/b", "B"),  # by URL
    ]
    fixed = SiteProfile(strict_fix=True)
    assert plain(page_value(TREE, cards.subpages(own, fixed), fixed)) == [
        (f"{SITE}/catalog/1", "Todo"), (f"{SITE}/catalog/1/a", "Moda"), (f"{SITE}/catalog/1/b", "B"),
    ]
    assert page_value("<p>x</p>", cards.subpages(own)) == []


def test_listing_plan(spark):
    def plan(pairs, own, most=20):
        rows = spark.createDataFrame([(pairs, own)], "p array<struct<url:string,label:string>>, own string")
        return plain(rows.select(cards.listing_plan("p", "own", most).alias("v")).first().v)

    many = [(f"u{i}", str(i)) for i in range(25)]
    assert plan([], "own") == [("own", "principal")]
    assert plan(many, "own") == [("own", "principal"), *many[:20]]
    assert plan(many, "u3/") == many[:20]
    assert plan(many, "u24", 3) == [("u24", "principal"), *many[:3]]


# -- product pages (C8-C20) --------------------------------------------
LINKED = "<script type='application/ld+json'>{}</script>".format


def test_prices(page_cases):
    page_cases(detail.detail_prices(), [
        (LINKED('{"offers":[{"price":"29,99","highPrice":59.99}]}') + "<div class=price>1,00 €</div>",
         ("59.99", "29.99", "-50%")),
        ("<meta itemprop=price content='12.50'>", ("", "12.50", "")),
        ("<h1>x</h1><div class=price>59,99 € 29,99 €</div> -50%", ("59.99", "29.99", "-50%")),
        ("<article><h2>x</h2></article><p>19,99 €</p>", ("", "19.99", "")),
        ("<p>nothing</p>", ("", "", "")),
        ("<p>nothing -20%</p>", ("", "", "-20%")),
        (LINKED('{"listPrice": "40"}'), ("", "40.00", "")),
        (LINKED("{bad") + "<p>7,00 €</p>", ("", "7.00", "")),
        # A nested value is no price, but the object inside is read on its own.
        (LINKED('{"price":{"amount":12.5,"price":3}}'), ("", "3.00", "")),
        # Last duplicate, also by case; original below current is swapped.
        (LINKED('{"price":5,"PRICE":7,"oldPrice":3}'), ("7.00", "3.00", "-57%")),
        ('<script>var a = {"salePrice": 10, "regularPrice": 20}; var b = {x: 1};</script>',
         ("20.00", "10.00", "-50%")),
        # Linked data is read whole only, other JSON by flat objects only.
        ('<script type="application/json">{"a": {"price": 5}}</script>', ("", "", "")),
        ('<script type="application/json">[{"price": 5}]</script>', ("", "5.00", "")),
        # The whole text's pair scores above the single nodes.
        ("<div class='price'>10,00 €</div><div class='price'>20,00 €</div>", ("20.00", "10.00", "-50%")),
        # A tie goes to the first.
        (LINKED('[{"price": 5}, {"price": 6}]'), ("", "5.00", "")),
        # The label decides between pairs.
        (LINKED('[{"price": 50, "oldPrice": 100}, {"price": 70, "oldPrice": 100}]') + "<p>-30%</p>",
         ("100.00", "70.00", "-30%")),
    ])


def test_name_and_description(page_cases):
    page_cases(detail.detail_name(), [
        ("<h1> A  b </h1>", "A b"), ("<h1></h1><p class=title>x</p>", ""), ("<p class=title>x</p>", "x"),
        ("<p>x</p>", ""),
    ])
    long = "word " * 12
    page_cases(detail.detail_description(), [
        ("<meta name=description content=' a  b '>", "a b"),
        ("<meta name=description content=''><p class=description>short</p>", ""),
        ("<p class=description>twenty characters or more</p>", "twenty characters or more"),
        (f"<span>x</span><div>{long}</div>", long.strip()), (f"<h2>{long}</h2>", ""),
        # Only the first node of a selector is looked at.
        ("<p class=description>short</p><p class=description>twenty characters or more</p>", ""),
    ])


def test_image(page_cases):
    cases = [
        ("<meta property='og:image' content='u'><img class=x src=y>", "u"),
        ("<div class=MainImage><img data-src=z></div>", "z"),
        ("<img class='a styles__MainImg-groot__sc-80bee9f7-1' src=q>", "q"),
    ]
    hosted = "<img src='https://media.example.net/1.jpg'>"
    page_cases(detail.detail_image(), [*cases, (hosted, "")])
    named = SiteProfile(image_host="media.example.net")
    page_cases(detail.detail_image(named), [(hosted, "https://media.example.net/1.jpg")], named)


def test_colors(page_cases):
    thumb = "<div data-testid='variation-item-{}'><img alt='a - b - {}'></div>".format
    before, after = detail.detail_color_parts()
    page_cases(detail.complete_color(F.lit("Camisa - talla"), before, after), [
        (thumb(1, "rojo") + thumb(2, "azul") + thumb(3, "rojo"), "rojo | azul"),
        (thumb("x", "rojo"), ""),
        ("<div><span>Color:</span>\n<b>verde</b></div>", "verde"),
        # The div's own text is the label too, so the block beside it counts.
        ("<div><span>Color</span></div><p>oro</p>", "oro"),
        # The sixth sibling is too far; the parent's next pieces are not.
        ("<div><span>Color</span><i></i><i></i><i></i><i></i><i></i><b>gris</b></div>", "gris"),
        ("<dl><i>Colour:</i><em>azul marino</em><em>lila</em></dl>", "lila"),
        ("<i data-color='#fff' title='Color: negro'></i>", "negro"),
        ("<p>talla color: beige</p>", "beige"),
        ('<script type="x/json">{"a":[{"colour":"talla"},{"Color":"oro"}]}</script>', "oro"),
        ('<script>x = {"color": "plata"};</script>', "plata"),
        ('<script type="x/json">{"color": ["a", "b"]}</script>', "['a', 'b']"),
        ('<script type="x/json">{"color": null, "b": {"color": 0}}</script>', ""),
        ("<p>x</p>", ""),
    ])
    page_cases(detail.complete_color(F.lit("Camisa - azul"), before, after), [
        ("<p>x</p>", "azul"), ("<i data-color=negro></i>", "azul"), ("<p>Color</p><p>rojo</p>", "rojo"),
    ])


def test_color_siblings_count_white_space(page_cases):
    """Five siblings at most, and text between tags is a sibling."""
    near = Page()
    label = let(near.find(near.nodes, tag("u")), lambda n: F.transform(near.next_siblings(n), near.text))
    page_cases(label, [
        ("<u>l</u><i>1</i><i>2</i><i>3</i><i>4</i><i>5</i><i>6</i>", ["1", "2", "3", "4", "5"]),
        ("<u>l</u> <i>1</i> <i>2</i> <i>3</i>", ["1", "2"]),
        ("<u>l</u>t<!-- c --><i>1</i><i>2</i> <i>3</i>", ["t", "", "1", "2"]),
        ("<p><u>l</u></p><i>1</i>", []),
    ])


def test_sizes(page_cases):
    script = '<script type="application/json">{}</script>'.format
    page_cases(detail.detail_sizes(), [
        ("<div><ul role=listbox><li role=option class='hczgyp'>38</li><li role=option>40</li>"
         "<li role=option class=hczgyp>42 última unidad</li><li class=hczgyp>44 quedan pocas</li></ul></div>",
         "38:OK, 40:OUT, 42:LAST, 44:ALMOST"),
        # One size seen twice keeps the stronger state.
        ("<select><option>38</option><option disabled=disabled>38</option></select>", "38:OUT"),
        # Generic containers only when there is no item at all.
        ("<div><p>Talla</p><span>M</span><span>40</span></div>", "40:OK, M:OK"),
        ("<div><p>Talla</p><button>L</button><span>40</span></div>", "L:OK"),
        # A block of many numbers is not a size.
        ("<div><p>Talla</p><span>38 39 40 41 42 43</span></div>", ""),
        ("<select><option>Selecciona talla 38</option><option>40</option></select>", "40:OK"),
        ("<div><p>Elige  tu modelo</p><button data-size=XL>x</button></div>", "XL:OK"),
        # Seen OK then OUT counts as OK in scripts, the reverse of the menus.
        (script('{"sizes":[{"size":"38","available":false},{"size":"38","available":true},'
                '{"name":"M","inStock":"0"}]}'), "38:OK, M:OUT"),
        (script('{"size":"40","availability":"https://schema.org/OutOfStock"}'), "40:OK"),
        (script('{"name":"XL"}'), ""),  # no size word in the script
        ("<p>38</p>", ""),
    ])
