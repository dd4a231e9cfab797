"""Shop pages rendered from relational tables.

``parts`` become product pages, ``suppliers`` become home, campaign and
listing pages. Every page is a plain expression over one row, so the corpus
grows with the tables and no rows are grouped. The pages hold each kind of
markup that the extraction reads; which kind follows from the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SITE = "https://shop.example.com"


def _money(cents: Column, point: str) -> Column:
    return F.concat(
        F.floor(cents / 100).cast("string"),
        F.lit(point),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def _choose(key: Column, n: int, *options: Column | str) -> Column:
    result = F.lit("")
    for i, option in enumerate(options):
        value = F.lit(option) if isinstance(option, str) else option
        result = F.when(key % n == i, value).otherwise(result)
    return result


def product_pages(parts: DataFrame) -> DataFrame:
    """One product page per part, at ``/p/<key>``."""
    key = F.col("p_partkey")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    now = F.floor(cents * 7 / 10)
    name = F.concat("p_name", F.when(key % 6 == 2, " - gris").otherwise(""))
    size = (F.lit(10) + F.col("p_size") % 30).cast("long")
    text = lambda c: c.cast("string")

    linked = F.concat(
        F.lit('<script type="application/ld+json">{"@type": "Product", "offers": [{"highPrice": '),
        _money(cents, "."), F.lit(', "price": "'), _money(now, ","), F.lit('"}]}</script>'),
    )
    meta = F.concat(
        F.lit('<meta property="product:price:amount" content="'), _money(now, "."), F.lit('">')
    )
    script = F.concat(F.lit('<script>var shop = {"id": 7, "price": "'), _money(now, ","), F.lit('"};</script>'))
    head_price = _choose(key, 8, linked, meta, "", "", linked, script)
    menu = F.concat(
        F.lit('<div><label>Talla</label><ul role="listbox"><li role="option" class="hczgyp">'),
        text(size), F.lit('</li><li role="option">'), text(size + 2),
        F.lit('</li><li role="option" class="x hczgyp">'), text(size + 4),
        F.lit(" últimas unidades</li></ul></div>"),
    )
    select = (
        "<div><select><option>Elige tu modelo</option><option value='XL'>XL</option>"
        "<option disabled='disabled'>M</option></select></div>"
    )
    # A crowded block names no sizes of its own, and so does not say that all are sold out.
    crowded = (
        "<section><div><label>Talla</label><div>agotado "
        + " / ".join(f"<span>{n}</span>" for n in range(38, 44)) + "</div></div></section>"
    )
    json_sizes = (
        '<script type="application/json">{"sizes": [{"size": "38", "available": true}, '
        '{"size": "M", "available": false}]}</script>'
    )
    sizes = _choose(key, 4, menu, crowded, select, json_sizes)
    price = _choose(
        key, 4, '<div class="price">1,00 €</div>', "",
        F.concat(
            F.lit('<div class="price"><span>'), _money(cents, ","), F.lit(" €</span> <span>"),
            _money(now, ","), F.lit(" €</span></div><p>Ahora -30%</p>"),
        ),
    )
    # Outside the main part, the only one with a heading.
    footer = _choose(key, 4, "", "", "", F.concat(F.lit("<footer>"), _money(now, ","), F.lit(" €</footer>")))
    color = _choose(
        key, 6,
        '<div data-testid="variation-item-1"><a><img alt="Camisa - lino - rojo"></a></div>'
        '<div data-testid="variation-item-2"><a><img alt="Camisa - lino - azul"></a></div>',
        "<div><span>Color:</span>\n<span>verde</span></div>",
        "",
        '<i data-color="negro"></i>',
        '<script type="application/json">{"product": {"colour": "blanco"}}</script>',
        "<dl><i>Color</i> <em>lila</em></dl>",
    )
    about = F.when(
        key % 2 == 0, F.concat(F.lit('<meta name="description" content="About  '), "p_name", F.lit('">'))
    ).otherwise("")
    block = _choose(
        key, 4, "", F.concat(F.lit('<p class="description">Fine '), "p_name", F.lit(" made for every day</p>")),
        "", F.concat(F.lit("<p>Fine "), "p_name", F.lit(" made for every day, whatever the weather may be</p>")),
    )
    image = F.when(
        key % 2 == 0,
        F.concat(F.lit('<meta property="og:image" content="https://img.example.com/'), text(key), F.lit('.jpg">')),
    ).otherwise("")
    photo = F.when(
        key % 2 == 1,
        F.concat(F.lit('<div class="MainImage"><img data-src="/img/'), text(key), F.lit('.jpg"></div>')),
    ).otherwise("")
    title = F.when(
        key % 4 == 3, F.concat(F.lit('<article><h2 class="title">'), name, F.lit("</h2></article>"))
    ).otherwise(F.concat(F.lit("<h1>"), name, F.lit("</h1>")))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head>"), image, about, head_price, F.lit("</head><body><main>"),
        title, price, block, photo, color, sizes, F.lit("</main>"), footer, F.lit("</body></html>"),
    )
    url = F.concat(F.lit(f"{SITE}/p/"), text(key))
    return parts.select(key.alias("page_id"), url.alias("url"), html.alias("html"))


def _cards(first: Column, low: int, high: int) -> Column:
    card = lambda i: F.concat(
        F.lit('<div class="product-card"><a href="/p/'), (first + i).cast("string"),
        F.lit('"><h3>Item '), (first + i).cast("string"), F.lit("</h3></a></div>"),
    )
    return F.array_join(F.transform(F.sequence(F.lit(low), F.lit(high)), card), "")


def shop_pages(suppliers: DataFrame) -> DataFrame:
    """Per supplier a home page, a campaign page and two listing pages."""
    key = F.col("s_suppkey")
    k = key.cast("string")
    first = key * 20
    days = (key % 9 + 1).cast("string")
    cards = F.concat(
        F.lit('<div><section><article title="Banner #1"><a href="/catalog/'), k,
        F.lit('"><img alt="Marca '), k, F.lit('"></a><span class="deadline">Acaba en '), days,
        F.lit(' días | outlet</span></article><article><h3>Copia</h3><a href="/catalog/'), k,
        F.lit('">x</a></article><article><a href="/campaign/outlet-'), k,
        F.lit('"></a></article><article><a href="/catalog/'), k,
        F.lit('/solo"></a></article></section></div>'),
    )
    # Every third home page has links alone.
    links = F.concat(
        F.lit('<main><p><a href="/catalog/'), k, F.lit('"><img alt="Marca '), k,
        F.lit('"><span class="deadline">Acaba en '), days, F.lit(' días | outlet</span></a> <a href="/catalog/'), k,
        F.lit('">x</a> <a href="/campaign/outlet-'), k, F.lit('"></a> <a href="/catalog/'), k,
        F.lit('/solo"></a></p></main>'),
    )
    home = F.when(key % 3 == 0, links).otherwise(cards)
    campaign = F.concat(
        F.lit('<ul data-testid="CatalogTree"><li>Todo</li><li><a href="/catalog/'), k,
        F.lit('/a">Moda</a></li><li><a href="/catalog/'), k,
        F.lit('/b">Casa</a></li></ul><main>'), _cards(first, 0, 4), F.lit("</main>"),
    )
    listing = lambda low, high: F.concat(F.lit("<main>"), _cards(first, low, high), F.lit("</main>"))
    # The HTML is a column of its own, so that pages which are not asked for are not rendered.
    pages = (
        (F.concat(F.lit("/home/"), k), home),
        (F.concat(F.lit("/catalog/"), k), campaign),
        (F.concat(F.lit("/catalog/"), k, F.lit("/a")), listing(3, 14)),
        (F.concat(F.lit("/catalog/"), k, F.lit("/b")), listing(10, 29)),
    )
    number = F.explode(F.array(*[F.lit(n) for n in range(len(pages))])).alias("__page")
    numbered = suppliers.select("s_suppkey", number)
    at = lambda part: F.coalesce(*[F.when(F.col("__page") == n, page[part]) for n, page in enumerate(pages)])
    return numbered.select(
        (key * 4 + F.col("__page")).alias("page_id"), F.concat(F.lit(SITE), at(0)).alias("url"), at(1).alias("html")
    )


def corpus(parts: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Product and shop pages together; page ids of parts come after."""
    products = product_pages(parts).withColumn("page_id", -F.col("page_id") - 1)
    return shop_pages(suppliers).unionByName(products)


def is_home(url: str = "url") -> Column:
    return F.col(url).startswith(f"{SITE}/home/")
