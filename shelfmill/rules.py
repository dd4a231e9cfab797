"""Site rules as data: URL parts, selectors and word lists of one shop.

Every operator takes a :class:`SiteProfile`, so another shop is another
profile and no operator changes. The defaults describe a flash-sale shop;
``base_url``, ``domain`` and ``image_host`` are the caller's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from zlib import crc32


@dataclass(frozen=True)
class Sel:
    """One element test: a tag, an attribute test, and an optional ancestor.

    ``how`` is ``has`` (attribute present), ``is`` (equal), ``part``
    (substring) or ``word`` (one token of a space-separated value).
    """

    tag: str | None = None
    attr: str | None = None
    how: str = "has"
    value: str = ""
    inside: "Sel | None" = None

    def under(self, ancestor: "Sel") -> "Sel":
        return replace(self, inside=ancestor)


def tag(name: str) -> Sel:
    return Sel(tag=name)


def has(attr: str, tag: str | None = None) -> Sel:
    return Sel(tag=tag, attr=attr)


def equals(attr: str, value: str, tag: str | None = None) -> Sel:
    return Sel(tag=tag, attr=attr, how="is", value=value)


def part(attr: str, value: str, tag: str | None = None) -> Sel:
    return Sel(tag=tag, attr=attr, how="part", value=value)


def css_class(name: str) -> Sel:
    return Sel(attr="class", how="word", value=name)


LINK = has("href", "a")
PRODUCT_CLASS = part("class", "product")

# ---- fixed values: word lists, URL parts, selectors and patterns ----

BLOCKED_PARTS = (
    "/myaccount", "/my-orders", "/communications", "/my-notifications", "/profile",
    "/login", "/logout", "/register", "/help", "/faq", "/contact", "/legal",
    "/privacy", "/cookies", "/terms", "/wishlist", "/cart", "/basket", "/checkout",
    "/search", "/brands", "/invite", "/storelocator", "/member", "/club",
)
CAMPAIGN_PARTS = ("/catalog/", "/campaign/", "/sale/", "/evento/", "/brand/", "/outlet/")
LISTING_PARTS = (
    "/catalog/", "/campaign/", "/sale/", "/evento/", "/brand/", "/outlet/",
    "/products", "/productos", "/all-products", "/todos", "/category/", "/categoria/",
    "?category=", "&category=", "?subcategory=", "&subcategory=", "?filter", "&filter",
)
PRODUCT_PARTS = ("/product/", "/p/", "/producto/", "/detail/")
ID_SEGMENTS = ("catalog", "campaign", "sale", "evento", "brand", "outlet")
END_DATE_LEADS = ("acaba en", "termina en", "finaliza en", "hasta", "ends in")

CAMPAIGN_CARDS = (
    part("data-testid", "campaign"), part("data-testid", "catalog"), part("data-testid", "sale"),
    part("class", "campaign-card"), part("class", "campaignCard"),
    part("class", "catalog-card"), part("class", "catalogCard"),
    part("class", "sale-card"), part("class", "saleCard"),
    part("class", "brand-card"), part("class", "brandCard"),
    tag("article"),
    part("href", "/catalog/", "a").under(tag("section")),
    part("href", "/campaign/", "a").under(tag("section")),
    part("href", "/catalog/", "a").under(tag("div")),
    part("href", "/campaign/", "a").under(tag("div")),
)
PRODUCT_CARDS = (
    part("data-testid", "product"), part("data-testid", "grid-item"), part("data-testid", "item"),
    part("class", "product-card"), part("class", "productCard"),
    part("class", "product-item"), part("class", "productItem"),
    part("class", "grid-item"), part("class", "gridItem"),
    tag("article"), tag("li"), tag("div"),
)
CAMPAIGN_NAME_FIRST = (
    part("class", "InfoBannerSubtitle", "span"), part("class", "InfoBannerSubtitle"),
)
CAMPAIGN_NAME_LATER = (
    part("data-testid", "title"), part("data-testid", "name"),
    tag("h2"), tag("h3"), tag("h4"), tag("strong"),
)
GENERIC_CARD_TITLE = "Banner #"
NAMELESS_CAMPAIGN = "Campanya #"
PRODUCT_NAME = (
    part("data-testid", "product"), part("data-testid", "title"), part("data-testid", "name"),
    part("class", "name").under(PRODUCT_CLASS), part("class", "title").under(PRODUCT_CLASS),
    part("class", "name"), part("class", "title"),
    tag("h2"), tag("h3"), tag("h4"), tag("strong"), has("alt", "img"),
)
CARD_END_DATE = (
    part("data-testid", "end"), part("data-testid", "date"),
    part("class", "end"), part("class", "date"), part("class", "deadline"), tag("time"),
)
CATEGORY_TREE = (
    (equals("data-testid", "CatalogTree", "ul"), equals("data-testid", "CatalogTree", "nav")),
    (equals("data-facil-iti", "catalog--tree-links"),),
)
NAV_LINKS = (
    LINK.under(tag("nav")), LINK.under(tag("aside")), LINK.under(equals("role", "navigation")),
    LINK.under(part("class", "category")), LINK.under(part("class", "Category")),
    part("href", "/catalog/", "a"), part("href", "/campaign/", "a"),
)
DETAIL_NAME = (
    tag("h1"), part("data-testid", "product-name"), part("data-testid", "title"),
    part("class", "product-name"), part("class", "productName"), part("class", "title"),
)
DESCRIPTION = (
    equals("name", "description", "meta"), part("data-testid", "description"),
    part("class", "description"), part("class", "details"),
    part("class", "product-description"), part("class", "productDescription"),
)
DESCRIPTION_TAGS = ("div", "p", "span")
PRICE_SCOPES = (
    tag("main"), tag("article"),
    part("data-testid", "product"), part("data-testid", "detail"),
    part("class", "product-detail"), part("class", "productDetail"),
    part("class", "product-page"), part("class", "productPage"),
    part("class", "details"), part("class", "pdp"),
)
PRICE_NODES = (
    part("data-testid", "price"), part("class", "price"), part("class", "pricing"),
    part("class", "discount"), part("class", "sale"), part("class", "amount"),
    part("class", "current"), part("class", "old"), part("class", "final"),
    equals("property", "product:price:amount", "meta"), equals("itemprop", "price", "meta"),
)
CURRENT_PRICE_KEYS = ("price", "saleprice", "currentprice", "lowprice", "bestprice")
ORIGINAL_PRICE_KEYS = (
    "highprice", "originalprice", "oldprice", "regularprice", "listprice", "wasprice",
)
COLOR_KEYS = ("color", "colour", "colore", "colorname")
COLOR_LABELS = ("color", "colour", "colores")
COLOR_LABEL_TAGS = ("div", "span", "p", "dt", "strong", "label", "h2", "h3", "h4")
COLOR_ATTRS = ("data-color", "data-colour")
COLOR_STOP_WORDS = (
    "menu", "color", "colour", "colores", "selecciona", "elige", "elige tu modelo",
    "escoge tu talla", "escoge", "talla", "modelo", "wishlist", "favoritos",
)
CSS_COLOR_MARKS = ("rgb(", "rgba(", "hsl(", "hsla(", "var(", "--")
VARIANT_TEST_ID = r"^variation-item-\d+$"
SIZE_KEYS = ("size", "sizes", "talla", "tallas", "label", "name", "value")
SIZE_SCRIPT_WORDS = ("size", "talla")
AVAILABILITY_KEYS = ("available", "availability", "in_stock", "instock", "isavailable")
UNAVAILABLE_VALUES = ("false", "0", "outofstock", "out_of_stock", "soldout")
SIZE_AREAS = (tag("select"), equals("role", "listbox"), equals("role", "option"), tag("option"))
SIZE_WORDS = (
    "talla", "tallas", "size", "sizes", "elige tu modelo", "selecciona tu talla",
    "selecciona talla",
)
SIZE_WORD_TAGS = ("div", "span", "label", "p", "strong", "h2", "h3", "h4")
SIZE_ITEMS = (tag("option"), equals("role", "option"), tag("li"), tag("button"))
SIZE_CONTAINERS = (tag("label"), tag("span"), tag("div"))
SIZE_TEXT_ATTRS = ("value", "aria-label", "title", "data-value", "data-label", "data-size")
SIZE_SKIP_WORDS = ("ELIGE TU MODELO", "SELECCIONA", "COLOR", "MENU")
SIZE_REGIONS = ("ES", "EU", "UK", "US", "IT", "FR", "DE", "MX", "BR", "INT")
LETTER_SIZES = (
    "XXXS", "XXS", "XS", "S", "M", "L", "XL", "XXL", "XXXL", "UNITALLA", "ONE SIZE", "TU",
)
IN_STOCK_CLASS = "hczgyp"
SOLD_OUT_WORDS = (
    "agotado", "sold out", "sin stock", "unavailable", "no disponible", "out of stock",
    "disabled",
)
LAST_UNIT_WORDS = ("último producto", "ultimo producto", "última unidad", "ultima unidad")
LOW_STOCK_WORDS = (
    "agotándose", "agotandose", "últimas unidades", "ultimas unidades", "casi agotado",
    "low stock", "last items", "quedan pocas", "están agotándose", "estan agotandose",
)
IMAGES = (
    part("data-testid", "product-image"),
    tag("img").under(part("class", "ProductImage")), tag("img").under(part("class", "MainImage")),
    css_class("styles__VariationThumbnail-groot__sc-cfcf0da0-3"),
    part("data-testid", "variation-item", "img"),
    css_class("styles__MainImg-groot__sc-80bee9f7-1"),
)

# ---- end of fixed values ----


MARK_BITS = 62  # of a long


@dataclass(frozen=True)
class Marks:
    """Element tests that have a bit each in a number kept with every node. Tests beyond
    ``MARK_BITS`` have none and are evaluated where they are asked for."""

    sels: tuple[Sel, ...]

    @property
    def field(self) -> str:
        """Name of the number. It follows from the tests, so that a tree marked for
        other ones is refused by its columns and never misread."""
        return f"marks_{crc32(repr(self.sels).encode()):08x}"

    def mask(self, sels: Sequence[Sel]) -> int | None:
        """The bits of some tests, without what they ask of ancestors; null if one has no bit."""
        places = {s: i for i, s in enumerate(self.sels)}
        plain = [replace(s, inside=None) for s in sels]
        return sum({1 << places[s] for s in plain}) if all(s in places for s in plain) else None


@dataclass(frozen=True)
class SiteProfile:
    """All site rules. ``strict_fix`` turns on the documented corrections."""

    base_url: str = "https://shop.example.com"
    domain: str = "shop.example.com"
    image_host: str = ""
    strict_fix: bool = False
    blocked_parts: tuple[str, ...] = BLOCKED_PARTS
    campaign_parts: tuple[str, ...] = CAMPAIGN_PARTS
    listing_parts: tuple[str, ...] = LISTING_PARTS
    product_parts: tuple[str, ...] = PRODUCT_PARTS
    id_segments: tuple[str, ...] = ID_SEGMENTS
    end_date_leads: tuple[str, ...] = END_DATE_LEADS
    campaign_cards: tuple[Sel, ...] = CAMPAIGN_CARDS
    product_cards: tuple[Sel, ...] = PRODUCT_CARDS
    campaign_name_first: tuple[Sel, ...] = CAMPAIGN_NAME_FIRST
    campaign_name_later: tuple[Sel, ...] = CAMPAIGN_NAME_LATER
    generic_card_title: str = GENERIC_CARD_TITLE
    nameless_campaign: str = NAMELESS_CAMPAIGN
    product_name: tuple[Sel, ...] = PRODUCT_NAME
    card_end_date: tuple[Sel, ...] = CARD_END_DATE
    category_tree: tuple[tuple[Sel, ...], ...] = CATEGORY_TREE
    nav_links: tuple[Sel, ...] = NAV_LINKS
    detail_name: tuple[Sel, ...] = DETAIL_NAME
    description: tuple[Sel, ...] = DESCRIPTION
    description_tags: tuple[str, ...] = DESCRIPTION_TAGS
    price_scopes: tuple[Sel, ...] = PRICE_SCOPES
    price_nodes: tuple[Sel, ...] = PRICE_NODES
    current_price_keys: tuple[str, ...] = CURRENT_PRICE_KEYS
    original_price_keys: tuple[str, ...] = ORIGINAL_PRICE_KEYS
    color_keys: tuple[str, ...] = COLOR_KEYS
    color_labels: tuple[str, ...] = COLOR_LABELS
    color_label_tags: tuple[str, ...] = COLOR_LABEL_TAGS
    color_attrs: tuple[str, ...] = COLOR_ATTRS
    color_stop_words: tuple[str, ...] = COLOR_STOP_WORDS
    css_color_marks: tuple[str, ...] = CSS_COLOR_MARKS
    variant_test_id: str = VARIANT_TEST_ID
    size_keys: tuple[str, ...] = SIZE_KEYS
    size_script_words: tuple[str, ...] = SIZE_SCRIPT_WORDS
    availability_keys: tuple[str, ...] = AVAILABILITY_KEYS
    unavailable_values: tuple[str, ...] = UNAVAILABLE_VALUES
    size_areas: tuple[Sel, ...] = SIZE_AREAS
    size_words: tuple[str, ...] = SIZE_WORDS
    size_word_tags: tuple[str, ...] = SIZE_WORD_TAGS
    size_items: tuple[Sel, ...] = SIZE_ITEMS
    size_containers: tuple[Sel, ...] = SIZE_CONTAINERS
    size_text_attrs: tuple[str, ...] = SIZE_TEXT_ATTRS
    size_skip_words: tuple[str, ...] = SIZE_SKIP_WORDS
    size_regions: tuple[str, ...] = SIZE_REGIONS
    letter_sizes: tuple[str, ...] = LETTER_SIZES
    in_stock_class: str | None = IN_STOCK_CLASS
    sold_out_words: tuple[str, ...] = SOLD_OUT_WORDS
    last_unit_words: tuple[str, ...] = LAST_UNIT_WORDS
    low_stock_words: tuple[str, ...] = LOW_STOCK_WORDS
    images: tuple[Sel, ...] = IMAGES
    # Job limits; None takes all.
    max_campaigns: int | None = None
    max_subpages: int | None = None
    max_products: int | None = None
    json_keys: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if not self.json_keys:
            keys = (
                self.current_price_keys + self.original_price_keys + self.color_keys
                + self.size_keys + self.availability_keys
            )
            object.__setattr__(self, "json_keys", tuple(dict.fromkeys(keys)))

    @property
    def image_selectors(self) -> tuple[Sel, ...]:
        if not self.image_host:
            return self.images
        return self.images + (part("src", self.image_host, "img"),)

    @property
    def marks(self) -> "Marks":
        """The element tests of product pages, marked while a page is read."""
        sels = (
            self.detail_name + self.description + self.price_scopes + self.price_nodes + self.size_areas
            + self.size_items + self.size_containers + self.image_selectors
        )
        outer = tuple(s.inside for s in sels if s.inside)
        plain = dict.fromkeys(replace(s, inside=None) for s in sels + outer)
        return Marks(tuple(s for s in plain if s.tag or s.attr)[:MARK_BITS])


DEFAULT_PROFILE = SiteProfile()
