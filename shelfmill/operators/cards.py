"""Home, campaign and listing pages: links, cards, sub-pages.

Each function returns one array Column per page; :mod:`plans` explodes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import as_col, built_once, distinct_by_first, let
from ..functions.text import clean_text, end_date_text, few_words
from ..functions.urls import (
    is_campaign_url, is_listing_url, is_product_url, page_kinds, resolve_url, same_url_key,
)
from ..rules import DEFAULT_PROFILE, SiteProfile, tag
from .page import Page, Spans, present

MAIN_LISTING = "principal"  # fixed value: label of the campaign's own page


@built_once
def page_links(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Every link: ``pos, url, label, kinds``."""
    page = Page(profile)
    base = profile.base_url
    found = F.transform(
        page.links(),
        lambda n, i: F.struct(
            i.alias("pos"),
            let(page.attr(n, "href"), lambda h: resolve_url(h, base)).alias("url"),
            page.text(n).alias("label"),
        ),
    )
    return F.transform(
        found,
        lambda k: F.struct(k["pos"], k["url"], k["label"], page_kinds(k["url"], profile).alias("kinds")),
    )


def _image_alt(page: Page, n: Column) -> Column:
    """Alt text of the first image below a node, when it has two characters."""
    return let(
        page.attr(page.find(page.below(n), tag("img")), "alt"),
        lambda alt: F.when(F.length(alt) >= 2, alt),
    )


def _short_name(text: Column) -> Column:
    return let(text, lambda t: F.when((F.length(t) >= 2) & few_words(t), t))


def campaign_name(page: Page, card: Column, anchor: Column, spans: Spans) -> Column:
    """Brand name of a campaign card, '' when nothing fits."""
    p = page.profile
    short = lambda n: _short_name(page.text(n))
    title = let(
        page.attr(card, "title"),
        lambda t: F.when(~t.contains(p.generic_card_title), _short_name(t)),
    )
    return let(
        page.below(card),
        lambda sub: F.coalesce(
            *page.first_passing(sub, p.campaign_name_first, short, spans),
            _image_alt(page, anchor),
            title,
            *page.first_passing(sub, p.campaign_name_later, short, spans),
            _short_name(page.attr(anchor, "title")),
            F.lit(""),
        ),
    )


def product_name(page: Page, card: Column, anchor: Column, spans: Spans) -> Column:
    """Name of a product card, '' when nothing fits."""
    long_enough = lambda text: let(text, lambda t: F.when(F.length(t) >= 2, t))

    def pick(n: Column) -> Column:
        alt = F.when(n["tag"] == "img", long_enough(page.attr(n, "alt")))
        return F.coalesce(alt, F.when(n["chars"] >= 2, page.text(n)))

    return let(
        page.below(card),
        lambda sub: F.coalesce(
            *page.first_passing(sub, page.profile.product_name, pick, spans),
            _image_alt(page, anchor),
            long_enough(page.attr(anchor, "title")),
            long_enough(page.text(anchor)),
            F.lit(""),
        ),
    )


def card_end_date(page: Page, card: Column) -> Column:
    """End-date text of a card (C4)."""
    p = page.profile

    def pick(n: Column) -> Column:
        return F.when(
            n["chars"] > 0,
            let(page.text(n), lambda t: F.coalesce(present(end_date_text(t, p)), t)),
        )

    return let(
        page.below(card),
        lambda sub: F.coalesce(
            *page.first_passing(sub, p.card_end_date, pick),
            let(page.text(card), lambda t: end_date_text(t, p)),
        ),
    )


_NAMED = "struct<rank:int,pre:int,url:string,name:string>"


def _first_named(cards: Column, name_of: Callable[[Column], Column]) -> Column:
    """First named card per URL, by (rank, pre).

    Sorted by (url, rank, pre), the cards of a URL are one run. A name is
    worked out only while its run has none yet, so the enclosing cards of a
    URL cost nothing, and a page's runs together are as long as its cards.
    """

    def first_of(run: Column) -> Column:
        named = lambda c, name: F.when(
            name != "", F.struct(c["rank"], c["pre"], c["url"], name.alias("name"))
        )
        return F.aggregate(
            run,
            F.lit(None).cast(_NAMED),
            lambda found, c: F.when(found.isNotNull(), found).otherwise(
                let(name_of(c), lambda name: named(c, name))
            ),
        )

    def runs(s: Column) -> Column:
        begins = F.array_compact(
            F.transform(
                s, lambda c, i: F.when((i == 0) | (c["url"] != F.get(s, i - 1)["url"]), i)
            )
        )
        return let(
            begins,
            lambda b: F.transform(
                b,
                lambda at, j: first_of(
                    F.slice(s, at + 1, F.coalesce(F.get(b, j + 1), F.size(s)) - at)
                ),
            ),
        )

    return F.array_sort(F.array_compact(let(F.array_sort(cards), runs)))


def _card_urls(
    page: Page, cards: Column, links: Column, wanted: Callable[[Column], Column]
) -> Column:
    """``url, rank, pre, anchor`` of the cards whose anchor leads to a wanted URL."""
    base = page.profile.base_url
    with_url = F.transform(
        cards,
        lambda c: let(
            page.anchor(links, c),
            lambda a: F.struct(
                let(page.attr(a, "href"), lambda h: resolve_url(h, base)).alias("url"),
                c["rank"].alias("rank"),
                c["pre"].alias("pre"),
                a["pre"].alias("anchor"),
            ),
        ),
    )
    return F.filter(with_url, lambda c: c["anchor"].isNotNull() & wanted(c["url"]))


@built_once
def campaign_cards(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Campaigns of a home page: ``pos, name, url, end_date``."""
    page = Page(profile)

    def name_of(c: Column, spans: Spans) -> Column:
        number = F.regexp_extract(c["url"], r"(?U)/catalog/(\d+)", 1)
        fallback = F.when(number != "", F.concat(F.lit(profile.nameless_campaign), number)).otherwise("")
        found = let(
            page.at(c["pre"]),
            lambda card: let(
                page.at(c["anchor"]), lambda a: campaign_name(page, card, a, spans)
            ),
        )
        return let(found, lambda n: F.when(F.length(n) >= 2, n).otherwise(fallback))

    names = profile.campaign_name_first + profile.campaign_name_later
    kept = page.with_spans(
        names,
        lambda spans: let(
            page.links(),
            lambda links: _first_named(
                _card_urls(
                    page, page.cards(profile.campaign_cards, links), links,
                    lambda u: is_campaign_url(u, profile),
                ),
                lambda c: name_of(c, spans),
            ),
        ),
    )
    return F.transform(
        kept,
        lambda c, i: F.struct(
            i.alias("pos"), c["name"], c["url"],
            let(page.at(c["pre"]), lambda n: card_end_date(page, n)).alias("end_date"),
        ),
    )


@built_once
def product_cards(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Products of a listing page: ``pos, product_url, product_name``."""
    page = Page(profile)
    kept = page.with_spans(
        profile.product_name,
        lambda spans: let(
            page.links(),
            lambda links: _first_named(
                _card_urls(
                    page, page.cards(profile.product_cards, links), links,
                    lambda u: is_product_url(u, profile),
                ),
                lambda c: let(
                    page.at(c["pre"]),
                    lambda card: let(
                        page.at(c["anchor"]), lambda a: product_name(page, card, a, spans)
                    ),
                ),
            ),
        ),
    )
    return F.transform(
        kept,
        lambda c, i: F.struct(
            i.alias("pos"), c["url"].alias("product_url"), c["name"].alias("product_name")
        ),
    )


def subpages(campaign_url: Column | str = "url", profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Sub-page links of a campaign page in order: ``url, label``.

    Category-tree links, then navigation links; repeats stay. The active
    category, which has no link, goes first under the campaign's own URL.
    """
    build = _subpages if isinstance(campaign_url, str) else _subpages.__wrapped__
    return build(campaign_url, profile)


@built_once
def _subpages(campaign_url: Column | str, profile: SiteProfile) -> Column:
    page = Page(profile)
    own = as_col(campaign_url)
    resolve = lambda h: resolve_url(h, profile.base_url)
    tree = F.coalesce(*[page.find_any(page.nodes, group) for group in profile.category_tree])

    def entry(li: Column, links: Column) -> Column:
        return let(
            page.anchor(links, li),
            lambda a: F.struct(
                F.coalesce(let(a["attrs"]["href"], resolve), F.lit("")).alias("url"),
                F.when(a.isNull(), page.text(li)).otherwise(page.text(a)).alias("label"),
                a.isNull().alias("active"),
            ),
        )

    def combine(entries: Column, nav: Column) -> Column:
        pair = lambda e: F.struct(e["url"].alias("url"), e["label"].alias("label"))
        listing = lambda e: is_listing_url(e["url"], profile)
        active = F.filter(entries, lambda e: e["active"] & (e["label"] != "") & (own != ""))
        front = F.transform(
            F.slice(active, 1, 1),
            lambda e: F.struct(resolve(own).alias("url"), e["label"].alias("label")),
        )
        tree_links = F.filter(entries, lambda e: ~e["active"] & listing(e))
        merged = F.concat(front, F.transform(tree_links, pair), F.filter(nav, listing))
        return _first_per_url(merged) if profile.strict_fix else merged

    def nav_links(links: Column, spans: Spans) -> Column:
        picked = F.concat(*[page.select(links, sel, spans) for sel in profile.nav_links])
        return F.transform(
            picked,
            lambda n: F.struct(
                let(page.attr(n, "href"), resolve).alias("url"), page.text(n).alias("label")
            ),
        )

    none = F.expr("cast(array() as array<struct<url:string,label:string,active:boolean>>)")

    def tree_entries(links: Column) -> Column:
        return let(
            tree,
            lambda t: F.coalesce(
                F.transform(
                    F.filter(page.below(t), lambda n: n["tag"] == "li"), lambda n: entry(n, links)
                ),
                none,
            ),
        )

    return page.with_spans(
        profile.nav_links,
        lambda spans: let(
            page.links(),
            lambda links: let(
                tree_entries(links), lambda entries: combine(entries, nav_links(links, spans))
            ),
        ),
    )


def _first_per_url(pairs: Column) -> Column:
    """First pair per URL, order kept."""
    numbered = F.transform(pairs, lambda p, i: F.struct(p["url"], i.alias("i"), p["label"]))
    kept = F.transform(
        distinct_by_first(numbered, "url"), lambda p: F.struct(p["i"], p["url"], p["label"])
    )
    return F.transform(F.array_sort(kept), lambda p: F.struct(p["url"], p["label"]))


def listing_plan(
    pairs: Column | str, campaign_url: Column | str, most: int | None = DEFAULT_PROFILE.max_subpages
) -> Column:
    """The first ``most`` sub-pages, or all, and the campaign's own page in front when
    they lack it (C25). One array per campaign page: no join is needed."""
    own = as_col(campaign_url)
    main = F.array(F.struct(own.alias("url"), F.lit(MAIN_LISTING).alias("label")))
    return let(
        as_col(pairs) if most is None else F.slice(as_col(pairs), 1, most),
        lambda kept: F.when(
            F.exists(kept, lambda p: same_url_key(p["url"]) == same_url_key(own)), kept
        ).otherwise(F.concat(main, kept)),
    )


def labels_text(pairs: Column | str) -> Column:
    """Non-empty labels in order, joined by ', ' (A3)."""
    labels = F.transform(as_col(pairs), lambda p: clean_text(p["label"]))
    return F.array_join(F.filter(labels, lambda t: t != ""), ", ")
