"""Product pages: name, description, prices, colours, sizes, image."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.colors import color_from_name, color_from_phrase, is_bad_color, is_color_label, last_part
from ..functions.columns import (
    any_of, as_col, blank_to_null, built_once, distinct_by_first, first, let, strings,
)
from ..functions.jsonwalk import LINKED_DATA
from ..functions.prices import (
    choose_pair, discount_label, discount_pct, format_price, normalize_price,
    price_candidates, price_pair,
)
from ..functions.sizes import (
    is_numeric_size, size_tokens, sorted_size_text, stock_priority, stock_state, stock_status,
)
from ..functions.text import clean_text
from ..rules import DEFAULT_PROFILE, SiteProfile, has, tag
from .page import Page, outermost, present, within

_PAIRS = (
    "array<struct<ord:struct<src:int,scope:int,sel:int,pre:int>,"
    "original:double,current:double,source:string>>"
)


def detail_name(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """First heading's text, '' when it is empty."""
    page = Page(profile)
    return F.coalesce(
        let(page.first_match(profile.detail_name), lambda n: page.text(n)), F.lit("")
    )


def detail_description(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Meta description, description block of 20 characters, or the first
    block of more than 50 characters (C9)."""
    page = Page(profile)

    def pick(n: Column) -> Column:
        meta = F.when(n["tag"] == "meta", present(page.attr(n, "content")))
        block = F.when((n["tag"] != "meta") & (n["chars"] >= 20), page.text(n))
        return F.coalesce(meta, block)

    long_block = F.filter(
        page.nodes, lambda n: n["tag"].isin(*profile.description_tags) & (n["chars"] > 50)
    )
    return F.coalesce(
        *page.first_passing(page.nodes, profile.description, pick),
        let(first(long_block), lambda n: page.text(n)),
        F.lit(""),
    )


# -- prices ------------------------------------------------------------
def _pair(src: int, scope: Column, sel: Column, pre: Column, prices: Column, source: Column) -> Column:
    """One candidate; ``ord`` is its place in the order of discovery."""
    return F.struct(
        F.struct(
            F.lit(src).alias("src"), scope.alias("scope"), sel.alias("sel"), pre.alias("pre")
        ).alias("ord"),
        prices["original"].alias("original"),
        prices["current"].alias("current"),
        source.alias("source"),
    )


def _none_if_null(pairs: Column) -> Column:
    return F.coalesce(pairs, F.expr(f"cast(array() as {_PAIRS})"))


def _key_price(members: Column, keys: tuple[str, ...]) -> Column:
    """First key, in list order, whose value is a price; last duplicate wins,
    and a nested value is no price (J3)."""

    def price(key: Column) -> Column:
        last = F.element_at(F.filter(members, lambda m: F.lower(m["key"]) == key), -1)
        return let(last, lambda m: F.when(m["kind"] != "nested", normalize_price(m["value"])))

    known = F.filter(
        strings(keys), lambda k: F.exists(members, lambda m: F.lower(m["key"]) == k)
    )
    return first(F.filter(F.transform(known, price), lambda v: v.isNotNull()))


def json_price_pairs(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Price pairs of script objects (J4). Linked data is read whole, other
    scripts by their flat objects."""
    page = Page(profile)
    script_type = lambda o: F.lower(F.trim(F.coalesce(page.at(o["script"])["attrs"]["type"], F.lit(""))))
    wanted = F.filter(
        page.objects, lambda o: (script_type(o) == LINKED_DATA) == (o["part"] == 0)
    )

    def pair(o: Column) -> Column:
        original = _key_price(o["members"], profile.original_price_keys)
        current = _key_price(o["members"], profile.current_price_keys)
        both = F.struct(original.alias("original"), current.alias("current"))
        shifted = let(
            both,
            lambda b: F.when(b["current"].isNotNull(), b).otherwise(
                F.struct(F.lit(None).cast("double").alias("original"), b["original"].alias("current"))
            ),
        )
        return let(
            shifted,
            lambda s: _pair(0, F.lit(0), o["ord"], F.lit(0), s, F.lit("json")),
        )

    return F.filter(F.transform(wanted, pair), lambda p: p["current"].isNotNull())


def _price_scopes(page: Page) -> Column:
    """Four ancestors of the first ``h1``, then marked blocks, each once;
    the whole page when there is none (D8). In order, as nodes' spans."""
    p = page.profile
    span = lambda n: F.struct(n["pre"], n["last"], n["t0"], n["t1"])
    heading = page.find(page.nodes, tag("h1"))
    none = F.expr("cast(array() as array<struct<pre:int,last:int,t0:int,t1:int>>)")
    above = let(
        heading,
        lambda h: F.coalesce(F.transform(page.ancestors(h), span), none),
    )
    blocks = F.transform(
        page.all_matches(p.price_scopes), lambda r: let(page.at(r["pre"]), span)
    )
    return let(
        F.array_distinct(F.concat(above, blocks)),
        lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(span(page.root()))),
    )


def scope_price_pairs(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Price pairs of marked nodes and whole texts of the scopes.

    A node counts once, at its first scope and selector: repeats hold the same
    pair and can only lose a tie. Scopes with the same text likewise.
    """
    page = Page(profile)
    whole = len(profile.price_nodes)

    def node_pair(n: Column, scopes: Column) -> Column:
        scope = F.array_position(
            F.transform(scopes, lambda s: (n["pre"] > s["pre"]) & (n["pre"] <= s["last"])), F.lit(True)
        ).cast("int")
        meta = F.struct(
            F.lit(None).cast("double").alias("original"),
            normalize_price(n["attrs"]["content"]).alias("current"),
        )
        text = let(page.text(n), lambda t: let(price_candidates(t, profile), price_pair))
        is_meta = n["tag"] == "meta"
        prices = F.when(is_meta, meta).otherwise(text)
        return let(
            F.when(scope > 0, prices),
            lambda v: _pair(
                1, scope, page.rank(n, profile.price_nodes), n["pre"], v,
                F.when(is_meta, "meta").otherwise("local_node"),
            ),
        )

    def scope_pair(s: Column, i: Column) -> Column:
        text = F.array_join(page.pieces(s), " ")
        return let(
            let(text, lambda t: let(price_candidates(t, profile), price_pair)),
            lambda v: _pair(1, i + 1, F.lit(whole), s["pre"], v, F.lit("local_text")),
        )

    def collect(scopes: Column) -> Column:
        marked = F.filter(page.nodes, lambda n: page.is_any(n, profile.price_nodes))
        texts = F.transform(scopes, lambda s: F.struct(s["t0"], s["t1"]))
        by_text = let(
            texts,
            lambda ts: F.transform(
                scopes,
                lambda s, i: F.when(
                    F.array_position(ts, F.struct(s["t0"], s["t1"])) == i + 1, scope_pair(s, i)
                ),
            ),
        )
        return F.filter(
            F.concat(F.transform(marked, lambda n: node_pair(n, scopes)), by_text),
            lambda p: p["current"].isNotNull(),
        )

    return let(_price_scopes(page), collect)


def page_price_pairs(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Price pair of the page's whole text (C11)."""
    page = Page(profile)
    found = let(page.page_text(), lambda t: let(price_candidates(t, profile), price_pair))
    return let(
        found,
        lambda v: F.when(
            v.isNotNull(), F.array(_pair(2, F.lit(0), F.lit(0), F.lit(0), v, F.lit("page")))
        ),
    )


def detail_prices(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """``original_price, discount_price, discount_percentage`` texts (C14)."""
    page = Page(profile)
    label = discount_label(page.page_text())
    local = F.concat(json_price_pairs(profile), scope_price_pairs(profile))
    pairs = let(
        local,
        lambda p: F.when(F.size(p) > 0, p).otherwise(_none_if_null(page_price_pairs(profile))),
    )

    def shown(best: Column, disc: Column) -> Column:
        filled = F.when(
            (disc == "") & best["original"].isNotNull(),
            discount_pct(best["original"], best["current"]),
        ).otherwise(disc)
        return F.struct(
            format_price(best["original"]).alias("original_price"),
            format_price(best["current"]).alias("discount_price"),
            filled.alias("discount_percentage"),
        )

    return let(
        label, lambda disc: let(let(pairs, lambda p: choose_pair(p, disc)), lambda b: shown(b, disc))
    )


# -- colours -----------------------------------------------------------
def variant_colors(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Distinct colours of the variant thumbnails, in order (C18, first part)."""
    page = Page(profile)
    items = F.filter(
        page.nodes, lambda n: n["attrs"]["data-testid"].rlike(f"(?U){profile.variant_test_id}")
    )

    def color(item: Column) -> Column:
        image = page.find(page.below(item), has("alt", "img"))
        return let(
            last_part(page.attr(image, "alt")),
            lambda c: F.when(~is_bad_color(c, profile), c),
        )

    return F.array_distinct(F.array_compact(F.transform(items, color)))


def _label_places(page: Page) -> Column:
    """Positions of the text pieces that are a colour label."""
    places = F.transform(
        page.texts, lambda t, i: F.when(is_color_label(t, page.profile), i)
    )
    return F.array_compact(places)


def _good(colors: Column, profile: SiteProfile) -> Column:
    return F.filter(colors, lambda c: ~is_bad_color(c, profile))


def label_color(page: Page, places: Column) -> Column:
    """First good text beside a 'Color:' label, null if none."""
    p = page.profile
    labelled = F.filter(
        page.nodes,
        lambda n: n["tag"].isin(*p.color_label_tags)
        & (n["t1"] - n["t0"] == 1)
        & F.array_contains(places, n["t0"]),
    )

    def beside(n: Column) -> Column:
        texts = F.transform(
            page.next_siblings(n),
            lambda s: F.when(s["tag"] == "#comment", clean_text(s["text"])).otherwise(page.text(s)),
        )
        after = let(page.parent(n), lambda box: page.strings_after(box, places, 3))
        return F.concat(texts, after)

    return first(_good(F.flatten(F.transform(labelled, beside)), p))


def semantic_color(page: Page, places: Column) -> Column:
    """Shortest good text within four pieces after a label in the block
    around it, null if none (C16)."""
    p = page.profile
    label_nodes = F.filter(
        page.nodes,
        lambda n: ((n["tag"] == "#text") & F.array_contains(places, n["t0"]))
        | ((n["tag"] == "#comment") & is_color_label(clean_text(n["text"]), p)),
    )

    def around(n: Column) -> Column:
        box = let(page.parent(n), lambda up: F.coalesce(page.parent(up), up))
        return let(box, lambda b: page.strings_after(b, places, 4))

    candidates = _good(F.flatten(F.transform(label_nodes, around)), p)
    by_length = F.transform(candidates, lambda c: F.struct(F.length(c).alias("n"), c.alias("c")))
    return F.array_min(by_length)["c"]


def attribute_color(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """First good colour of an element's attributes or short text (C17)."""
    page = Page(profile)
    good = lambda c: F.when(~is_bad_color(c, profile), c)

    def of(n: Column) -> Column:
        phrase = lambda text: let(color_from_phrase(text, profile), good)
        short = n["chars"].between(1, 30)
        given = lambda name, then: F.when(n["attrs"][name].isNotNull(), then(page.attr(n, name)))
        of_attributes = F.coalesce(
            *[given(a, lambda v: let(v, good)) for a in profile.color_attrs],
            given("aria-label", phrase), given("title", phrase),
        )
        return F.coalesce(F.when(F.size(n["attrs"]) > 0, of_attributes), F.when(short, phrase(page.text(n))))

    elements = F.filter(
        page.nodes,
        lambda n: (F.size(n["attrs"]) > 0) | (n["chars"].between(1, 30) & ~n["tag"].startswith("#")),
    )
    return first(F.filter(F.transform(elements, of), lambda c: c.isNotNull()))


def json_color(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """First good value of a colour key in script objects."""
    page = Page(profile)
    keyed = lambda o: F.filter(
        o["members"], lambda m: F.lower(m["key"]).isin(*profile.color_keys)
    )
    empty = lambda m: (m["kind"] != "text") & m["value"].isin(
        "None", "False", "0", "0.0", "-0.0", "[]", "{}"
    )
    values = F.transform(
        F.flatten(F.transform(page.objects, keyed)),
        lambda m: F.when(empty(m), "").otherwise(clean_text(m["value"])),
    )
    return first(_good(values, profile))


def detail_color_parts(profile: SiteProfile = DEFAULT_PROFILE) -> tuple[Column, Column]:
    """Colours that come before and after the product name in the order of
    trust (C18); the name's own colour is put between them later."""
    page = Page(profile)
    before = F.coalesce(
        let(variant_colors(profile), lambda c: F.when(F.size(c) > 0, F.array_join(c, " | "))),
        let(
            _label_places(page),
            lambda places: F.coalesce(label_color(page, places), semantic_color(page, places)),
        ),
        F.lit(""),
    )
    after = F.coalesce(attribute_color(profile), json_color(profile), F.lit(""))
    return before, after


# -- sizes -------------------------------------------------------------
_SIZES = "array<struct<size:string,status:string>>"


def _size_areas(page: Page) -> Column:
    """Outermost spans around size menus and size labels."""
    p = page.profile

    def near(n: Column) -> Column:
        menu = page.is_any(n, p.size_areas)
        up = page.parent(n)
        return F.array_compact(F.array(F.when(menu, n), up, page.parent(up)))

    seeds = F.filter(
        page.nodes,
        lambda n: page.is_any(n, p.size_areas)
        | (
            n["tag"].isin(*p.size_word_tags)
            & n["chars"].between(1, max(map(len, p.size_words)))
            & F.lower(page.text(n)).isin(*p.size_words)
        ),
    )
    spans = F.transform(
        F.flatten(F.transform(seeds, near)),
        lambda n: F.struct(n["pre"].alias("pre"), (-n["last"]).alias("neg"), n["last"].alias("last")),
    )
    return outermost(F.array_sort(F.array_distinct(spans)))


def _strongest(pairs: Column) -> Column:
    """Per size, the highest stock priority (A5), from ``size, prio`` structs."""
    down = F.transform(pairs, lambda s: F.struct(s["size"].alias("size"), (-s["prio"]).alias("neg")))
    return F.transform(
        distinct_by_first(down, "size"),
        lambda s: F.struct(s["size"].alias("size"), stock_state(-s["neg"]).alias("status")),
    )


def menu_sizes(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Sizes and stock states of the size menus: ``size, status`` structs."""
    page = Page(profile)
    p = profile

    def sizes_of(n: Column) -> Column:
        texts = [page.text(n)] + [page.attr(n, a) for a in p.size_text_attrs]
        combined = F.array_join(F.filter(F.array(*texts), lambda t: t != ""), " | ")

        def states(text: Column, tokens: Column) -> Column:
            many = F.size(F.filter(tokens, is_numeric_size)) > 5
            skip = F.upper(text).rlike(any_of(p.size_skip_words)) | (
                many & n["tag"].isin("div", "span")
            )
            status = stock_status(page.text(n), n["attrs"], n["tag"], text, p)
            pairs = let(
                stock_priority(status),
                lambda prio: F.transform(
                    tokens, lambda t: F.struct(t.alias("size"), prio.alias("prio"))
                ),
            )
            return F.when((F.size(tokens) > 0) & ~skip, pairs)

        return let(combined, lambda c: let(size_tokens(c, p), lambda t: states(c, t)))

    def inside(areas: Column, sels: tuple) -> Column:
        return F.filter(page.nodes, lambda n: page.is_any(n, sels) & within(n, areas))

    def items(areas: Column) -> Column:
        return let(
            inside(areas, p.size_items),
            lambda found: F.when(F.size(found) > 0, found).otherwise(
                inside(areas, p.size_containers)
            ),
        )

    def states(areas: Column) -> Column:
        per_item = F.array_compact(F.transform(items(areas), sizes_of))
        return _strongest(F.flatten(per_item))

    return let(
        _size_areas(page),
        lambda areas: F.when(F.size(areas) > 0, states(areas)).otherwise(
            F.expr(f"cast(array() as {_SIZES})")
        ),
    )


def json_sizes(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Sizes of whole JSON scripts (J6): OK if any object says so, else OUT."""
    page = Page(profile)
    p = profile
    about_sizes = lambda o: F.lower(page.at(o["script"])["text"]).rlike(any_of(p.size_script_words))
    wanted = F.filter(page.objects, lambda o: (o["part"] == 0) & about_sizes(o))

    def of(o: Column) -> Column:
        key = lambda m: F.lower(m["key"])
        out = F.exists(
            o["members"],
            lambda m: key(m).isin(*p.availability_keys)
            & F.lower(m["value"]).isin(*p.unavailable_values),
        )
        named = F.filter(
            o["members"],
            lambda m: key(m).isin(*p.size_keys) & m["kind"].isin("text", "number", "flag"),
        )
        tokens = F.flatten(F.transform(named, lambda m: size_tokens(m["value"], p)))
        # OK outranks OUT here, the reverse of the menus.
        rank_of = F.when(out, 2).otherwise(1)
        return F.transform(tokens, lambda t: F.struct(t.alias("size"), rank_of.alias("rank")))

    return F.transform(
        distinct_by_first(F.flatten(F.transform(wanted, of)), "size"),
        lambda s: F.struct(
            s["size"].alias("size"), F.when(s["rank"] == 1, "OK").otherwise("OUT").alias("status")
        ),
    )


def detail_sizes(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """'size:STATUS, …' text of a product page."""
    return let(
        menu_sizes(profile),
        lambda m: sorted_size_text(F.when(F.size(m) > 0, m).otherwise(json_sizes(profile))),
    )


def detail_image(profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Main image URL (C20)."""
    page = Page(profile)
    social = first(
        F.filter(
            page.nodes, lambda n: (n["tag"] == "meta") & (n["attrs"]["property"] == "og:image")
        )
    )

    def source(n: Column) -> Column:
        return F.coalesce(present(page.attr(n, "src")), present(page.attr(n, "data-src")))

    return page.with_spans(
        profile.image_selectors,
        lambda spans: F.coalesce(
            let(social, lambda m: blank_to_null(m["attrs"]["content"])),
            *page.first_passing(page.nodes, profile.image_selectors, source, spans),
            F.lit(""),
        ),
    )


@built_once
def detail_columns(profile: SiteProfile = DEFAULT_PROFILE) -> dict[str, Column]:
    """Everything a product page gives by itself (C21 without the stub)."""
    before, after = detail_color_parts(profile)
    return {
        "detail_name": detail_name(profile),
        "description": detail_description(profile),
        "price": detail_prices(profile),
        "color_before_name": before,
        "color_after_name": after,
        "image_url": detail_image(profile),
        "sizes_status": detail_sizes(profile),
    }


def complete_color(
    name: Column | str, before: Column | str, after: Column | str,
    profile: SiteProfile = DEFAULT_PROFILE,
) -> Column:
    """Colour of a product once its name is known."""
    return F.coalesce(
        present(before), present(color_from_name(name, profile)), as_col(after), F.lit("")
    )
