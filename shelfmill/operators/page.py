"""Column expressions over one page's tree (``nodes``, ``texts``, ``objects``).

All work stays inside the page's row. The element array is in document order,
so the subtree of ``n`` is ``nodes[n.pre + 1 .. n.last]``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import as_col, blank_to_null, first, let
from ..functions.text import clean_text
from ..rules import DEFAULT_PROFILE, LINK, Marks, Sel, SiteProfile
from .tree import OWN_TEXT_TAGS

Spans = dict[Sel, Column]


def marked_any(n: Column, sels: Sequence[Sel], marks: Marks | None) -> Column | None:
    """Does a node carry the mark of one of the selectors? What they ask of
    ancestors is left out. None if a selector has no mark."""
    mask = marks.mask(sels) if marks else None
    return None if mask is None else n[marks.field].bitwiseAND(F.lit(mask).cast("long")) != 0


def matches(n: Column, sel: Sel, spans: Spans | None = None, marks: Marks | None = None) -> Column:
    """Does a node pass the selector (D4, and D5 through ``spans``)? The tests
    are never null for a node, so that a failed one ends the evaluation."""
    tests = []
    own = marked_any(n, [sel], marks)
    if own is not None:
        tests.append(own)
    else:
        if sel.tag:
            tests.append(n["tag"] == sel.tag)
        if sel.attr:
            value = n["attrs"][sel.attr]
            no = F.lit(False)
            tests.append(
                {
                    "has": lambda: F.map_contains_key(n["attrs"], sel.attr),
                    "is": lambda: value.eqNullSafe(F.lit(sel.value)),
                    "part": lambda: F.coalesce(value.contains(sel.value), no),
                    "word": lambda: F.coalesce(F.array_contains(F.split(value, " "), sel.value), no),
                }[sel.how]()
            )
    if sel.inside:
        tests.append(within(n, spans[sel.inside]))
    result = tests[0]
    for test in tests[1:]:
        result = result & test
    return result


def within(n: Column, spans: Column) -> Column:
    """Is the node a descendant of any of the (outermost) spans?"""
    return F.exists(spans, lambda s: (n["pre"] > s["pre"]) & (n["pre"] <= s["last"]))


def outermost(found: Column) -> Column:
    """Spans not inside another one, from nodes in document order; one pass."""
    zero = F.expr("named_struct('last', -1, 'kept', cast(array() as array<struct<pre:int,last:int>>))")
    merged = F.aggregate(
        found,
        zero,
        lambda acc, n: F.when(n["pre"] <= acc["last"], acc).otherwise(
            F.struct(
                n["last"].alias("last"),
                F.array_append(
                    acc["kept"], F.struct(n["pre"].alias("pre"), n["last"].alias("last"))
                ).alias("kept"),
            )
        ),
    )
    return merged["kept"]


def rank(n: Column, sels: Sequence[Sel], spans: Spans, marks: Marks | None = None) -> Column:
    """Index of the first selector that the node passes; null if none."""
    cases = F.when(matches(n, sels[0], spans, marks), 0)
    for i, sel in enumerate(sels[1:], 1):
        cases = cases.when(matches(n, sel, spans, marks), i)
    some = marked_any(n, sels, marks)
    if some is not None:
        return F.when(some, cases)
    if all(sel.attr for sel in sels):  # text and bare elements need no look
        return F.when(F.size(n["attrs"]) > 0, cases)
    return cases


def matches_any(n: Column, sels: Sequence[Sel], marks: Marks | None = None) -> Column:
    """Does a node pass one of the selectors, which ask nothing of ancestors?"""
    result = marked_any(n, sels, marks)
    if result is None:
        result = matches(n, sels[0])
        for sel in sels[1:]:
            result = result | matches(n, sel)
    return result


class Page:
    """The tree columns of a shredded page, with the site's rules."""

    def __init__(self, profile: SiteProfile = DEFAULT_PROFILE) -> None:
        self.profile = profile
        self.marks = profile.marks
        self.nodes = F.col("nodes")
        self.texts = F.col("texts")
        self.objects = F.col("objects")

    # -- nodes ---------------------------------------------------------
    def at(self, pre: Column) -> Column:
        return F.get(self.nodes, pre)

    def root(self) -> Column:
        return self.at(F.lit(0))

    def parent(self, n: Column) -> Column:
        return self.at(n["parent"])

    def below(self, n: Column) -> Column:
        """Descendants of a node, in document order."""
        return F.slice(self.nodes, n["pre"] + 2, n["last"] - n["pre"])

    def pieces(self, n: Column) -> Column:
        """Text pieces of a node, in document order."""
        return F.slice(self.texts, n["t0"] + 1, n["t1"] - n["t0"])

    def text(self, n: Column) -> Column:
        """All text of a node, cleaned (D2); null only for a null node."""
        return F.when(n["tag"].isin(*OWN_TEXT_TAGS), clean_text(n["text"])).otherwise(
            F.array_join(self.pieces(n), " ")
        )

    def page_text(self) -> Column:
        return F.array_join(self.texts, " ")

    def attr(self, n: Column, name: str) -> Column:
        """Cleaned attribute, '' when absent (D3)."""
        return clean_text(n["attrs"][name])

    # -- selections ----------------------------------------------------
    def with_spans(self, sels: Sequence[Sel], body: Callable[[Spans], Column]) -> Column:
        """Bind the ancestor spans that the selectors need, each once per page."""
        wanted = list(dict.fromkeys(s.inside for s in sels if s.inside))

        def bind(left: list[Sel], spans: Spans) -> Column:
            if not left:
                return body(spans)
            found = outermost(F.filter(self.nodes, lambda n: matches(n, left[0], None, self.marks)))
            return let(found, lambda s: bind(left[1:], spans | {left[0]: s}))

        return bind(wanted, {})

    def select(self, scope: Column, sel: Sel, spans: Spans | None = None) -> Column:
        """All matches in an array of nodes."""
        return F.filter(scope, lambda n: matches(n, sel, spans, self.marks))

    def rank(self, n: Column, sels: Sequence[Sel], spans: Spans | None = None) -> Column:
        """Index of the first selector that the node passes; null if none."""
        return rank(n, sels, spans or {}, self.marks)

    def is_any(self, n: Column, sels: Sequence[Sel]) -> Column:
        """Does a node pass one of the selectors, by one look at its marks where they have some?"""
        return matches_any(n, sels, self.marks)

    def _passes(self, n: Column, sels: Sequence[Sel], spans: Spans | None) -> Column:
        if any(sel.inside for sel in sels):
            return self.rank(n, sels, spans).isNotNull()
        marked = marked_any(n, sels, self.marks)
        return self.rank(n, sels, spans).isNotNull() if marked is None else marked

    def find(self, scope: Column, sel: Sel, spans: Spans | None = None) -> Column:
        """First match in an array of nodes."""
        return first(self.select(scope, sel, spans))

    def passing(self, scope: Column, sels: Sequence[Sel], spans: Spans | None = None) -> Column:
        """The few nodes that pass some selector, in one look at all of them."""
        return F.filter(scope, lambda n: self._passes(n, sels, spans))

    def find_any(self, scope: Column, sels: Sequence[Sel]) -> Column:
        """First node that passes any of the selectors."""
        return first(F.filter(scope, lambda n: self.is_any(n, sels)))

    def all_matches(self, sels: Sequence[Sel]) -> Column:
        """Union of matches, each node once, by (selector, document) order
        (D7): ``rank, pre, last, tag, links`` structs."""
        ranked = lambda spans: F.array_sort(
            F.transform(
                self.passing(self.nodes, sels, spans),
                lambda n: F.struct(
                    self.rank(n, sels, spans).alias("rank"), n["pre"].alias("pre"),
                    n["last"].alias("last"), n["tag"].alias("tag"), n["links"].alias("links"),
                ),
            )
        )
        return self.with_spans(sels, ranked)

    def first_match(self, sels: Sequence[Sel]) -> Column:
        """First node of the first selector that finds any (D6, strict form)."""
        return let(first(self.all_matches(sels)), lambda r: self.at(r["pre"]))

    def first_passing(
        self, scope: Column, sels: Sequence[Sel], pick: Callable[[Column], Column],
        spans: Spans | None = None,
    ) -> list[Column]:
        """``pick`` of each selector's first node, in turn until one is not null
        (D6, loop form). To be put in ``coalesce``."""
        if len(sels) == 1:
            return [let(self.find(scope, sels[0], spans), pick)]
        return [let(
            self.passing(scope, sels, spans),
            lambda few: F.coalesce(*[let(self.find(few, sel, spans), pick) for sel in sels]),
        )]

    def links(self) -> Column:
        """All ``a[href]`` nodes."""
        return F.filter(self.nodes, lambda n: matches(n, LINK))

    def anchor(self, links: Column, card: Column) -> Column:
        """A card's anchor: itself if it is ``a``, else its first link.
        ``card.links`` counts the links up to the card, so this is a lookup."""
        found = let(F.get(links, card["links"]), lambda a: F.when(a["pre"] <= card["last"], a))
        return F.when(card["tag"] == "a", self.at(card["pre"])).otherwise(found)

    def cards(self, sels: Sequence[Sel], links: Column) -> Column:
        """Cards by selector, or all links on a page without any."""
        every_link = F.transform(
            links,
            lambda n: F.struct(
                F.lit(0).alias("rank"), n["pre"].alias("pre"), n["last"].alias("last"),
                n["tag"].alias("tag"), n["links"].alias("links"),
            ),
        )
        return let(
            self.all_matches(sels), lambda c: F.when(F.size(c) > 0, c).otherwise(every_link)
        )

    def next_siblings(self, n: Column, most: int = 5) -> Column:
        """Up to ``most`` following siblings, text and comments too.
        White-space siblings count, so ``sib`` decides, not the array."""
        found, here = [], n
        for _ in range(most):
            here = self._sibling(here)
            found.append(here)
        near = F.filter(
            F.array(*found), lambda s: s.isNotNull() & (s["sib"] <= n["sib"] + most)
        )
        return near

    def _sibling(self, n: Column) -> Column:
        return let(self.at(n["last"] + 1), lambda s: F.when(s["parent"] == n["parent"], s))

    def strings_after(self, container: Column, labels: Column, most: int) -> Column:
        """Pieces that follow the container's first label (D10). ``labels``:
        positions of all label pieces of the page."""
        hit = first(F.filter(labels, lambda i: (i >= container["t0"]) & (i < container["t1"])))
        after = lambda k: F.slice(
            self.texts, k + 2, F.least(F.lit(most), container["t1"] - k - 1)
        )
        none = F.array().cast("array<string>")
        return let(hit, lambda k: F.coalesce(F.when(k.isNotNull(), after(k)), none))

    def ancestors(self, n: Column, most: int = 4) -> Column:
        """Nearest ancestors, nearest first."""
        found, here = [], n
        for _ in range(most):
            here = self.parent(here)
            found.append(here)
        return F.array_compact(F.array(*found))


def present(x: Column | str) -> Column:
    return blank_to_null(as_col(x))
