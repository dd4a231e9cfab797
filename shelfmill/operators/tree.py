"""Pages to element trees: one row per page, no shuffle.

``shred`` reads each HTML text once. A page stays one row and its elements
become an array in document order, so a subtree is a slice of the array and
the text of an element is a slice of ``texts``. All later page operators are
projections over that row; nothing is joined or grouped to work inside a page.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonwalk import MEMBER, script_objects
from ..rules import DEFAULT_PROFILE, Marks, SiteProfile

# ---- fixed values: elements without content, elements whose text is not shown ----
VOID_TAGS = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
    "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
    "param", "source", "spacer", "track", "wbr",
))
OWN_TEXT_TAGS = ("rp", "rt", "script", "style", "template")
# Elements whose content some version of the tokenizer reads as text.
RAW_TAGS = frozenset((
    "script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext",
))
# ---- end of fixed values ----
# Tags in plain form, which mean the same to every version of the tokenizer: quoted
# attributes set apart by white space. All else is left to the tokenizer.
_GAP, _NAME = r"[ \t\n\r\f]", r"[a-zA-Z][a-zA-Z0-9_:.-]*"
_START = re.compile(rf"""<([a-zA-Z][a-zA-Z0-9-]*)((?:{_GAP}+{_NAME}(?:="[^"<>]*"|='[^'<>]*')?)*){_GAP}*>""")
_END = re.compile(rf"</([a-zA-Z][a-zA-Z0-9-]*){_GAP}*>")
_ATTR = re.compile(rf"""({_NAME})(?:="([^"]*)"|='([^']*)')?""")

NODE_FIELDS = (
    "pre", "last", "parent", "depth", "sib", "tag", "attrs", "text", "t0", "t1", "chars", "links",
)
OBJECT_TYPE = f"struct<script:int,part:int,ord:int,members:array<{MEMBER}>>"
TREE_COLUMNS = ("nodes", "texts", "objects", "error")


def tree_types(marks: Marks) -> dict[str, str]:
    node = (
        "struct<pre:int,last:int,parent:int,depth:int,sib:int,tag:string,"
        f"attrs:map<string,string>,text:string,t0:int,t1:int,chars:int,links:int,{marks.field}:bigint>"
    )
    return dict(zip(TREE_COLUMNS, (f"array<{node}>", "array<string>", f"array<{OBJECT_TYPE}>", "string")))


_INTS = ("pre", "last", "parent", "depth", "sib", "t0", "t1", "chars", "links")
_PRE, _LAST, _PARENT, _DEPTH, _SIB, _T0, _T1, _CHARS, _LINKS = range(len(_INTS))
_BATCH_NODES = 50_000  # output batches stay small whatever the page sizes


class _Shredder(HTMLParser):
    """Reads pages one after another into columns of nodes.

    Positions (``parent``, ``last``, ``t0`` …) count from the page's start.
    """

    def __init__(
        self, keys: frozenset[str], nested: frozenset[str] = frozenset(), marks: Marks = DEFAULT_PROFILE.marks
    ) -> None:
        super().__init__(convert_charrefs=True)
        self.keys, self.nested, self.mark_field = keys, nested, marks.field
        # The element tests by what they look at first: the tag alone, or an attribute.
        self.tag_marks: dict[str, int] = {}
        self.attr_marks: dict[str, list] = {}
        for i, sel in enumerate(marks.sels):
            if sel.attr:
                self.attr_marks.setdefault(sel.attr, []).append((1 << i, sel))
            else:
                self.tag_marks[sel.tag] = self.tag_marks.get(sel.tag, 0) | 1 << i
        self.text_marks = self.tag_marks.get("#text", 0)
        self.clear()

    def clear(self) -> None:
        self.ints: list[list[int]] = []  # per node, by _INTS
        self.tags: list[str] = []
        self.attrs: list[dict] = []
        self.text: list[str | None] = []
        self.marks: list[int] = []
        self.known_marks: dict[tuple, int] = {}
        self.known_tags: dict[str, tuple[str, dict, int]] = {}  # plain start tags; values repeat
        self.texts: list[list[str]] = []
        self.objects: list[list[dict]] = []
        self.errors: list[str | None] = []
        self.sizes: list[int] = []

    # -- one page ------------------------------------------------------
    def read(self, html: str | None) -> None:
        """Append one page; a page that cannot be read leaves only its root."""
        start = len(self.tags)
        error = None
        self._begin()
        try:
            self.feed(html or "")
            self.close()
            self._flush()
            while self.open:
                self._close()
        except Exception as exc:  # goes to the reject table, not the run's end
            error = f"{type(exc).__name__}: {exc}"
            for column in (self.tags, self.attrs, self.text, self.marks, self.ints):
                del column[start:]
            self._begin()
            self._close()
        self.texts.append(self.pieces)
        self.errors.append(error)
        self.sizes.append(len(self.tags) - start)
        try:
            found = self._script_objects(start)
        except Exception as exc:  # too deeply nested to write out
            found, self.errors[-1] = [], f"{type(exc).__name__}: {exc}"
        self.objects.append(found)

    def _begin(self) -> None:
        self.reset()
        self.start = len(self.tags)
        self.pieces: list[str] = []
        self.ends = [0]  # characters up to and including each piece
        self.open: list[int] = []
        self.open_tags: dict[str, int] = {}
        self.kids: list[int] = []  # children so far of each open element
        self.holders: list[int] = []  # open elements that keep their own text
        self.pending: list[str] = []
        self.seen_links = 0
        self._add("#root", {}, None)
        self._enter("#root")

    def _marks(self, tag: str, attrs: dict) -> int:
        """The bits of the element tests that an element passes."""
        bits = self.tag_marks.get(tag, 0)
        for name in attrs:
            if name in self.attr_marks:
                seen = (tag, name, attrs[name])
                if seen not in self.known_marks:  # values repeat; forgotten with each batch
                    self.known_marks[seen] = self._attr_marks(*seen)
                bits |= self.known_marks[seen]
        return bits

    def _attr_marks(self, tag: str, name: str, value: str | None) -> int:
        bits = 0
        for bit, sel in self.attr_marks[name]:
            if not sel.tag or sel.tag == tag:
                if sel.how == "has" or value is not None and (
                    sel.value == value if sel.how == "is" else sel.value in (value if sel.how == "part" else value.split(" "))
                ):
                    bits |= bit
        return bits

    def _add(self, tag: str, attrs: dict, text: str | None, marks: int | None = None) -> int:
        at = len(self.tags)
        pre, seen = at - self.start, len(self.pieces)
        sib = 0
        if self.kids:
            sib = self.kids[-1]
            self.kids[-1] = sib + 1
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.marks.append(self._marks(tag, attrs) if marks is None else marks)
        self.text.append(text)
        opened = self.open
        parent = opened[-1] - self.start if opened else -1
        self.ints.append([pre, pre, parent, len(opened), sib, seen, seen, 0, self.seen_links])
        return at

    def _enter(self, tag: str) -> None:
        at = len(self.tags) - 1
        self.open.append(at)
        self.kids.append(0)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        if tag in OWN_TEXT_TAGS:
            self.holders.append(at)

    def _close(self) -> None:
        at = self.open.pop()
        self.kids.pop()
        tag, ints = self.tags[at], self.ints[at]
        self.open_tags[tag] -= 1
        ints[_LAST] = len(self.tags) - 1 - self.start
        ints[_T1] = len(self.pieces)
        if self.holders and self.holders[-1] == at:
            self.holders.pop()
            ints[_CHARS] = len(" ".join((self.text[at] or "").split()))
        elif len(self.pieces) > ints[_T0]:
            ints[_CHARS] = self.ends[-1] - self.ends[ints[_T0]] - 1

    def _flush(self) -> None:
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending.clear()
        piece = " ".join(data.split())
        if self.holders:
            held = self.text[self.holders[-1]]
            self.text[self.holders[-1]] = data if held is None else f"{held}\n{data}"
        if self.holders or not piece:  # still counts as a sibling
            self.kids[-1] += 1
            return
        ints = self.ints[self._add("#text", {}, None, self.text_marks)]
        self.pieces.append(piece)
        self.ends.append(self.ends[-1] + len(piece) + 1)
        ints[_T1] = len(self.pieces)
        ints[_CHARS] = len(piece)

    # -- tokens --------------------------------------------------------
    def goahead(self, end: bool) -> None:
        """Read plain tags and the text between them here, and give all else to
        the tokenizer, piece by piece. A piece that it does not finish is not as
        plain as it looks: then it gets the rest of the page."""
        if end or self.cdata_elem is not None:
            return super().goahead(end)
        html, i = self.rawdata, 0
        while (j := html.find("<", i)) >= 0:
            if j > i:
                data = html[i:j]
                self.pending.append(unescape(data) if "&" in data else data)
            found = _END.match(html, j)
            if found:
                self.handle_endtag(found[1].lower())
                i = found.end()
                continue
            found = _START.match(html, j)
            name = found[1].lower() if found else ""
            if found and name not in RAW_TAGS:
                self._plain_start(found[0], name, found[2])
                i = found.end()
                continue
            i = self._piece_end(html, j, name)
            self.rawdata = html[j:i]
            super().goahead(False)
            if self.rawdata or self.cdata_elem is not None:
                self.rawdata += html[i:]
                return super().goahead(False)
        self.rawdata = html[i:]
        super().goahead(False)

    def _piece_end(self, html: str, at: int, name: str) -> int:
        """Where what begins at ``at`` likely ends: a comment, an element of raw text, a tag."""
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4) + 2
        elif name:
            close = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(html, at)
            end = html.find(">", close.end() - 1) if close else -1
        else:
            end = html.find(">", at)
        return end + 1 if end > at else len(html)

    def _plain_start(self, written: str, tag: str, attrs: str) -> None:
        self._flush()
        known = self.known_tags.get(written)
        if known is None:
            values = {}
            for key, double, single in _ATTR.findall(attrs):
                value = double or single
                values[key.lower()] = unescape(value) if "&" in value else value
            if "class" in values:
                values["class"] = " ".join(values["class"].split())
            known = self.known_tags[written] = tag, values, self._marks(tag, values)
        self._start(*known)

    def _start(self, tag: str, values: dict, marks: int | None = None) -> None:
        at = self._add(tag, values, None, marks)
        if tag == "a" and "href" in values:
            self.seen_links += 1
            self.ints[at][_LINKS] = self.seen_links
        if tag not in VOID_TAGS:
            self._enter(tag)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        values = {k: v or "" for k, v in attrs}
        if "class" in values:
            values["class"] = " ".join(values["class"].split())
        self._start(tag, values)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close()

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if self.open_tags.get(tag):
            while self.tags[self.open[-1]] != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        if data:
            self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()
        self._add("#comment", {}, data)

    def handle_decl(self, decl: str) -> None:
        self._flush()
        self.kids[-1] += 1

    handle_pi = handle_decl

    def unknown_decl(self, data: str) -> None:
        self._flush()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[6:])
            self._flush()
        else:
            self.kids[-1] += 1

    # -- results -------------------------------------------------------
    def _script_objects(self, start: int) -> list[dict]:
        found = []
        for at in range(start, len(self.tags)):
            if self.tags[at] == "script" and self.text[at]:
                kind = self.attrs[at].get("type", "")
                for part, kept in script_objects(kind, self.text[at], self.keys, self.nested):
                    if kept:
                        found.append(
                            {"script": at - start, "part": part, "ord": len(found), "members": kept}
                        )
        return found

    def arrays(self) -> list[pa.Array]:
        """The tree columns of all pages read since the last ``clear``."""
        attrs = pa.MapArray.from_arrays(
            _offsets(map(len, self.attrs)),
            pa.array([k for a in self.attrs for k in a], pa.string()),
            pa.array([v for a in self.attrs for v in a.values()], pa.string()),
        )
        fields = {name: pa.array(values, pa.int32()) for name, values in zip(_INTS, list(zip(*self.ints)) or [()] * len(_INTS))}
        fields["tag"] = pa.array(self.tags, pa.string())
        fields["text"] = pa.array(self.text, pa.string())
        fields["attrs"] = attrs
        fields[self.mark_field] = pa.array(self.marks, pa.int64())
        names = (*NODE_FIELDS, self.mark_field)
        nodes = pa.ListArray.from_arrays(
            _offsets(self.sizes), pa.StructArray.from_arrays([fields[n] for n in names], names=names),
        )
        texts = pa.array(self.texts, pa.list_(pa.string()))
        errors = pa.array(self.errors, pa.string())
        return [nodes, texts, pa.array(self.objects, _OBJECTS), errors]


_MEMBER = pa.struct([("key", pa.string()), ("value", pa.string()), ("kind", pa.string())])
_OBJECTS = pa.list_(pa.struct([
    ("script", pa.int32()), ("part", pa.int32()), ("ord", pa.int32()), ("members", pa.list_(_MEMBER)),
]))


def _offsets(lengths: Iterable[int]) -> pa.Array:
    return pa.array(itertools.accumulate(lengths, initial=0), pa.int32())


def shred(
    pages: DataFrame, html: str = "html", profile: SiteProfile = DEFAULT_PROFILE
) -> DataFrame:
    """All columns but ``html``, plus ``nodes``, ``texts``, ``objects`` (JSON
    objects of scripts, wanted keys only) and ``error``. The one Python stage."""
    keep = [c for c in pages.columns if c != html]
    marks = profile.marks
    added = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in tree_types(marks).items()))
    schema = T.StructType([pages.schema[c] for c in keep] + added.fields)
    keys, nested = frozenset(profile.json_keys), frozenset(profile.color_keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Shredder(keys, nested, marks)
        for batch in batches:
            source, start = batch.column(len(keep)), 0
            for i in range(batch.num_rows):
                reader.read(source[i].as_py())
                if len(reader.tags) >= _BATCH_NODES or i + 1 == batch.num_rows:
                    done = i + 1 - start
                    kept = [batch.column(k).slice(start, done) for k in range(len(keep))]
                    names = keep + list(TREE_COLUMNS)
                    yield pa.RecordBatch.from_arrays(kept + reader.arrays(), names=names)
                    reader.clear()
                    start = i + 1

    return pages.select(*keep, html).mapInArrow(run, schema)


def read_trees(pages: pa.Array, profile: SiteProfile = DEFAULT_PROFILE) -> pa.Array:
    """The trees of a batch of pages, as structs of the tree columns."""
    reader = _Shredder(frozenset(profile.json_keys), frozenset(profile.color_keys), profile.marks)
    for page in pages:
        reader.read(page.as_py())
    return pa.StructArray.from_arrays(reader.arrays(), names=list(TREE_COLUMNS))


def nodes(tree: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per node: the tree as a table."""
    flat = tree.select(key, "texts", F.explode("nodes").alias("n"))
    shown = F.array_join(F.slice("texts", F.col("n.t0") + 1, F.col("n.t1") - F.col("n.t0")), " ")
    text = F.when(F.col("n.tag") == "#text", shown).otherwise(F.col("n.text"))
    names = ("pre", "last", "parent", "depth", "tag", "attrs")
    return flat.select(key, *[F.col(f"n.{c}").alias(c) for c in names], text.alias("text"))


def rejects(tree: DataFrame) -> DataFrame:
    """Pages that could not be read, with the reason."""
    return tree.filter(F.col("error").isNotNull()).drop("nodes", "texts", "objects")
