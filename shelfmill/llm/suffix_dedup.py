"""Removal of repeated byte strings by a sparse suffix array (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PrefixHash, cut, filter_of, in_filter, mix, read_documents

LEAST = 100  # bytes of a repeated string
TOKEN = 32  # bytes of a leading token
SPAN = LEAST - TOKEN  # an anchor lies at most so many bytes after a string's start
SAMPLED, PART_BYTES, PART_EDGES, FILTER_BITS = 100_000, 64 << 20, 100_000, 1 << 26
MIX = np.uint64(0x9FB21C651E98DF25)
SECOND = 0x2545F4914F6CDD1D  # seed of the second hash of a string
# A document: rows without id (last = 1) come after all others; rows of one id differ by a hash of the text.
DOC = ("last", "id", "tie")


# -- anchors: the suffixes that are sorted -----------------------------------------------------

def anchors_of(data: np.ndarray, hashes: PrefixHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions, token hashes, context hashes and right lengths of a text's
    anchors. Of the tokens in each string of ``LEAST`` bytes the one with the
    smallest hash, the leftmost of equals, is its anchor. Equal strings have
    their anchor at the same place, so suffixes that start at anchors find all
    repeats, at one in some 35 positions. The context is what all strings of that
    anchor can cover."""
    n = len(data)
    sums = hashes.sums(data)
    starts = np.arange(n - TOKEN + 1)
    token = hashes.stretch(sums, starts, starts + TOKEN)
    best, at, width = token, starts.astype(np.int32), 1
    while width < SPAN + 1:
        step = min(width, SPAN + 1 - width)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.minimum(best[:-step], best[step:])
        width += step
    place = at[np.r_[True, at[1:] != at[:-1]]].astype(np.int64)
    place = np.unique(place)
    low, high = np.maximum(place - SPAN, 0), np.minimum(place + LEAST, n)
    context = mix(hashes.stretch(sums, low, high) + (place - low).astype(np.uint64) * MIX)
    return place, token[place], context, (high - place).astype(np.uint8)


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Multikey sort: by the first key, then only what is still equal by the next."""
    order = np.argsort(keys[0], kind="stable")
    group = None
    for depth in range(1, len(keys)):
        lead = keys[depth - 1][order]
        new = np.r_[True, lead[1:] != lead[:-1]]
        if group is not None:
            new |= np.r_[True, group[1:] != group[:-1]]
        group = np.cumsum(new)
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        inner = np.lexsort((keys[depth][order[tied]], group[tied]))
        order[tied] = order[tied][inner]
    return order


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Number of each row's run of equal keys, from 0."""
    new = np.zeros(len(keys[0]), dtype=bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _first_of(run: np.ndarray) -> np.ndarray:
    """Row number where each row's run starts."""
    return np.flatnonzero(np.r_[True, run[1:] != run[:-1]])[run]


def _same(doc: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each row has the document and place of its run's first row."""
    return (doc == doc[first]).all(axis=1) & (place == place[first])


class Splitters:
    """Borders of parts over ``(leading token, document)``. A token that is very
    frequent has several borders, so it is spread over parts; such tokens are
    known to all tasks, and what they leave is compared across parts after.
    The borders come from a bounded sample; where it has fewer than ``parts``
    asks for, each part is dealt on by token, equal ones together."""

    def __init__(self, token: np.ndarray, doc: np.ndarray, parts: int):
        doc = doc.reshape(len(token), 1) if doc.ndim == 1 else doc
        order = np.lexsort((*doc.T[::-1], token))
        cuts = order[np.unique(np.linspace(0, len(order), parts + 1)[1:-1].astype(int))] if len(order) else order
        self.token, self.doc = token[cuts], doc[cuts]
        self.crossing = np.unique(self.token)
        self.inner = -(-parts // (len(cuts) + 1))

    def part(self, token: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Number of borders at or before each key: borders and keys are sorted together."""
        n = len(self.token)
        both = np.concatenate([self.doc, doc.reshape(len(token), 1) if doc.ndim == 1 else doc])
        late = np.r_[np.zeros(n, np.int8), np.ones(len(token), np.int8)]
        order = np.lexsort((late, *both.T[::-1], np.r_[self.token, token]))
        before = np.empty(len(order), np.int64)
        before[order] = np.cumsum(order < n)
        return before[n:] * self.inner + (mix(token.astype(np.uint64)) % np.uint64(self.inner)).astype(np.int64)

    def crosses(self, token: np.ndarray) -> np.ndarray:
        if not len(self.crossing):
            return np.zeros(len(token), dtype=bool)
        at = np.minimum(np.searchsorted(self.crossing, token), len(self.crossing) - 1)
        return self.crossing[at] == token


def _packed(part: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per part: its rows of all columns, each column in one piece."""
    order = np.argsort(part, kind="stable")
    number, start = np.unique(part[order], return_index=True)
    ends = np.r_[start[1:], len(order)]
    data = [b"".join(c[order[a:b]].tobytes() for c in columns) for a, b in zip(start, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int64()), pa.array(ends - start, pa.int64()), pa.array(data, pa.binary())], ["part", "n", "data"]
    )


def _unpacked(table: pa.Table, kinds: list[tuple]) -> list[np.ndarray]:
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    for n, data in zip(table["n"].to_pylist(), table["data"].to_pylist()):
        at = 0
        for out, (kind, width) in zip(columns, kinds):
            size = n * width * np.dtype(kind).itemsize
            values = np.frombuffer(data, dtype=kind, count=n * width, offset=at)
            out.append(values if width == 1 else values.reshape(n, width))
            at += size
    return [np.concatenate(c) for c in columns]


_ANCHOR = [("<u8", 1), ("<u8", 1), ("<i8", 3), ("<u4", 1), ("u1", 1)]
_EDGE = [("<u8", 1), ("<i8", 3), ("<u4", 1), ("u1", 1), ("u1", 1), ("u1", SPAN + LEAST)]
# What parts say: 0 a span to remove, 1 an edge to look at closer, 2 a crossing one.
_SAID = "kind int, last long, id long, tie long, start long, stop long, token long, context long"


def _said(*groups: tuple) -> pa.Table:
    """Rows of one kind each: ``(kind, document, start, stop, token, context)``."""
    flat = [(np.full(len(doc), kind), *doc.T, *rest) for kind, doc, *rest in groups]
    columns = []
    for parts in zip(*flat):
        joined = np.concatenate([p.view(np.int64) if p.dtype == np.uint64 else p.astype(np.int64) for p in parts])
        columns.append(pa.array(joined).cast(pa.int64() if columns else pa.int32()))
    return pa.Table.from_arrays(columns, [c.split()[0] for c in _SAID.split(", ")])


def _texts(documents: DataFrame) -> DataFrame:
    """Document and whole text as UTF-8 bytes."""
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    return documents.select(
        F.when(doc_id.isNull(), 1).otherwise(0).cast("long").alias("last"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"),
        F.xxhash64(text).alias("tie"), F.encode(text, "UTF-8").alias("data"),
    )


def _each_text(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Document and bytes of each row."""
    docs = np.stack([batch.column(c).to_numpy() for c in DOC], axis=1) if batch.num_rows else ()
    for doc, data in zip(docs, batch.column("data")):
        yield doc, np.frombuffer(data.as_buffer(), dtype=np.uint8)


def _sample(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and documents of a bounded sample."""
    found = np.array(rows.collect(), np.int64).reshape(-1, 1 + len(DOC))
    return found[:, 0].view(np.uint64) if len(found) else np.zeros(0, np.uint64), found[:, 1:]


def _anchor_sample(texts: DataFrame, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """About ``SAMPLED`` anchors at most, each occurrence as likely as another."""
    every = max(1, int(n_bytes / 35 / SAMPLED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHash()
        for batch in batches:
            token, docs = [np.zeros(0, np.uint64)], [np.zeros((0, len(DOC)), np.int64)]
            for doc, data in _each_text(batch):
                if len(data) >= LEAST:
                    place, own, *_ = anchors_of(data, hashes)
                    salt = mix(doc.view(np.uint64)).sum(dtype=np.uint64)
                    own = own[mix(own + place.astype(np.uint64) * MIX + salt) % np.uint64(every) == 0]
                    token.append(own)
                    docs.append(np.tile(doc, (len(own), 1)))
            columns = [np.concatenate(token).view(np.int64), *np.concatenate(docs).T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", *DOC])

    return _sample(texts.mapInArrow(run, "token long, last long, id long, tie long"))


def _anchors(texts: DataFrame, splitters: Splitters) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHash()
        for batch in batches:
            rows = []
            for doc, data in _each_text(batch):
                if len(data) >= LEAST:
                    place, token, context, right = anchors_of(data, hashes)
                    rows.append((token, context, np.tile(doc, (len(place), 1)), place.astype(np.uint32), right))
            if rows:
                columns = [np.concatenate(c) for c in zip(*rows)]
                yield _packed(splitters.part(columns[0], columns[2]), columns)

    return texts.mapInArrow(run, "part long, n long, data binary")


def _compare_contexts(packed: DataFrame, splitters: Splitters) -> DataFrame:
    """Sort each part's suffixes by leading token, context, id and place, and
    compare neighbours: where the whole context equals an earlier one, every
    string in it does. Where one token has several contexts, their first
    occurrences are edges."""

    def run(table: pa.Table) -> pa.Table:
        token, context, doc, place, right = _unpacked(table, _ANCHOR)
        order = multikey_order([token, context, *doc.T, place])
        token, context, doc, right = token[order], context[order], doc[order], right[order].astype(np.int64)
        place = place[order].astype(np.int64)
        word, equal = _runs(token), _runs(token, context)
        first = _first_of(equal)
        own = _same(doc, place, first)
        leads = first == np.arange(len(token))
        several = np.bincount(word, weights=leads)[word] > 1
        crossing = splitters.crosses(token)
        low, high = np.maximum(place - SPAN, 0), place + right
        spans = ~own & (high - low >= LEAST)
        edges, open_ = leads & several & ~crossing, leads & crossing
        return _said(
            (0, doc[spans], low[spans], high[spans], token[spans], context[spans]),
            (1, doc[edges], place[edges], high[edges], token[edges], context[edges]),
            (2, doc[open_], place[open_], high[open_], token[open_], context[open_]),
        )

    return packed.groupBy("part").applyInArrow(run, _SAID)


def _not_first(open_: DataFrame, by: list[str]) -> DataFrame:
    """``leads``: whether a row is the first that has its ``by``, over all parts."""
    firsts = open_.groupBy(*by).agg(F.min(F.struct(*DOC, "start")).alias("first"))
    return open_.join(firsts, by).withColumn("leads", F.struct(*DOC, "start") == F.col("first"))


def _across(said: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans and edges, crossing tokens settled between parts."""
    spans = said.where("kind = 0").select(*DOC, "start", "stop")
    edges = said.where("kind = 1").select("token", *DOC, "start")
    met = _not_first(said.where("kind = 2"), ["token", "context"])
    low = F.greatest(F.col("start") - SPAN, F.lit(0))
    late = met.where("not leads").select(*DOC, low.alias("start"), "stop").where(F.col("stop") - F.col("start") >= LEAST)
    return spans.unionByName(late), edges.unionByName(met.where("leads").select("token", *DOC, "start"))


def _with_rows(texts: DataFrame, rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts joined with what ``found`` says of their document, and the texts
    that have no row in ``rows`` for sure and so do not move."""
    key = F.xxhash64(*DOC)
    words = filter_of(rows.select(key.alias("key")).distinct(), "key", FILTER_BITS)
    looked = in_filter(texts.withColumn("key", key), "key", words, FILTER_BITS, "maybe").drop("key")
    return looked.where("maybe").drop("maybe").join(found, list(DOC), "left"), looked.where("not maybe").drop("maybe")


def _edge_contexts(texts: DataFrame, edges: DataFrame, splitters: Splitters) -> DataFrame:
    """The bytes round each edge. Only texts that may have one move."""
    width = SPAN + LEAST
    by_doc = edges.groupBy(*DOC).agg(F.collect_set("start").alias("places"))
    met = _with_rows(texts, by_doc, by_doc)[0].where("places is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHash()
        for batch in batches:
            rows = []
            for (doc, data), places in zip(_each_text(batch), batch.column("places")):
                place = np.sort(places.values.to_numpy())
                place = place[place + TOKEN <= len(data)]
                padded = np.concatenate([np.zeros(SPAN, np.uint8), data, np.zeros(LEAST, np.uint8)])
                window = np.lib.stride_tricks.sliding_window_view(padded, width)[place] if len(place) else np.zeros((0, width), np.uint8)
                sums = hashes.sums(data)
                rows.append((
                    hashes.stretch(sums, place, place + TOKEN), np.tile(doc, (len(place), 1)), place.astype(np.uint32),
                    np.minimum(place, SPAN).astype(np.uint8), np.minimum(len(data) - place, LEAST).astype(np.uint8), window,
                ))
            if rows:
                columns = [np.concatenate(c) for c in zip(*rows)]
                yield _packed(splitters.part(columns[0], columns[1]), columns)

    return met.mapInArrow(run, "part long, n long, data binary")


def string_hash(sum_: np.ndarray, token: np.ndarray, back: int) -> np.ndarray:
    """Of a string's own sum, its anchor's token and the anchor's place in it."""
    return mix(mix(sum_) + token * MIX + np.uint64(back))


def _compare_strings(packed: DataFrame, splitters: Splitters) -> DataFrame:
    """For every offset of the anchor, sort the edges of a part by token and by
    the string at that offset; all but the first of equal ones are repeats.
    Strings are equal when two independent hashes of 64 bits are. The strings of an edge that are repeats overlap, so they make one span."""

    def run(table: pa.Table) -> pa.Table:
        token, doc, place, left, right, window = _unpacked(table, _EDGE)
        order = multikey_order([token, *doc.T, place])
        token, doc, place = token[order], doc[order], place[order].astype(np.int64)
        left, right, window = left[order].astype(np.int64), right[order].astype(np.int64), window[order]
        crossing = splitters.crosses(token)
        far, near = np.full(len(token), -1), np.full(len(token), LEAST)
        kept = []
        sides = []
        for hashes in (PrefixHash(), PrefixHash(SECOND)):
            sums = np.zeros((len(token), window.shape[1] + 1), np.uint64)
            np.cumsum(hashes.of_byte[window] * hashes.power[: window.shape[1]], axis=1, out=sums[:, 1:])
            sides.append((sums, hashes.inverse))
        for back in range(SPAN + 1):
            row = np.flatnonzero((left >= back) & (right >= LEAST - back))
            if not len(row):
                continue
            at = SPAN - back
            string, other = (
                string_hash((sums[row, at + LEAST] - sums[row, at]) * inverse[at], token[row], back) for sums, inverse in sides
            )
            by = np.argsort(string, kind="stable")
            if (other[by] != other[by[_first_of(_runs(string[by]))]]).any():  # one hash for two strings
                by = np.lexsort((other, string))
            row, string, other = row[by], string[by], other[by]
            first = _first_of(_runs(string, other))
            again = ~_same(doc[row], place[row], first)
            far[row[again]] = np.maximum(far[row[again]], back)
            near[row[again]] = np.minimum(near[row[again]], back)
            lead = (first == np.arange(len(row))) & crossing[row]
            kept.append((doc[row[lead]], place[row[lead]] - back, string[lead], other[lead]))
        hit = far >= 0
        groups = [(0, doc[hit], place[hit] - far[hit], place[hit] - near[hit] + LEAST, token[hit], token[hit])]
        for docs, start, string, other in kept:
            groups.append((2, docs, start, start + LEAST, string, other))
        return _said(*groups)

    return packed.groupBy("part").applyInArrow(run, _SAID)


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``last, id, tie, start, stop``: stretches of bytes, overlapping, that a string of
    ``LEAST`` bytes covers which starts earlier too. See :func:`suffix_dedup`."""
    spark = documents.sparkSession
    texts = _texts(documents)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_bytes = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    splitters = Splitters(*_anchor_sample(texts, n_bytes), max(width, n_bytes // PART_BYTES))
    spans, edges = _across(cut(_compare_contexts(_anchors(texts, splitters), splitters), "suffixes"))

    n_edges = edges.count()
    some = edges.where(F.pmod(F.xxhash64("token", *DOC, "start"), F.lit(max(1, n_edges // SAMPLED))) == 0)
    splitters = Splitters(*_sample(some.select("token", *DOC)), max(width, n_edges // PART_EDGES))
    said = cut(_compare_strings(_edge_contexts(texts, edges, splitters), splitters), "strings")
    late = _not_first(said.where("kind = 2"), ["token", "context"]).where("not leads")
    return spans.unionByName(said.where("kind = 0").select(*DOC, "start", "stop")).unionByName(late.select(*DOC, "start", "stop"))


def suffix_dedup(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` per row of
    ``documents(doc_id, text)``; ``kept`` is what is left of the UTF-8 bytes.

    A byte goes if a string of 100 bytes covers it that also starts earlier: in
    a smaller id, or further ahead in its own text. Strings are judged on the
    input and never cross documents.

    Only suffixes that start at anchors are sorted, and every string of 100 bytes
    holds one at a place that hangs on its bytes alone. Splitters sampled from
    all suffixes deal them out by leading token and id; buckets are sorted by
    multikey sort, token, context, id, place; tokens that cross a border are
    compared across parts. Where whole contexts agree, that settles all strings
    of the anchor; the rest, the ends of repeats, are compared string by string.
    Equality is that of 128 bits: hashes of token and context, or two of the
    string. No pairs are made in a group of repeats: each is held against the
    first.

    Null and empty texts have no bytes. Any id is taken; rows without one come
    last. Rows of one id, or of none, are told apart by a hash of the text, which
    orders them; those that repeat the text too count as one document and share
    its result. Other columns are ignored; an empty table gives an empty
    result.
    """
    texts = _texts(documents)
    spans = cut(repeated_spans(documents), "spans")
    by_doc = spans.groupBy(*DOC).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    met, whole = _with_rows(texts, spans.select(*DOC), by_doc)
    whole = whole.withColumn("spans", F.lit(None).cast("array<struct<start: long, stop: long>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, kept = [], [], []
            ids = pc.if_else(pc.equal(batch.column("last"), 0), batch.column("id"), pa.scalar(None, pa.int64()))
            for data, spans in zip(batch.column("data"), batch.column("spans")):
                raw = data.as_buffer()
                mark = np.zeros(len(raw) + 1, np.int64)
                if spans.is_valid and len(spans.values):
                    inner = spans.values.flatten()
                    np.add.at(mark, np.minimum(inner[0].to_numpy(), len(raw)), 1)
                    np.add.at(mark, np.minimum(inner[1].to_numpy(), len(raw)), -1)
                gone = np.cumsum(mark[:-1]) > 0
                removed.append(int(gone.sum()))
                runs.append(int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0)
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(x.as_buffer()) for x in batch.column("data")], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    # Texts that keep all bytes never move.
    return met.unionByName(whole).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
