"""How two tokenizers cut the same texts, counted over the corpus (operator 11).

Documents are numbered in chunks. Per id pair and chunk, inverted bitmaps say
which documents hold the pair linked: plane ``k`` holds those in whose number of
links bit ``k`` is set, so the planes' union tells documents and the planes
together tell links. A bitmap is a sorted list of 16-bit numbers, or a plain
bitmap of the whole chunk once that is shorter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, read_documents
from .tokens import pieces_bpe, plain_bpe_arrays

# Documents of a chunk; links after which a chunk ends and after which a task sends its
# bitmaps on; code points of the texts that are aligned at once.
SLOT_BITS, CHUNK_LINKS, HELD_LINKS, BUNDLE = 14, 1 << 25, 1 << 22, 1 << 19
CHUNK = 1 << SLOT_BITS
# Ids are below this power of two; an id pair and a place in a chunk fit a signed number.
ID_BITS = 24
_DENSE = CHUNK // 16
_ENCODED = pa.schema([
    ("chunk", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("docs", pa.binary()),
])
_MERGED = pa.schema([("chunk", pa.int64()), ("pair", pa.int64()), ("plane", pa.int32()), ("docs", pa.binary()), ("n_docs", pa.int64()), ("n_links", pa.int64())])
_SCORES = pa.schema([("chunk", pa.int64()), ("slot", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _kinds(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


# -- compressed bitmaps -------------------------------------------------------------------------

def to_bitmaps(group: np.ndarray, slot: np.ndarray) -> pa.Array:
    """One bitmap per run of ``group``; slots ascend within a run."""
    first = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    count = np.diff(np.append(first, len(group)))
    dense = count >= _DENSE
    size = np.where(dense, CHUNK // 8, 2 * count)
    ends = np.cumsum(size)
    data = slot.astype("<u2").view(np.uint8)
    if dense.any():
        of_dense, thick = np.repeat(dense, size), np.repeat(dense, count)
        bits = np.zeros((int(dense.sum()), CHUNK), dtype=bool)
        bits[np.repeat(np.arange(len(bits)), count[dense]), slot[thick]] = True
        out = np.empty(len(of_dense), dtype=np.uint8)
        out[of_dense] = np.packbits(bits, axis=1, bitorder="little").reshape(-1)
        out[~of_dense] = slot[~thick].astype("<u2").view(np.uint8)
        data = out
    starts = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(data.tobytes())])


def from_bitmaps(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and slots of all bitmaps, in no set order."""
    _, starts, data = bitmaps.buffers()
    starts = np.frombuffer(starts, dtype=np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]] if data else np.zeros(0, np.uint8)
    size = np.diff(starts)
    dense = size == CHUNK // 8
    of_dense = np.repeat(dense, size)
    rows = np.repeat(np.flatnonzero(~dense), size[~dense] // 2)
    slots = data[~of_dense].view("<u2").astype(np.int64)
    if dense.any():
        at, bit = np.nonzero(np.unpackbits(data[of_dense].reshape(-1, CHUNK // 8), axis=1, bitorder="little"))
        rows, slots = np.concatenate((rows, np.flatnonzero(dense)[at])), np.concatenate((slots, bit))
    return rows, slots


def planes(links: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """Bitmaps of ``pair << SLOT_BITS | slot``, one entry per link: per plane the pairs and their bitmaps."""
    links = np.sort(links)
    first = np.flatnonzero(np.diff(links, prepend=-1))
    times, links = np.diff(np.append(first, len(links))), links[first]
    for plane in range(int(times.max(initial=0)).bit_length()):
        own = links[(times >> plane) & 1 == 1]
        pair = own >> SLOT_BITS
        if len(own):
            yield plane, pair[np.flatnonzero(np.diff(pair, prepend=-1))], to_bitmaps(pair, own & (CHUNK - 1))


# -- alignment in tasks -------------------------------------------------------------------------

class Aligner:
    """Both tokenizers, loaded in a task."""

    def __init__(self, first: str | None, second: str | None):
        self.encode_a, bytes_a = plain_bpe_arrays(first)
        self.encode_b, bytes_b = pieces_bpe(second)
        self.bytes, self.size, self.more, self.last = [], [], [], []
        for side, mark in ((bytes_a, "|"), (bytes_b, ";")):
            self.bytes.append(np.array(side, dtype=object))
            self.size.append(np.array([len(x) for x in side], dtype=np.int64))
            self.more.append(np.array([f"{i}," for i in range(len(side))], dtype=object))
            self.last.append(np.array([f"{i}{mark}" for i in range(len(side))], dtype=object))

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of both, and the bytes they cut; none where they do not cut the same."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none, 0
        text_bytes = (" " + text).encode()
        a, b = self.encode_a(" " + text).astype(np.int64), np.array(self.encode_b(text), dtype=np.int64)
        if b"".join(self.bytes[0][a].tolist()) != text_bytes or b"".join(self.bytes[1][b].tolist()) != text_bytes:
            return none, none, 0
        return a, b, len(text_bytes)

    def align(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[str]]:
        """Per text the counts ``n_a, n_b, n_groups, n_links``, all links as pairs
        with the numbers of their texts, and the groups as text."""
        found = [self.ids(t) for t in texts]
        a, b = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        n_a, n_b = (np.array([len(x[i]) for x in found]) for i in (0, 1))
        ends = np.cumsum([x[2] for x in found])
        # All texts in one line: where A and B end, and so each stretch that lies in one token of both.
        end_a, end_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        ending = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
        ending[end_a] = 1
        ending[end_b] |= 2
        at = np.flatnonzero(ending)
        ending = ending[at]
        of_a, of_b = ending & 1, ending >> 1
        link_a, link_b = (np.cumsum(x, dtype=np.int64) - x for x in (of_a, of_b))
        text_of = np.searchsorted(ends, at, side="left")
        pairs = a[link_a] << ID_BITS | b[link_b]
        both = ending == 3
        counts = [n_a, n_b, np.bincount(text_of[both], minlength=len(texts)), np.bincount(text_of, minlength=len(texts))]
        # A group's ids of A stand before its ids of B, in line: each id moves on by the other side's groups before it.
        last_a, last_b = both[of_a == 1], both[of_b == 1]
        before_a, before_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a = np.concatenate(([0], np.flatnonzero(last_a) + 1))
        upto_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))
        line = np.empty(len(a) + len(b), dtype=object)
        line[np.arange(len(a)) + upto_b[before_a]] = np.where(last_a, self.last[0][a], self.more[0][a])
        line[np.arange(len(b)) + upto_a[before_b + 1]] = np.where(last_b, self.last[1][b], self.more[1][b])
        line, bounds = line.tolist(), np.cumsum(n_a + n_b).tolist()
        groups = ["".join(line[x:y])[:-1] for x, y in zip([0, *bounds], bounds)]
        return counts, pairs, text_of, groups


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str | None]]]:
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            docs.append(doc)
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= BUNDLE or len(docs) >= CHUNK:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def _some(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """Columns by name; the others are null."""
    return pa.RecordBatch.from_arrays([
        (c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type)) if f.name in columns else pa.nulls(n, f.type) for f in schema
    ], schema=schema)


def encoded(documents: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """One row per document (``pair`` null) and one per pair, plane and part of a chunk (``doc_id`` and counts null)."""
    schema = _ENCODED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = Aligner(first, second), TaskContext.get().partitionId() << 24
        used, of_chunk, held, size = 0, 0, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                for plane, pair, docs in planes(np.concatenate(held)):
                    yield _some(schema, len(pair), chunk=np.full(len(pair), chunk), pair=pair, plane=np.full(len(pair), plane, np.int32), docs=docs)

        for docs, texts in _bundles(batches):
            if used + len(docs) > CHUNK or of_chunk >= CHUNK_LINKS:
                yield from out()
                chunk, used, of_chunk, held, size = chunk + 1, 0, 0, [], 0
            (n_a, n_b, n_groups, n_links), pairs, text_of, groups = aligner.align(texts)
            yield _some(
                schema, len(docs), chunk=np.full(len(docs), chunk), slot=np.arange(used, used + len(docs), dtype=np.int32), doc_id=docs,
                n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links,
                groups_sha256=[hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups],
            )
            held.append(pairs << SLOT_BITS | (text_of + used))
            used, of_chunk, size = used + len(docs), of_chunk + len(pairs), size + len(pairs)
            if size >= HELD_LINKS:
                yield from out()
                held, size = [], 0
        yield from out()

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, _kinds(schema))


def merged(postings: DataFrame) -> DataFrame:
    """Unite the bitmaps of each (chunk, pair, plane), and count: documents of
    the union of planes, told on the first plane's row, and links of each plane.
    Rows are dealt by chunk and pair, so a pair that all documents hold is spread."""
    schema = _MERGED

    def unite(table: pa.RecordBatch) -> pa.RecordBatch:
        chunk, pair, plane = (table.column(i).to_numpy() for i in range(3))
        rows, slots = from_bitmaps(table.column(3))
        new_pair = np.diff(chunk, prepend=-1) != 0
        new_pair |= np.diff(pair, prepend=-1) != 0
        new = new_pair | (np.diff(plane, prepend=-1) != 0)
        first, of_plane, of_pair = np.flatnonzero(new), np.cumsum(new) - 1, np.cumsum(new_pair) - 1
        keys = np.unique(of_plane[rows] << SLOT_BITS | slots)
        group = keys >> SLOT_BITS
        documents = np.unique(of_pair[rows] << SLOT_BITS | slots) >> SLOT_BITS
        n_docs = np.where(new_pair[first], np.bincount(documents, minlength=of_pair[-1] + 1)[of_pair[first]], 0)
        n_links = np.bincount(group, minlength=len(first)) << plane[first]
        return _some(schema, len(first), chunk=chunk[first], pair=pair[first], plane=plane[first], docs=to_bitmaps(group, keys & (CHUNK - 1)), n_docs=n_docs, n_links=n_links)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            chunk, pair = held.column(0).to_numpy(), held.column(1).to_numpy()
            # The last pair of a batch may go on in the next one.
            whole = int(np.flatnonzero((chunk != chunk[-1]) | (pair != pair[-1]))[-1:].sum() + 1) if (chunk != chunk[-1]).any() or (pair != pair[-1]).any() else 0
            if whole:
                yield unite(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield unite(held)

    order = ["chunk", "pair", "plane"]
    dealt = postings.repartition("chunk", "pair").sortWithinPartitions(*order).select(*order, "docs")
    return dealt.mapInArrow(run, _kinds(schema))


def _scores(postings: DataFrame) -> DataFrame:
    """Give counts back along the postings ``(chunk, plane, docs, n_docs, best)``: sums per document.
    A chunk's rows meet in one task, which keeps two numbers per document."""
    schema = _SCORES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, None

        def out() -> Iterator[pa.RecordBatch]:
            if at is not None:
                slots = np.flatnonzero(sums[1])
                yield _some(schema, len(slots), chunk=np.full(len(slots), at), slot=slots.astype(np.int32), n_best=sums[0][slots], count_sum=sums[1][slots])

        for batch in batches:
            chunk = batch.column(0).to_numpy()
            bounds = np.flatnonzero(np.diff(chunk, prepend=-1)).tolist() if len(chunk) else []
            for x, y in zip(bounds, [*bounds[1:], len(chunk)]):
                if chunk[x] != at:
                    yield from out()
                    at, sums = int(chunk[x]), np.zeros((2, CHUNK), dtype=np.int64)
                part = batch.slice(x, y - x)
                rows, slots = from_bitmaps(part.column(2))
                times = np.int64(1) << part.column(1).to_numpy().astype(np.int64)[rows]
                np.add.at(sums[1], slots, times * part.column(3).to_numpy()[rows])
                best = part.column(4).to_numpy(zero_copy_only=False)[rows]
                np.add.at(sums[0], slots[best], times[best])
        yield from out()

    dealt = postings.repartition("chunk").sortWithinPartitions("chunk").select("chunk", "plane", "docs", "n_docs", "best")
    return dealt.mapInArrow(run, _kinds(schema))


def _pair_sums(postings: DataFrame) -> DataFrame:
    return postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))


def _id_a() -> Column:
    return F.shiftrightunsigned("pair", ID_BITS)


def pair_counts(documents: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Linked id pairs of both tokenizers over ``documents(doc_id, text)``:
    ``a, b, n_docs`` (documents that hold the pair linked), ``n_links``
    (occurrences) and ``best`` (no other ``b`` of the ``a`` has more documents).
    Texts as in ``align``."""
    table = cut(encoded(documents, first, second), "aligned")
    sums = _pair_sums(merged(table.where("pair is not null"))).withColumn("a", _id_a())
    most = sums.groupBy("a").agg(F.max("n_docs").alias("most"))
    named = sums.join(most, "a").select("a", F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("b"), "n_docs", "n_links", "most")
    return named.withColumn("best", F.col("n_docs") == F.col("most")).drop("most")


def align(documents: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Align the ids of two tokenizers over ``documents(doc_id, text)``.

    ``first`` is a byte-level BPE file and encodes a space and the text,
    ``second`` a sentence-piece file and encodes the text; special tokens'
    strings are plain text. Ids link where their bytes overlap; byte offsets
    where both end cut a text into groups. Returns per row ``doc_id, n_a, n_b,
    n_groups, n_links, n_best`` (links whose pair has the most documents of its
    ``a``, ties included), ``count_sum`` (over links, the pair's documents) and
    ``groups_sha256``.

    Null and empty texts, and those that a tokenizer does not give back byte by
    byte, have no ids: zeros and an empty ``groups_sha256``. Texts of any length are
    whole; repeated rows and rows without id count as often as they stand; other
    columns are ignored; an empty table gives an empty result.

    Encoding runs once; its bitmaps go to a table in the shared folder, so a lost
    executor costs no second one. No task holds more than its own bundle, one
    chunk's sums, or one pair's bitmaps of one chunk.
    """
    table = cut(encoded(documents, first, second), "aligned")
    postings = cut(merged(table.where("pair is not null").select("chunk", "pair", "plane", "docs")), "bitmaps")
    sums = cut(_pair_sums(postings), "pairs")
    # One row per id of the first vocabulary at most.
    most = F.broadcast(sums.groupBy(_id_a().alias("a")).agg(F.max("n_docs").alias("most")))
    known = sums.withColumn("a", _id_a()).join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    scores = _scores(postings.select("chunk", "pair", "plane", "docs").join(known, "pair"))
    rows = table.where("pair is null").join(scores, ["chunk", "slot"], "left")
    none = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(read_documents(spark, sf_dir))
