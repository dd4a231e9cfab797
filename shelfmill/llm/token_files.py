"""Token ids in files of patched frame-of-reference blocks (operator 12).

A file holds whole documents, little-endian: a header, a table of blocks (where
each starts, least id, width, exceptions), a table of documents, the blocks, and
one closing line feed. A block is 256 ids less their minimum, packed at ``width``
bits; of ids that need more, the list after it has the place (one byte each) and
what stands above the width (2 or 4 bytes each). Files lie in folders named
``part=<n>/first=<n>/ids=<n>``, parts in order of ids, ``first`` counted in the part.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_folder
from .common import read_documents
from .tokens import byte_bpe

END_ID, BLOCK = 2, 256
# Shares of a block's ids that may set its width; the one that takes the fewest bytes does.
SHARES = (0.5, 0.75, 0.9, 0.95, 0.98, 1.0)
# Ids after which a file ends, at the end of a document; bytes of text that a part is planned
# for; parts at most (larger ones hold more files), so that what is broadcast of them is bounded.
FILE_IDS, PART_BYTES, MOST_PARTS = 1 << 22, 1 << 24, 50_000
CHUNK = 4096
MAGIC = b"PFORids1"
_HEADER = "<8sIqqqqI"  # magic, part, first, ids, documents, blocks, crc32 of what follows
_HEADER_SIZE = struct.calcsize(_HEADER)
_BLOCK = np.dtype([("start", "<u8"), ("least", "<u4"), ("width", "u1"), ("extra_size", "u1"), ("extras", "<u2")])
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("ids", "<u8"), ("has_id", "u1")])


def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def _widths(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per block of ``offsets``: the cheapest of the widths that percentiles
    ask for, the number of exceptions, and bytes of an exception's upper part."""
    ordered = np.sort(offsets, axis=1)
    best = None
    for share in SHARES:
        width = _bits(ordered[:, int(np.ceil(share * BLOCK)) - 1])
        extras = (ordered >= (np.uint64(1) << width.astype(np.uint64))[:, None]).sum(axis=1)
        size = np.where(extras == 0, 0, np.where(ordered[:, -1].astype(np.uint64) >> width.astype(np.uint64) < 65536, 2, 4))
        total = width * (BLOCK // 8) + extras * (1 + size)
        if best is None:
            best = [total, width, extras, size]
        else:
            less = total < best[0]
            best = [np.where(less, new, old) for new, old in zip((total, width, extras, size), best)]
    return best[1], best[2], best[3]


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Table of blocks and their bytes; the last block is filled up with its minimum."""
    n = -(-len(ids) // BLOCK)
    filled = np.empty(n * BLOCK, dtype=np.uint32)
    filled[: len(ids)] = ids
    if len(ids) < len(filled):
        filled[len(ids) :] = ids[(n - 1) * BLOCK :].min()
    blocks = filled.reshape(n, BLOCK)
    table = np.zeros(n, dtype=_BLOCK)
    if not n:
        return table, b""
    table["least"] = blocks.min(axis=1)
    offsets = blocks - table["least"][:, None]
    width, extras, size = _widths(offsets)
    table["width"], table["extras"], table["extra_size"] = width, extras, size
    lengths = width * (BLOCK // 8) + extras * (1 + size)
    ends = np.cumsum(lengths)
    table["start"] = ends - lengths
    start = table["start"].astype(np.int64)
    out = np.zeros(int(ends[-1]), dtype=np.uint8)
    for w in np.unique(width):
        for rows in _chunks(np.flatnonzero(width == w)):
            bits = np.unpackbits(offsets[rows].astype("<u4").view(np.uint8), bitorder="little").reshape(len(rows), BLOCK, 32)
            packed = np.packbits(bits[:, :, :w].reshape(len(rows), -1), axis=1, bitorder="little")
            out[start[rows, None] + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(offsets >= (np.uint64(1) << width.astype(np.uint64))[:, None])
    upper = offsets[block, place] >> width[block].astype(np.uint32)
    before = np.cumsum(extras) - extras
    at = np.arange(len(block)) - before[block]
    tail = start + width * (BLOCK // 8)
    out[tail[block] + at] = place
    for s in (2, 4):
        mine = size[block] == s
        to = (tail + extras)[block[mine]] + at[mine] * s
        out[to[:, None] + np.arange(s)] = upper[mine].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :s]
    return table, out.tobytes()


def unpack(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Ids of the blocks in ``table``; their starts are places in ``data``."""
    start, width = table["start"].astype(np.int64), table["width"].astype(np.int64)
    extras, size = table["extras"].astype(np.int64), table["extra_size"]
    out = np.zeros((len(table), BLOCK), dtype=np.uint32)
    for w in np.unique(width):
        for rows in _chunks(np.flatnonzero(width == w)):
            packed = data[start[rows, None] + np.arange(w * (BLOCK // 8))]
            bits = np.zeros((len(rows), BLOCK, 32), dtype=np.uint8)
            bits[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
            out[rows] = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view("<u4")
    tail = start + width * (BLOCK // 8)
    for s in (2, 4):
        own = np.flatnonzero((size == s) & (extras > 0))
        block = np.repeat(own, extras[own])
        at = np.arange(len(block)) - np.repeat(np.cumsum(extras[own]) - extras[own], extras[own])
        upper = np.zeros((len(block), 4), dtype=np.uint8)
        upper[:, :s] = data[((tail + extras)[block] + at * s)[:, None] + np.arange(s)]
        out[block, data[tail[block] + at]] |= upper.view("<u4")[:, 0] << width[block].astype(np.uint32)
    return (out + table["least"][:, None]).reshape(-1)


def _chunks(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[at : at + CHUNK] for at in range(0, len(rows), CHUNK)]


class TokenFile:
    """One file's ids. Only blocks that are asked for are unpacked."""

    def __init__(self, content: bytes):
        magic, self.part, self.first, self.ids, documents, blocks, crc = struct.unpack_from(_HEADER, content)
        if magic != MAGIC or zlib.crc32(memoryview(content)[_HEADER_SIZE : -1]) != crc:
            raise ValueError("not a whole file of token ids")
        self.blocks = np.frombuffer(content, _BLOCK, blocks, _HEADER_SIZE)
        at = _HEADER_SIZE + self.blocks.nbytes
        self.documents = np.frombuffer(content, _DOCUMENT, documents, at)
        self.data = np.frombuffer(content, np.uint8, offset=at + self.documents.nbytes)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, counted in the file."""
        low, high = start // BLOCK, -(-end // BLOCK)
        return unpack(self.blocks[low:high], self.data)[start - low * BLOCK : end - low * BLOCK]


def file_bytes(part: int, first: int, documents: list[tuple[int | None, np.ndarray]]) -> bytes:
    ids = np.concatenate([x for _, x in documents]) if documents else np.zeros(0, np.uint32)
    table, data = pack(ids)
    rows = np.array([(doc or 0, len(x), doc is not None) for doc, x in documents], dtype=_DOCUMENT)
    rest = table.tobytes() + rows.tobytes() + data
    return struct.pack(_HEADER, MAGIC, part, first, len(ids), len(rows), len(table), zlib.crc32(rest)) + rest


def write_token_files(
    documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS, part_bytes: int = PART_BYTES,
) -> None:
    """Encode ``documents(doc_id, text)`` and write their ids to files below
    ``path``, in ascending order of ``doc_id``, each text closed by ``end_id``.

    Null and empty texts are ``end_id`` alone; texts of any length are whole
    and never cut by a file's end; rows without id come last, repeated rows as
    often as they stand; other columns are ignored; an empty table leaves an
    empty folder, which reads as no documents.

    Parts are ranges of (id, place in the input), so neither rows without id nor
    repeats of one gather in a task. Texts move once and are encoded where they
    are written. Spark's writer commits the files: a task that runs twice leaves
    one result.
    """
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("place")
    )
    total = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(MOST_PARTS, max(1, -(-total // part_bytes))))
    order = [F.col("doc_id").asc_nulls_last(), F.col("place")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, first, held, size = byte_bpe(tokenizer), TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array([x], t) for x, t in ((part, pa.int32()), (first, pa.int64()), (size, pa.int64()), (file_bytes(part, first, held), pa.binary()))]
            return pa.RecordBatch.from_arrays(arrays, ["part", "first", "ids", "file"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append((doc, np.array([*encode(text.as_py() or ""), end_id], dtype=np.uint32)))
                size += len(held[-1][1])
                if size >= file_ids:
                    yield out()
                    first, held, size = first + size, [], 0
        if held:
            yield out()

    ranged = read.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    files = ranged.mapInArrow(run, "part int, first long, ids long, file binary")
    (
        files.select("part", "first", "ids", F.col("file").cast("string").alias("value"))
        .write.partitionBy("part", "first", "ids").option("compression", "none").option("lineSep", "\n").text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Files with the number of ids in all parts before theirs. Names of folders
    tell the parts' sizes; one row per part, at most ``MOST_PARTS``, goes through one window."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if "part" not in files.columns:  # no document, no file
        return spark.createDataFrame([], "before long, content binary")
    files = files.select(F.col("part").cast("int").alias("part"), F.col("ids").cast("long").alias("ids"), "content")
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.select("part", "content").join(F.broadcast(parts.select("part", before.alias("before"))), "part").select("before", "content")


def _per_document(spark: SparkSession, path: str, kind: str, make: Callable[[list[np.ndarray]], pa.Array], into: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = TokenFile(content.as_buffer())
                ends = np.cumsum(file.documents["ids"].astype(np.int64))
                at = 0
                while at < len(ends):  # so many documents that about 2^21 ids are unpacked at once
                    begin = int(ends[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, begin + (1 << 21), side="right")))
                    ids, own = file.read(begin, int(ends[to - 1])), file.documents[at:to]
                    starts = np.concatenate(([begin], ends[at : to - 1]))
                    texts = np.split(ids, starts[1:] - begin)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own["doc_id"], mask=own["has_id"] == 0), pa.array(starts + before + file.first), pa.array(own["ids"].astype(np.int64)), make(texts)],
                        ["doc_id", "start", "n_tokens", into],
                    )
                    at = to

    return _files(spark, path).mapInArrow(run, f"doc_id long, start long, n_tokens long, {into} {kind}")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of written files: ``doc_id, start, n_tokens, ids`` (array of
    long); ``start`` counts the ids of all documents before it."""

    def make(texts: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, texts)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(texts).astype(np.int64)))

    return _per_document(spark, path, "array<long>", make, "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_files`` with the ids' crc32 (of unsigned little-endian 32-bit numbers) in their place."""

    def make(texts: list[np.ndarray]) -> pa.Array:
        return pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in texts], pa.int64())

    return _per_document(spark, path, "long", make, "ids_crc32")


def op12_token_files(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(read_documents(spark, sf_dir), path)
    return read_digests(spark, path)
