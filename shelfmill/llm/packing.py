"""Best-fit packing planned over a histogram of lengths (operator 5)."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, read_documents
from .tokens import byte_bpe

LENGTH, END_ID, SALTS = 2048, 0, 64
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Token pieces of ``documents(doc_id, text)``: whole documents of at most
    ``length`` ids, the end id included, and longer ones cut so that the first
    piece is the short one. Texts stay where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                first = (len(ids) - 1) % length + 1
                bounds = [0, *range(first, len(ids) + 1, length)]
                out += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                if out else [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECES)


def plan(histogram: dict[int, int], length: int = LENGTH) -> dict[int, list[tuple[int, int, int, int]]]:
    """Best-fit over counts, longest first. Sequences with equal room left are
    kept as ranges of numbers and take a whole count at once, so the work hangs
    on the number of lengths, not of documents. Returns per length slots
    ``(rank, sequence, per_sequence, offset)``: from ``rank`` on, each of the
    sequences from ``sequence`` takes ``per_sequence`` pieces from ``offset``."""
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, how many)
    rooms: list[int] = []
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used = 0

    def give(left: int, first: int, count: int) -> None:
        if left and count:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append((first, count))

    for size in sorted(histogram, reverse=True):
        rank, todo, out = 0, histogram[size], []
        while todo:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                fit = length // size
                count, rest = divmod(todo, fit)
                if count:
                    out.append((rank, used, fit, 0))
                    give(length - fit * size, used, count)
                if rest:
                    out.append((rank + count * fit, used + count, rest, 0))
                    give(length - rest * size, used + count, 1)
                used += count + bool(rest)
                break
            left = rooms[at]
            first, count = room[left].pop()
            fit = left // size
            whole, rest = min(count, todo // fit), 0
            if whole:
                out.append((rank, first, fit, length - left))
                give(left - fit * size, first, whole)
            elif todo < fit:
                rest = todo
                out.append((rank, first, rest, length - left))
                give(left - rest * size, first, 1)
            spent = whole + bool(rest)
            if count > spent:
                room[left].append((first + spent, count - spent))
            if not room[left]:
                del room[left]
                del rooms[at if rooms[at] == left else bisect.bisect_left(rooms, left)]
            rank += whole * fit + rest
            todo -= whole * fit + rest
        slots[size] = out
    return slots


def place(table: DataFrame, length: int = LENGTH, salts: int = SALTS) -> DataFrame:
    """Give each row of ``table`` with a ``length`` its ``sequence_id`` and
    ``offset``. The rank within a length is counted in ``salts`` parts, by a
    hash, so a length that a third of all rows share is spread over tasks; the
    driver gets ``length * salts`` counts at most."""
    order = [c for c in table.columns if c != "length"]
    salted = table.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "__salt").agg(F.count("*").alias("n")).collect()
    histogram: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for size, salt, n in sorted(map(tuple, counts)):
        before[size, salt] = histogram.get(size, 0)
        histogram[size] = before[size, salt] + n
    slots = {
        size: np.array(rows, dtype=np.int64) for size, rows in plan(histogram, length).items()
    }
    names = [*table.columns, "sequence_id", "offset"]
    ranked = salted.withColumn(
        "__rank", F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*order)).cast("long") - 1
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, salt, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__salt", "__rank"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for value in np.unique(size):
                mine = np.flatnonzero(size == value)
                at = rank[mine] + np.array([before[int(value), int(s)] for s in salt[mine]], dtype=np.int64)
                slot = slots[int(value)][np.searchsorted(slots[int(value)][:, 0], at, side="right") - 1]
                further, inside = np.divmod(at - slot[:, 0], slot[:, 2])
                sequence[mine], offset[mine] = slot[:, 1] + further, slot[:, 3] + inside * value
            kept = [batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    kinds = ", ".join(f"`{c}` {t}" for c, t in table.dtypes)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def best_fit_packing(
    documents: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID, salts: int = SALTS,
) -> DataFrame:
    """Pack all rows of ``documents(doc_id, text)`` into sequences of ``length``
    ids; returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every document ends with ``end_id``. Texts are encoded once; what follows
    works on a row of numbers per piece. Null and empty texts are the end id
    alone. Null ids stay null; repeated rows are packed as often as they stand.
    Other columns are ignored; an empty table gives an empty result.
    """
    table = cut(pieces(documents, tokenizer, length, end_id), "pieces")
    return place(table, length, salts)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return best_fit_packing(read_documents(spark, sf_dir))
