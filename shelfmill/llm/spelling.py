"""Spelling variants: words one edit apart, found in dense tiles (operator 13)."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut, read_documents

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
# Rows of one block, rows of tiles that several small groups share, pairs looked at
# at once, code points of one block, words that a task counts before it sends them on.
BLOCK, SHARED, STRIP, BLOCK_POINTS, HELD = 2048, 128, 1 << 19, 1 << 22, 400_000
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("minus", pa.int64()), ("form", pa.string())])


def _letters() -> bytes:
    """For each byte of Latin-1: itself if a letter from U+00C0 on or a to z, small if A to Z, else a space."""
    return bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))


def count_words(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int | None = None) -> DataFrame:
    """Words ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z lower-cased, with
    their counts, from ``least_length`` code points and ``least_count``
    occurrences on. Tasks send one row per distinct word they hold.

    ``slip`` plants misspellings: where it divides the crc32 of
    ``<doc_id>:<word>``, the word loses the code point at that crc32 modulo its
    length. A null id reads as an empty one there.
    """
    table, schema = _letters(), _COUNTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            items = sorted(held.items())
            held.clear()
            for at in range(0, len(items), 1 << 16):
                part = items[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Code points above U+00FF become "?", which parts words as they do.
                own = Counter((text.as_py() or "").encode("latin-1", "replace").translate(table).split())
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in own.items():
                    if len(word) < least_length:
                        continue
                    if slip:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield from out()
        yield from out()

    found = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _block_rows(long: Column) -> Column:
    return F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_POINTS) / long)))


def _keyed(words: DataFrame) -> DataFrame:
    """Rows ``(long, side, piece, i, j, block, word, n)``: the tiles that a word
    takes part in.

    Of two words one edit apart, the longer of ``long`` code points, the common
    prefix and suffix together reach ``long - 1``, so one of them reaches
    ``long // 2``: both words are in the group of that piece. A group of more
    rows than a block holds is split by hash, and each pair of its blocks is a tile.
    """
    size = F.char_length("word")
    sides = [(extra, side) for extra in (0, 1) for side in (0, 1)]
    keys = F.array(*(
        F.struct((size + extra).alias("long"), F.lit(side).alias("side"))
        for extra, side in sides
    ))
    half = F.expr("cast(long div 2 as int)")
    rows = words.select("word", "n", F.explode(keys).alias("k")).select(F.col("k.long").alias("long"), F.col("k.side").alias("side"), "word", "n")
    rows = rows.withColumn("piece", F.when(F.col("side") == 0, F.left("word", half)).otherwise(F.right("word", half)))
    crowded = rows.groupBy("long", "side", "piece").agg(F.count("*").alias("members")).where(F.col("members") > _block_rows(F.col("long")))
    crowded = crowded.select("long", "side", "piece", F.ceil(F.col("members") / _block_rows(F.col("long"))).cast("int").alias("blocks"))
    rows = rows.join(crowded, ["long", "side", "piece"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("*", other.alias("other"))
    return rows.select("long", "side", "piece", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n")


class Points:
    """Words as two padded matrices of code points, aligned left and right."""

    def __init__(self, words: list[str], width: int):
        text = "".join(words)
        try:
            flat, kind = np.frombuffer(text.encode("latin-1"), dtype="u1"), "u1"
        except UnicodeEncodeError:
            flat, kind = np.frombuffer(text.encode("utf-32-be"), dtype=">u4"), ">u4"
        self.size = np.array([len(w) for w in words], dtype=np.int32)
        self.left, self.right = (np.zeros((len(words), width), dtype=kind) for _ in range(2))
        column = np.arange(width)
        self.left[column < self.size[:, None]] = flat
        self.right[column >= width - self.size[:, None]] = flat


def one_edit(a: Points, rows: slice, b: Points, long: int, side: int) -> np.ndarray:
    """Which of ``a``'s rows and ``b``'s rows are one edit apart, the longer word
    of ``long`` code points: the common prefix plus the common suffix reach
    ``long - 1``. With ``side`` 1 those with a common prefix of ``long // 2``
    are left out; they are found by that prefix. Equal words may come out too."""
    shape, kind = (len(a.size[rows]), len(b.size)), np.uint8 if long < 128 else np.int32

    def common(x: np.ndarray, y: np.ndarray, columns) -> np.ndarray:
        same, total = np.ones(shape, dtype=bool), np.zeros(shape, dtype=kind)
        for c in columns:
            same &= x[rows, c, None] == y[None, :, c]
            if not same.any():
                break
            total += same
        return total

    prefix = common(a.left, b.left, range(a.left.shape[1]))
    suffix = common(a.right, b.right, range(a.right.shape[1] - 1, -1, -1))
    near = (prefix + suffix >= long - 1) & ((a.size[rows, None] == long) | (b.size[None] == long))
    return near & (prefix < long // 2) if side else near


def _near_words(keyed: DataFrame) -> DataFrame:
    """Per word and tile: how many near words, and the most frequent of them."""
    schema = _FOUND

    def compare(long: int, side: int, words: list[str], n: list[int], group: np.ndarray | None, cross: int) -> pa.RecordBatch:
        """Rows before ``cross`` against those from it on; with ``cross`` 0, all
        against those after them, of the same ``group`` if one is given."""
        points = Points(words, long)
        a, b = points, points
        if cross:
            a, b = (Points(part, long) for part in (words[:cross], words[cross:]))
        order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        count, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(words), dtype=np.int64)
        step = max(1, STRIP // len(b.size))
        for at in range(0, len(a.size), step):
            rows = slice(at, min(at + step, len(a.size)))
            near = one_edit(a, rows, b, long, side)
            if not cross:
                near &= np.arange(len(words)) > np.arange(rows.start, rows.stop)[:, None]
                if group is not None:
                    near &= group[rows, None] == group[None]
            x, y = np.nonzero(near)
            x, y = x + at, y + cross
            np.add.at(count, x, 1)
            np.add.at(count, y, 1)
            np.minimum.at(best, x, rank[y])
            np.minimum.at(best, y, rank[x])
        hit = np.flatnonzero(count)
        forms = [order[k] for k in best[hit]]
        return pa.RecordBatch.from_arrays([
            pa.array([words[k] for k in hit], pa.string()), pa.array(count[hit]), pa.array([-n[k] for k in forms], pa.int64()),
            pa.array([words[k] for k in forms], pa.string()),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (long, side), part in itertools.groupby(rows, key=lambda r: r[:2]):
            words, n, group = [], [], []
            for g, (tile, members) in enumerate(itertools.groupby(part, key=lambda r: r[2:5])):
                members = list(members)
                if len(members) < 2:
                    continue
                own, own_n = [r[6] for r in members], [r[7] for r in members]
                if tile[1] != tile[2]:
                    yield compare(long, side, own, own_n, None, sum(r[5] == tile[1] for r in members))
                elif len(own) >= SHARED:
                    yield compare(long, side, own, own_n, None, 0)
                else:
                    words, n, group = words + own, n + own_n, group + [g] * len(own)
                    if len(words) >= SHARED:
                        yield compare(long, side, words, n, np.array(group), 0)
                        words, n, group = [], [], []
            if words:
                yield compare(long, side, words, n, np.array(group), 0)

    tile = ["long", "side", "piece", "i", "j"]
    dealt = keyed.repartition(*tile).sortWithinPartitions(*tile, "block")
    return dealt.mapInArrow(run, "word string, n_near long, minus long, form string")


def _roots(links: DataFrame, deepest: int) -> DataFrame:
    """Last word of each chain of ``(word, form)``, by doubling; chains have at most ``deepest`` links."""
    reach = 1
    while reach < deepest:
        onward = links.select(F.col("word").alias("form"), F.col("form").alias("onward"))
        links = cut(links.join(onward, "form", "left").select("word", F.coalesce("onward", "form").alias("form")), "forms")
        reach *= 2
    return links.withColumnRenamed("form", "root")


def variant_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Group ``words(word, n)``, one row per word, by spelling; returns ``word, form, root, n, n_near, form_n``.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. ``form`` is the near word of largest ``n`` (ties: the
    smallest by code points) if that is at least ``ratio`` times the word's
    own, else null; ``root`` is where forms lead in the end. ``ratio`` must be 2
    or more, so that chains end. Null words are dropped.

    Words meet by a half that an edit leaves whole, and are compared in tiles of
    blocks, so no task holds more than two blocks, however many words share a
    half. Only counts and best forms leave a task, no pairs.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = cut(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).where("word is not null"), "words")
    best = _near_words(_keyed(words)).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "form")).alias("best")
    )
    known = cut(
        words.join(best, "word", "left").withColumn("fits", -F.col("best.minus") >= ratio * F.col("n")).select(
            "word", F.when(F.col("fits"), F.col("best.form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("fits"), -F.col("best.minus")).alias("form_n"),
        ), "variants",
    )
    most, least = known.agg(F.max("n"), F.min(F.greatest(F.col("n"), F.lit(1)))).first()
    deepest = 0
    while most and least * ratio <= most:
        least, deepest = least * ratio, deepest + 1
    roots = _roots(known.where("form is not null").select("word", "form"), deepest)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, slip: int | None = None,
) -> DataFrame:
    """Words of ``documents(doc_id, text)`` grouped by spelling, see
    ``count_words`` and ``variant_forms``.

    Null and empty texts have no words; texts of any length are read whole;
    repeated rows count as often as they stand; other columns are ignored; an
    empty table gives an empty result.
    """
    return variant_forms(count_words(documents, least_length, least_count, slip), ratio)


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(read_documents(spark, sf_dir), slip=199)


SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY b) AS step FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS t(b)
  )
), runs AS (
  SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL
), digits AS (
  SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits FROM runs WHERE length(run) >= {LEAST_LENGTH}
), hashed AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(length(digits) // 2), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM digits, steps
), slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM words, range(1, length(word) + 1) AS t(i)
), near AS (
  SELECT a.word, b.word AS form, b.n AS form_n FROM holes a JOIN holes b USING (i, head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.head || a.tail = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({{'minus': -form_n, 'form': form}}) AS best FROM near GROUP BY word
), known AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.minus >= {RATIO} * n THEN best.form END AS form,
         (CASE WHEN -best.minus >= {RATIO} * n THEN -best.minus END)::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS onward FROM known
  UNION ALL SELECT c.word, k.word, k.form FROM chain c JOIN known k ON k.word = c.onward
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN chain USING (word) WHERE onward IS NULL
"""
