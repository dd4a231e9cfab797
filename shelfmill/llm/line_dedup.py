"""Line dedup by range-partitioned hashes and keep bitmaps (operator 7, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import let
from .common import LOWER, SPACE_CHARS, UPPER, cut, filter_of, in_filter, read_documents

MIN_CHARS = 10
# Frequent keys are looked for in groups of hashes; a group names those with this share of its lines.
GROUPS, SHARES = 64, 128
FILTER_BITS = 1 << 26


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """A line as it is compared. Where all is ASCII, ``lower`` does the same as
    ``translate`` and is many times faster."""
    bare = F.btrim(line, F.lit(SPACE_CHARS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _rows(documents: DataFrame) -> DataFrame:
    """Rows are told apart by ``__row``: ``none`` (without id), ``id`` (or what
    the text gives) and ``text``, so that a repeated id mixes nothing. The first
    two are the order of documents, rows without id last."""
    id_, text = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    row = F.struct(id_.isNull().alias("none"), F.coalesce(id_, text).alias("id"), text.alias("text"))
    return documents.withColumn("__row", row)


def _frequent(lines: DataFrame) -> DataFrame:
    """Keys with a large share of all lines, with their first document: at most
    ``GROUPS * SHARES`` hashes. Sketches of fixed size are filled where the lines are read and
    merged by group. They only choose keys; which these are changes no result."""
    found = lines.groupBy(F.pmod("h1", F.lit(GROUPS)).alias("g")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h1, {SHARES}, {4 * SHARES})").alias("top")
    )
    hot = found.select("n", F.explode("top").alias("t")).where(F.col("t.count") * SHARES >= F.col("n"))
    return (
        lines.join(F.broadcast(hot.select(F.col("t.item").alias("h1"))), "h1", "left_semi")
        .groupBy("h1", "h2").agg(F.min(F.struct("none", "id")).alias("first"))
    )


def drop_maps(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Compressed bitmaps ``(row, drops)`` of the rows that lose lines:
    ``drops`` maps a word number to 64 bits, a set bit is a dropped line; words
    without one are left out, and a row without any is not there at all.

    128-bit hashes of all keys are dealt out by range and sorted by key,
    document and position. The sorted lines stream by once: the first of a key
    names the document that keeps it, and later lines of other documents are
    lost. Ranges end between keys, so no border needs settling. A key that
    fills a good part of all lines would not fit a range; its first document is found by
    a partial minimum in each task, and its lines are judged where they are.
    """
    lines = (
        _rows(documents)
        .select("__row", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .select("__row.*", "pos", _key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "none", "id", "text", "pos")
    )
    lines = cut(lines, "lines")
    document = F.struct("none", "id")
    split = lines.join(F.broadcast(_frequent(lines)), ["h1", "h2"], "left")
    seen = Window.partitionBy("h1", "h2").orderBy("none", "id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = split.where("first is null").drop("first").repartitionByRange("h1", "h2")
    streamed = ranges.withColumn("first", F.first(document).over(seen))
    lost = streamed.unionByName(split.where("first is not null")).where(F.col("first") != document)
    row = F.struct("none", "id", "text").alias("row")
    words = lost.groupBy("none", "id", "text", F.expr("shiftright(pos, 6)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("mask")
    )
    return words.groupBy("none", "id", "text").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("drops")
    ).select(row, "drops")


def _dense(drops: Column) -> Column:
    """The words of a bitmap as an array, those left out as zeros: a map is
    searched from its start for each look-up, an array is not."""
    def filled(entries: Column) -> Column:
        before = lambda i: F.coalesce(F.get(entries, i - 1)["key"], F.lit(-1))
        zeros = lambda n: F.array_repeat(F.lit(0).cast("long"), n)
        return F.flatten(F.transform(entries, lambda e, i: F.concat(zeros(e["key"] - before(i) - 1), F.array(e["value"]))))

    return let(F.array_sort(F.map_entries(drops)), filled)


def apply_drops(documents: DataFrame, drops: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``documents`` with its text freed of the dropped lines, plus ``n_lines``
    and ``n_dropped``; a text that loses nothing stays as it is, null included.

    Rows that a Bloom filter of the bitmaps does not know lose nothing and pass
    straight through; only texts of the others move to meet their bitmap."""
    marks = cut(drops.select(F.col("row").alias("__row"), F.col("drops").alias("__drops")), "drops")
    looked = in_filter(_rows(documents), "__row", filter_of(marks, "__row", filter_bits), filter_bits, "__maybe")
    lines = _lines(F.col("text"))
    kept = let(_dense(F.col("__drops")), lambda words: F.array_join(
        F.filter(lines, lambda _, i: F.getbit(
            F.coalesce(F.get(words, F.shiftright(i, 6)), F.lit(0).cast("long")), i.bitwiseAND(63)
        ) == 0),
        "\n",
    ))
    n_lines, none = F.size(lines).cast("long"), F.lit(0).cast("long")
    whole = looked.where("not __maybe").withColumns({"n_lines": n_lines, "n_dropped": none})
    met = (
        looked.where("__maybe")
        .join(marks, "__row", "left")
        .withColumns({
            "n_lines": n_lines,
            "n_dropped": F.coalesce(F.aggregate(F.map_values("__drops"), F.lit(0), lambda a, m: a + F.bit_count(m)), F.lit(0)).cast("long"),
            "text": F.when(F.col("__drops").isNull(), F.col("text")).otherwise(kept),
        })
        .drop("__drops")
    )
    return whole.unionByName(met).drop("__row", "__maybe")


def line_dedup(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``documents``, the text without lines that a
    smaller ``doc_id`` holds too, and ``n_lines, n_dropped``.

    Lines end at ``\\n``; a line's key is free of ASCII white space at both ends
    and A-Z are lower-cased. Keys under ``min_chars`` code points never count.
    Within the first document that holds a key all its lines stay, repeats too.
    Null and empty text are one empty line. Any id counts, negative and largest ones too. Rows without id
    count as larger than all others, and are one document where their texts are equal; rows with the same id are one document. Columns named ``n_lines`` and ``n_dropped``
    are replaced, others carried along. An empty table gives an empty one.
    """
    return apply_drops(documents, drop_maps(documents, min_chars))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return line_dedup(read_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode(text, "UTF-8"), 256).alias("kept_sha256")
    )


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (SELECT key, min(doc_id) AS first, max(doc_id) AS last FROM k WHERE length(key) >= 10 GROUP BY key),
d AS (
  SELECT k.doc_id, k.line, k.pos, coalesce(f.first <> f.last AND k.doc_id <> f.first, false) AS dropped
  FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
