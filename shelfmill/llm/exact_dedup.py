"""Exact dedup by two passes over a Bloom filter (operator 9, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, filter_of, in_filter, read_documents


def exact_dedup(documents: DataFrame, filter_bits: int = 1 << 26) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: ``doc_id, keep_id,
    group_size, kept, text_sha256``. Texts are equal when they are after each
    run of ASCII white space became one space.

    The first pass counts filter slots and keeps those that are hit twice; the
    second looks each row up. Rows whose slots are free are unique: they pass
    straight through. Only the others move, as digests, and are counted where
    they are read first, so a group of any size costs a row per task; the join
    back splits skewed partitions. ``filter_bits`` bounds the broadcast at an
    eighth of a byte per bit plus the hash table's own; with more rows than
    bits more rows move, and the result stays the same.

    Null text counts as empty, and all empty texts are one group. Rows without id
    count as larger than all others: one stays only if its whole group has none.
    Rows that repeat an id and a text are counted one by one and share ``kept``.
    Other columns are ignored; an empty table gives an empty result.
    """
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), SPACES, " ")
    id_ = F.col("doc_id").cast("long")
    # Among rows without id the text decides, so that rows equal in both stay together.
    rows = cut(
        documents.select(id_.alias("id"), F.when(id_.isNull(), F.xxhash64("text")).alias("tie"), F.sha2(F.encode(text, "UTF-8"), 256).alias("sha")),
        "exact",
    )
    twice = filter_of(rows, "sha", filter_bits, least=2)
    looked = in_filter(rows, "sha", twice, filter_bits, "maybe")
    moving = looked.where("maybe").drop("maybe")
    groups = moving.groupBy("sha").agg(F.min("id").alias("first"), F.min("tie").alias("first_tie"), F.count("*").alias("n"))
    stays = F.when(F.col("id").isNotNull(), F.col("id") == F.col("first")).otherwise(F.col("first").isNull() & (F.col("tie") == F.col("first_tie")))
    met = moving.join(groups, "sha").select("id", "sha", "first", "n", stays.alias("kept"))
    alone = looked.where("not maybe").select("id", "sha", F.col("id").alias("first"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept"))
    return met.unionByName(alone).select(
        F.col("id").alias("doc_id"), F.col("first").alias("keep_id"), F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256"),
    )


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(read_documents(spark, sf_dir))


SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents
), g AS (SELECT sha, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY sha)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.sha AS text_sha256 FROM n JOIN g USING (sha)
"""
