"""Mixing sources to target weights (operator 6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CHARS, SPACES, cut, id_or_last, read_documents

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
DRAWS = 16


def words_of(text: Column) -> Column:
    """Number of words in a text; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACES))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, weight, target`` from ``(source, source_size)``,
    one row per source. Weights go round by code point, null last. Sources whose
    part would be above ``most`` times their size stop there, and the rest is
    shared out again by weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(table, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
    cap = F.col("source_size") * most
    filling = Window.orderBy((cap / F.col("weight")), F.col("source").asc_nulls_last())
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranked = ranked.withColumns({
        "__full": F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "__left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "__all": F.sum("source_size").over(everything) * F.lit(float(share)),
    })
    # Level if all sources before are full: it rises as long as they should be, so
    # the highest is the right one.
    level = (F.col("__all") - F.col("__full")) / F.col("__left")
    target = F.least(cap.cast("double"), F.max(level).over(everything) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _uniform(draw: Column) -> Column:
    """Between 0 and 1, from the row's id, its text's digest and the draw."""
    digest = F.md5(F.concat_ws(":", draw.cast("string"), F.col("__id").cast("string"), F.col("__digest")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def _sized(documents: DataFrame) -> DataFrame:
    return documents.withColumns({
        "__id": id_or_last(), "__digest": F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        "__source": F.col("source").cast("string"), "__size": words_of(F.col("text")),
    })


def _taken(draw: Column) -> Column:
    """Copies of a row at its source's rate: the whole part, and one by chance."""
    fraction = F.col("rate") - F.floor("rate")
    return (F.floor("rate") + F.when(_uniform(draw) < fraction, F.lit(1)).otherwise(F.lit(0))).cast("long")


def rates(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, draws: int = DRAWS,
) -> DataFrame:
    """``source, source_size, target, rate, draw`` from ``(__id, __digest,
    __source, __size)``, one row per source."""
    sizes = sized.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    goals = cut(targets(sizes, weights, share, most).drop("weight"), "goals").withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    sums = sized.join(goals, F.col("__source").eqNullSafe(F.col("source"))).groupBy(*goals.columns).agg(*[
        F.sum(_taken(F.lit(d)) * F.col("__size")).alias(f"s{d}") for d in range(draws)
    ])
    tries = F.array(*[
        F.struct(F.abs(F.col(f"s{d}") - F.col("target")).alias("off"), F.lit(d).alias("draw")) for d in range(draws)
    ])
    return cut(sums.select(*goals.columns, F.array_min(tries)["draw"].alias("draw")), "rates")


def with_copies(documents: DataFrame, **settings) -> DataFrame:
    """All rows and columns of ``documents(doc_id, text, source)`` plus
    ``__size``, the source's ``__source_size`` and ``__target``, and ``__copies``.

    Sizes are words, summed by source where they are read. Each source has a
    rate, its target over its size; a document is taken ``floor(rate)`` times
    plus once with the probability of the fraction. The chance comes from a
    hash, so reruns agree and copies of a row fare alike. Of ``draws`` seeds
    each source uses the one that lands nearest its target, in words; so one
    long document in a small source throws it off less.

    A null source is a source of its own, last in order. Null and blank texts
    have size 0; a source without words has rate 0. Rows without id are told
    apart by text. Rows that repeat an id and text each count and get the same
    number of copies. Other columns are carried along; an empty table gives an
    empty result. The number of sources, not of documents, goes through one task;
    texts don't move, but where a source's join is not a broadcast one.
    """
    narrow = cut(_sized(documents).select("__id", "__digest", "__source", "__size"), "sizes")
    chosen = rates(narrow, **settings)
    chosen = chosen.select(*[F.col(c).alias(f"__{c}" if c in ("source_size", "target") else c) for c in chosen.columns if c != "source"],
                           F.col("source").alias("__name"))
    clash = [c for c in documents.columns if c in ("rate", "draw")]
    held = documents.withColumnsRenamed({c: f"__own_{c}" for c in clash})
    met = _sized(held).join(chosen, F.col("__source").eqNullSafe(F.col("__name"))).withColumn("__copies", _taken(F.col("draw")))
    met = met.drop("rate", "draw", "__name", "__digest", "__source", "__id")
    return met.withColumnsRenamed({f"__own_{c}": c for c in clash})


def mix_sources(documents: DataFrame, **settings) -> DataFrame:
    """Rows of ``documents``, as often as :func:`with_copies` says."""
    met = with_copies(documents, **settings).where("__copies > 0")
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*documents.columns)


def op6_source_mix(spark, sf_dir: str) -> DataFrame:
    return with_copies(read_documents(spark, sf_dir)).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"), "source",
        F.col("__copies").alias("copies"),
    )


def _sql() -> str:
    def uniform(draw: str) -> str:
        return f"(('0x' || substr(md5(concat_ws(':', {draw}, doc_id::VARCHAR, digest)), 1, 12))::BIGINT / 281474976710656.0::DOUBLE)"

    sums = ", ".join(
        f"sum(size * (floor(rate) + CASE WHEN {uniform(repr(str(d)))} < rate - floor(rate) THEN 1 ELSE 0 END)) AS s{d}"
        for d in range(DRAWS)
    )
    off = ", ".join(f"{{'off': abs(s{d} - target), 'draw': {d}}}" for d in range(DRAWS))
    return rf"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
f AS (
  SELECT *, source_size * 2 AS cap,
         coalesce(sum(source_size * 2) OVER b, 0)::DOUBLE AS filled,
         (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS open,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS total
  FROM w WINDOW b AS (ORDER BY (source_size * 2)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), v AS (SELECT *, (total - filled) / open AS level FROM f),
t AS (SELECT source, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM v),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t),
j AS (SELECT d.*, r.source_size, r.target, r.rate FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
c AS (SELECT source, source_size, target, rate, {sums} FROM j GROUP BY source, source_size, target, rate),
p AS (SELECT source, list_sort([{off}])[1].draw AS draw FROM c),
e AS (SELECT j.*, (floor(rate) + CASE WHEN {uniform('p.draw::VARCHAR')} < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
      FROM j JOIN p ON j.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, copies * size AS taken, source, copies FROM e
"""


SQL = _sql()
