"""Operators over tables: first per key, limits, positions, anti-joins, picks.

Every one combines rows before its shuffle, so a key that holds a third of
all rows sends only a few rows per task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prices import score_pair
from ..functions.sizes import stock_priority, stock_state


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence, name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def limit_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence, n: int | None, position: str | None = None
) -> DataFrame:
    """First ``n`` rows per key (W2), ``None`` takes all; ``order`` must be total.
    Each task keeps at most ``n`` rows per key before the shuffle
    (``WindowGroupLimit``)."""
    if n is None:
        return df if position is None else with_position(df, keys, order, position)
    name = position or "__rank"
    kept = _ranked(df, keys, order, name).filter(F.col(name) <= n)
    return kept if position else kept.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key."""
    return limit_per_key(df, keys, order, 1)


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: str = "position"
) -> DataFrame:
    """1-based position of every row within its key (W3), as a long, with no size limit
    on a key: rows are cut into ranges of (key, order), numbered inside each
    range, and shifted by what earlier ranges hold of the same key.

    ``order`` must be total. The ranges are checkpointed, so that both uses
    see the same ones.
    """
    ranged = (
        df.repartitionByRange(*keys, *order)
        .withColumn("__range", F.spark_partition_id())
        .checkpoint()
    )
    same_key = Window.partitionBy(*keys).orderBy("__range")
    shift = F.sum("__n").over(same_key.rowsBetween(Window.unboundedPreceding, -1))
    # A range can continue only one key of an earlier range, so this table
    # has fewer rows than there are ranges: safe to broadcast.
    shifts = (
        ranged.groupBy(*keys, "__range")
        .agg(F.count("*").alias("__n"))
        .withColumn("__shift", shift)
        .filter("__shift > 0")
        .drop("__n")
    )
    local = _ranked(ranged, [*keys, "__range"], order, "__local")
    on = [local[k].eqNullSafe(shifts[k]) for k in [*keys, "__range"]]
    joined = local.join(F.broadcast(shifts), on, "left")
    at = F.col("__local") + F.coalesce(F.col("__shift"), F.lit(0))
    return joined.select(*[local[c] for c in df.columns], at.cast("long").alias(position))


def unseen(
    candidates: DataFrame, visited: DataFrame | None, key: str, allow_duplicates: bool = False
) -> DataFrame:
    """Candidates that are not stored yet (X1, E3s); all of them when
    duplicates are allowed or nothing is stored (X5)."""
    if allow_duplicates or visited is None:
        return candidates
    return candidates.join(visited.select(key), key, "left_anti")


def take_first(df: DataFrame, order: Sequence, n: int | None) -> DataFrame:
    """At most ``n`` rows in order (L1); ``None`` takes all."""
    return df if n is None else df.orderBy(*order).limit(n)


def frontier(
    candidates: DataFrame,
    visited: DataFrame | None,
    key: str,
    order: Sequence,
    n: int | None,
    keep: Column | None = None,
    allow_duplicates: bool = False,
) -> DataFrame:
    """Next candidates to work on (C24): unseen, then the limit, then the
    ``keep`` test, so that a dropped row still uses up the limit."""
    chosen = take_first(unseen(candidates, visited, key, allow_duplicates), order, n)
    return chosen if keep is None else chosen.filter(keep)


def listed_and_distinct(
    hits: DataFrame, keys: Sequence[str], page: str, item: str
) -> DataFrame:
    """Per key: items counted once per page, and distinct items (A1, A2).

    Items are reduced per (key, item) first, so a hot key is spread over all
    tasks and only counts meet at the end."""
    per_item = (
        hits.select(*keys, page, item).distinct().groupBy(*keys, item).agg(F.count("*").alias("__n"))
    )
    return per_item.groupBy(*keys).agg(
        F.sum("__n").alias("total_products_count"), F.count("*").alias("unique_products_count")
    )


def first_label(
    hits: DataFrame, keys: Sequence[str], label: str, order: Sequence[str]
) -> DataFrame:
    """Label of the earliest hit per key."""
    place = F.struct(*order)
    return hits.groupBy(*keys).agg(F.min_by(label, place).alias(label))


def best_pair(
    pairs: DataFrame,
    keys: Sequence[str],
    ord_: Sequence[str],
    original: str = "original",
    current: str = "current",
    discount: str = "discount",
    source: str = "source",
) -> DataFrame:
    """Highest-scored price pair per key, the first one on a tie (A4)."""
    usable = pairs.filter((F.col(current) > 0) & (F.col(current) <= 10000))
    high = F.when(F.col(original).isNotNull(), F.greatest(original, current))
    scored = usable.select(
        *keys, *ord_, discount, source, high.alias("o"), F.least(original, current).alias("c")
    )
    rank = (-score_pair("o", "c", discount, source)).alias("rank")
    best = scored.groupBy(*keys).agg(F.min(F.struct(rank, *ord_, "o", "c")).alias("best"))
    return best.select(
        *keys,
        F.col("best.o").alias(original),
        F.col("best.c").alias(current),
        (-F.col("best.rank")).alias("score"),
    )


def strongest_status(df: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    """Per key, the strongest of OUT, LAST, ALMOST, OK (A5)."""
    top = F.max(stock_priority(status)).alias("prio")
    return df.groupBy(*keys).agg(top).select(*keys, stock_state("prio").alias(status))


def shortest_text(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Per key, the shortest text, then the smallest."""
    place = F.struct(F.length(text), F.col(text))
    return df.groupBy(*keys).agg(F.min(place)[text].alias(text))


def found_and_skipped(
    candidates: DataFrame, visited: DataFrame, key: str
) -> DataFrame:
    """Counters of a run: found, skipped as stored, new."""
    marked = candidates.join(
        visited.select(key).distinct().withColumn("__stored", F.lit(True)), key, "left"
    )
    stored = F.coalesce("__stored", F.lit(False))
    return marked.agg(
        F.count("*").alias("found"),
        F.count_if(stored).alias("skipped"),
        F.count_if(~stored).alias("new"),
    )
