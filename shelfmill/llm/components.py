"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _followed(step: DataFrame) -> DataFrame:
    """``id, to`` where ``to`` is what following ``to`` leads to in the end. Each
    time the way is twice as long, so a path of n steps takes log n times. Ways
    lead to ever smaller ids, so they end."""
    while True:
        onward = step.select(F.col("id").alias("to"), F.col("to").alias("onward"))
        further = cut(step.join(onward, "to").select("id", F.col("onward").alias("to"), (F.col("onward") != F.col("to")).alias("moved")), "way")
        if further.where("moved").isEmpty():
            return further.select("id", "to")
        step = further.select("id", "to")


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for each end of ``links(a, b)``: the smallest id that
    can be reached. Every round follows each id to its smallest neighbour, from
    there on to that one's, down to an id without smaller neighbours, and
    contracts the links to those: at least half of the ids fall away, and a path
    in order of ids in one round. The smallest id of a component never moves, so
    it is what remains. Rounds are written to the shared folder. Minima are
    taken where rows are read, so a hub costs a row per task; the joins have one
    row per id on one side and split the other when it is skewed."""
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long"))
    known = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("to"))
        step = _followed(cut(step.select(F.col("a").alias("id"), F.least("a", "to").alias("to")), "step"))
        if known is None:
            known = step.withColumnRenamed("to", "component")
        else:
            moves = step.select(F.col("id").alias("component"), "to")
            known = known.join(moves, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        left = step.select(F.col("id").alias("a"), F.col("to").alias("a2"))
        right = step.select(F.col("id").alias("b"), F.col("to").alias("b2"))
        links = links.join(left, "a").join(right, "b").where("a2 <> b2").select(
            F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")
        ).distinct()
        links = cut(links, "links")
        if links.isEmpty():
            return cut(known, "components")
        known = cut(known, "known")
