"""Selections on the table of nodes (X4, D5), for pages too large to work on as one row."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules import Sel
from .page import matches


def marked(nodes: DataFrame, sel: Sel, name: str, key: str = "page_id") -> DataFrame:
    """Nodes with the boolean ``name``: does the node pass the selector?

    Spans of nodes nest, so a node lies inside an earlier one that passes the
    outer selector if and only if the farthest end of those is not before it. That is
    a running maximum in document order: one sort of narrow rows by (page,
    place), however many outer nodes there are, and further selectors of the same
    table use that sort again. A page's rows may spill; no array holds them.
    """
    own = F.coalesce(matches(F.struct("tag", "attrs"), replace(sel, inside=None)), F.lit(False)) if sel.tag or sel.attr else F.lit(True)
    if sel.inside is None:
        return nodes.withColumn(name, own)
    outer = f"{name}_outer"
    before = Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    reach: Column = F.max(F.when(F.col(outer), F.col("last"))).over(before)
    found = marked(nodes, sel.inside, outer, key).withColumn(name, own & F.coalesce(reach >= F.col("pre"), F.lit(False)))
    return found.drop(outer)


def select_nodes(nodes: DataFrame, sel: Sel, key: str = "page_id") -> DataFrame:
    """The nodes that pass a selector, descendant selectors included."""
    return marked(nodes, sel, "__passes", key).filter("__passes").drop("__passes")
