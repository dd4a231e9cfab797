"""Pages read from SQL: their trees and links as temporary functions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.sql import sql_text
from ..operators.cards import page_links
from ..operators.tree import read_trees, tree_types
from ..rules import DEFAULT_PROFILE, SiteProfile


def register_pages(spark: SparkSession, profile: SiteProfile = DEFAULT_PROFILE) -> list[str]:
    """Make pages readable from SQL, for this session. Returns the names.

    ``page_tree(html)`` is the tree of a page as a struct (the one Python stage,
    in Arrow batches), ``links_of(tree)`` its links, ``pos, url, label, kinds``,
    as Catalyst expressions. Spark lets no SQL function stand inside a generator,
    so name the links first::

        SELECT page_id, inline(found)
        FROM (SELECT page_id, links_of(page_tree(html)) AS found FROM pages)

    No table function is offered: Spark plans a lateral one as a join on the
    whole HTML. An empty or null page is a tree of its root alone; one that
    cannot be read says why in ``tree.error``. Neither has links. A batch of
    pages becomes one batch of trees: :func:`shred` bounds those by nodes.
    """
    types = tree_types(profile.marks)
    tree = "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in types.items()) + ">"

    @F.arrow_udf(tree)
    def page_tree(html: pa.Array) -> pa.Array:
        return read_trees(html, profile)

    # Not deterministic as far as Spark knows, or filters on the links would read each page again.
    spark.udf.register("page_tree", page_tree.asNondeterministic())
    columns = ", ".join(f"{n} {t}" for n, t in types.items())
    parts = ", ".join(f"tree.{n}" for n in types)
    for name, takes, body in (
        ("links_of_parts", columns, sql_text(page_links(profile))),
        ("links_of", f"tree {tree}", f"links_of_parts({parts})"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURN {body}")
    return ["page_tree", "links_of"]
