"""The column functions as temporary SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..rules import DEFAULT_PROFILE, SiteProfile
from .colors import color_from_name, color_from_phrase, is_bad_color
from .prices import discount_label, discount_pct, format_price, normalize_price, price_candidates, price_pair, to_float
from .sizes import size_tokens, sorted_size_text
from .text import clean_text, end_date_text, few_words, word_count
from .urls import (
    is_blocked_url, is_campaign_url, is_http, is_listing_url, is_product_url, page_kinds, resolve_url,
    same_url_key, url_host, url_id, url_path,
)

PLAIN = (
    clean_text, few_words, word_count, normalize_price, discount_label, to_float, is_http, same_url_key,
    url_host, url_path,
)
BY_SITE = (
    color_from_name, color_from_phrase, end_date_text, is_bad_color, is_blocked_url, is_campaign_url,
    is_listing_url, is_product_url, page_kinds, price_candidates, size_tokens, url_id,
)


def sql_text(column: Column) -> str:
    """A column as SQL that Spark can read again, lambda functions included."""
    convert = SparkSession.active()._jvm.scala.jdk.javaapi.CollectionConverters

    def many(nodes: object) -> list:
        return list(convert.asJava(nodes))

    def listed(nodes: list) -> str:
        return ", ".join(write(n) for n in nodes)

    def write(node: object) -> str:
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            name = node.functionName()  # operators are functions too; only a bare struct names its fields
            return f"{name if name == 'struct' else f'`{name}`'}({listed(many(node.arguments()))})"
        if kind == "LambdaFunction":
            names = many(node.arguments())
            shown = f"({listed(names)})" if len(names) > 1 else write(names[0])
            return f"{shown} -> {write(node.function())}"
        if kind == "CaseWhenOtherwise":
            cases = "".join(f" WHEN {write(b._1())} THEN {write(b._2())}" for b in many(node.branches()))
            other = "".join(f" ELSE {write(n)}" for n in many(node.otherwise().toList()))
            return f"CASE{cases}{other} END"
        if kind == "Cast":
            tried = "TRY_" if "Try" in node.evalMode().toString() else ""
            return f"{tried}CAST({write(node.child())} AS {node.dataType().sql()})"
        if kind == "Alias":
            return f"{write(node.child())} AS `{many(node.name())[0]}`"
        if kind == "UnresolvedExtractValue":
            return f"{write(node.child())}[{write(node.extraction())}]"
        if kind in ("Literal", "SqlExpression", "UnresolvedAttribute", "UnresolvedNamedLambdaVariable"):
            return node.sql()
        raise TypeError(f"no SQL for a column of kind {kind}")

    return write(column._jc.node())


def register(spark: SparkSession, profile: SiteProfile = DEFAULT_PROFILE) -> list[str]:
    """Make each function callable from SQL under its own name, for this session.

    A function is its Column written out as SQL text, so Catalyst inlines it and
    no Python runs. Returns the names.
    """
    made = []

    def create(name: str, takes: str, body: Column) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURN {sql_text(body)}")
        made.append(name)

    for function in PLAIN:
        create(function.__name__, "x STRING", function("x"))
    for function in BY_SITE:
        create(function.__name__, "x STRING", function("x", profile))
    create("resolve_url", "x STRING", resolve_url("x", profile.base_url))
    create("format_price", "x DOUBLE", format_price("x"))
    create("price_pair", "x ARRAY<DOUBLE>", price_pair("x"))
    create("discount_pct", "original DOUBLE, current DOUBLE", discount_pct("original", "current"))
    create("sorted_size_text", "x ARRAY<STRUCT<size: STRING, status: STRING>>", sorted_size_text(F.col("x")))
    return made
