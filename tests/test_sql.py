"""Column functions and pages called from SQL."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmill.functions.sql import register, sql_text
from shelfmill.plans.catalog import TEST_SITE, all_queries
from shelfmill.plans.sql_pages import register_pages

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_written_out_as_sql(spark):
    x = F.col("x")
    column = F.struct(
        F.transform(F.split(x, ","), lambda p, i: F.concat(p, F.lit("'\\d"), i.cast("string"))).alias("parts"),
        F.when(~x.rlike(r"^\d+$") & (x != ""), "text").when(x.isNull(), F.lit(None)).otherwise("other").alias("kind"),
        x.try_cast("int").alias("number"),
        F.struct(x.alias("in"))["in"].alias("out"),
    )
    rows = spark.createDataFrame([("a,b",), ("12",), ("",), (None,)], "x string")
    assert rows.select(F.expr(sql_text(column))).collect() == rows.select(column).collect()


def test_other_columns_are_refused(spark):
    with pytest.raises(TypeError, match="no SQL"):
        sql_text(F.row_number().over(Window.orderBy("x")))


def test_functions_run_without_python(spark):
    names = register(spark, TEST_SITE)
    assert {"resolve_url", "price_candidates", "size_tokens", "color_from_name", "page_kinds"} <= set(names)
    for name in ("sql_resolved", "sql_prices", "sql_sizes", "sql_colors"):
        plan = _plan(all_queries()[name](spark, SF_DIR))
        assert "Python" not in plan and "Arrow" not in plan, name


def test_null_and_empty_arguments(spark):
    register(spark)
    got = spark.sql(
        """SELECT resolve_url(x) AS url, price_candidates(x) AS prices, size_tokens(x) AS sizes,
                  color_from_name(x) AS color, page_kinds(x) AS kinds FROM VALUES (''), (null) AS t(x)"""
    ).collect()
    for row in got:
        assert (row.url, row.prices, row.sizes, row.color, row.kinds) == ("", [], [], "", [])


def test_pages_are_read_once(spark):
    plan = _plan(all_queries()["sql_links"](spark, SF_DIR))
    assert plan.count("ArrowEvalPython") == 1 and "Exchange hash" not in plan


def test_odd_pages_have_no_links(spark):
    register_pages(spark, TEST_SITE)
    deep = "<a href=x>" + "<b>" * 2000
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<a href='/p?q'>one</a><a>two</a>"), (4, deep)], "id int, html string")
    got = spark.sql(
        "SELECT id, found.url AS urls FROM (SELECT id, links_of(page_tree(html)) AS found FROM {pages}) ORDER BY id",
        pages=pages,
    ).collect()
    base = TEST_SITE.base_url
    assert [tuple(r) for r in got] == [(1, []), (2, []), (3, [f"{base}/p?q"]), (4, [f"{base}/x"])]
