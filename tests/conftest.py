import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from shelfmill.session import build_session, configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shelfmill-tests", "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over one text column ``x``."""

    def value(text, fn):
        frame = spark.createDataFrame([(text,)], "x string")
        return frame.select(fn("x").alias("v")).first().v

    return value


@pytest.fixture
def values(spark):
    """Values of an expression over many texts, in order."""

    def run(texts, fn):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
        return [r.v for r in rows.select("i", fn("x").alias("v")).orderBy("i").collect()]

    return run


@pytest.fixture
def trees(spark):
    """Shredded pages from ``(url, html)`` pairs or plain HTML texts."""
    from shelfmill.operators.tree import shred
    from shelfmill.rules import DEFAULT_PROFILE

    def build(*pages, profile=DEFAULT_PROFILE):
        rows = [
            (i, *(p if isinstance(p, tuple) else (f"https://shop.example.com/{i}", p)))
            for i, p in enumerate(pages)
        ]
        frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
        return shred(frame, profile=profile)

    return build


@pytest.fixture
def page_value(trees):
    """Value of a page expression for one HTML text."""
    from shelfmill.rules import DEFAULT_PROFILE

    def value(html, column, profile=DEFAULT_PROFILE):
        return trees(html, profile=profile).select(column.alias("v")).first().v

    return value


@pytest.fixture
def page_cases(trees):
    """Check a page expression against ``[(html, expected), …]`` in one job."""
    from shelfmill.rules import DEFAULT_PROFILE

    def check(column, cases, profile=DEFAULT_PROFILE):
        tree = trees(*[html for html, _ in cases], profile=profile)
        rows = tree.select("page_id", column.alias("v")).orderBy("page_id").collect()
        got = [tuple(r.v) if isinstance(r.v, tuple) else r.v for r in rows]
        wrong = [(h, g, e) for (h, e), g in zip(cases, got) if g != e]
        assert not wrong

    return check
