"""Table operators against plain Python, with hot keys and other partitionings."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfmill.operators.tables import (
    best_pair, first_label, first_per_key, found_and_skipped, frontier, limit_per_key,
    listed_and_distinct, shortest_text, strongest_status, unseen, with_position,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of all rows."""
    random.seed(3)
    rows = [
        ("hot" if random.random() < 0.34 else f"k{random.randrange(40)}", random.randrange(30),
         f"u{random.randrange(60)}", i)
        for i in range(4000)
    ]
    frame = spark.createDataFrame(rows, "key string, page int, item string, id int")
    return rows, frame.repartition(7)


def groups(rows, key=lambda r: r[0]):
    found = defaultdict(list)
    for r in rows:
        found[key(r)].append(r)
    return found


def test_first_and_limit(skewed):
    rows, frame = skewed
    order = ["page", "id"]
    got = {(r.key, r.id) for r in first_per_key(frame, ["key"], order).collect()}
    place = lambda r: (r[1], r[3])
    assert got == {(k, min(g, key=place)[3]) for k, g in groups(rows).items()}
    got = {(r.key, r.id, r.p) for r in limit_per_key(frame, ["key"], order, 25, "p").collect()}
    assert got == {
        (k, r[3], i) for k, g in groups(rows).items() for i, r in enumerate(sorted(g, key=place)[:25], 1)
    }


def test_limits_cut_before_the_shuffle(skewed):
    plan = first_per_key(skewed[1], ["key"], ["page", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial, then final


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_positions(spark, skewed, partitions):
    rows, frame = skewed
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = with_position(frame, ["key"], ["page", "id"])
        assert found.columns == [*frame.columns, "position"]
        got = {(r.key, r.id, r.position) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {
        (k, r[3], i)
        for k, g in groups(rows).items()
        for i, r in enumerate(sorted(g, key=lambda r: (r[1], r[3])), 1)
    }


def test_counts(skewed):
    rows, frame = skewed
    got = {tuple(r) for r in listed_and_distinct(frame, ["key"], "page", "item").collect()}
    assert got == {
        (k, len({(r[1], r[2]) for r in g}), len({r[2] for r in g})) for k, g in groups(rows).items()
    }


def test_first_label(skewed):
    rows, frame = skewed
    got = {tuple(r) for r in first_label(frame, ["key"], "item", ["page", "id"]).collect()}
    assert got == {(k, min(g, key=lambda r: (r[1], r[3]))[2]) for k, g in groups(rows).items()}


def test_best_pair_is_independent_of_partitions(spark):
    random.seed(5)
    rows = [
        (random.randrange(5), i, random.choice([None, 10.0, 20.0, 30.0]), random.choice([None, 10.0, 15.0, 20000.0]),
         random.choice(["", "-50%"]), random.choice(["json", "page"]))
        for i in range(400)
    ]
    frame = spark.createDataFrame(
        rows, "k int, i int, original double, current double, discount string, source string"
    )
    results = [
        sorted(map(tuple, best_pair(frame.repartition(n), ["k"], ["i"]).collect())) for n in (1, 4, 16)
    ]
    assert results[0] == results[1] == results[2]
    assert [r[0] for r in results[0]] == [0, 1, 2, 3, 4]


def test_tie_goes_to_the_first(spark):
    rows = [(1, 2, 20.0, 10.0, "", "json"), (1, 1, 40.0, 20.0, "", "json"), (1, 3, 30.0, 60.0, "", "json")]
    frame = spark.createDataFrame(
        rows, "k int, i int, original double, current double, discount string, source string"
    )
    assert tuple(best_pair(frame, ["k"], ["i"]).first()) == (1, 40.0, 20.0, 95)


def test_frontier(spark):
    names = ["http://a", "ftp://b", "http://c", "http://d", "http://e"]
    found = spark.createDataFrame(list(enumerate(names)), "pos int, url string")
    stored = spark.createDataFrame([("http://a",), ("http://a",), ("http://z",)], "url string")
    http = F.col("url").startswith("http")
    take = lambda **kw: [r.url for r in frontier(found, stored, "url", ["pos"], 2, http, **kw).orderBy("pos").collect()]
    # The dropped row uses up the limit, the stored one does not.
    assert take() == ["http://c"]
    assert take(allow_duplicates=True) == ["http://a"]
    assert frontier(found, None, "url", ["pos"], None).count() == 5
    # Once all is stored, nothing is left.
    assert unseen(found, found, "url").count() == 0
    assert tuple(found_and_skipped(found, stored, "url").first()) == (5, 1, 4)


def test_status_and_shortest(spark):
    rows = [("38", "OK", "azul"), ("38", "OUT", "rojo"), ("38", "LAST", "oro"), ("M", "ALMOST", "b"), ("M", "OK", "a")]
    frame = spark.createDataFrame(rows, "size string, status string, c string")
    assert sorted(map(tuple, strongest_status(frame, ["size"]).collect())) == [("38", "OUT"), ("M", "ALMOST")]
    assert sorted(map(tuple, shortest_text(frame, ["size"], "c").collect())) == [("38", "oro"), ("M", "a")]
