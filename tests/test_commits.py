"""Commits over several tables: all or nothing, upserts, key files, runs that stop."""

import pytest
from pyspark.sql import functions as F

from shelfmill import SiteProfile
from shelfmill.plans import crawl as crawl_module
from shelfmill.plans.crawl import extract, run, store_run
from shelfmill.session import cut
from shelfmill.sources import commits
from shelfmill.sources.commits import Commit, Conflict, Manifest, Store, Table, open_table
from shelfmill.sources.tables import CAMPAIGN_COLUMNS, PRODUCT_COLUMNS, crawl_store, stored_rows, visited_keys, write_campaigns
from test_crawl import PAGES, SITE, TS


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "log"), {
        "plain": Table(str(tmp_path / "plain"), "a long, b string"),
        "last": Table(str(tmp_path / "last"), "k string, n long, version long", key=("k",), columns=("k", "n")),
        "keys": Table(str(tmp_path / "keys"), "k string", bucket="k"),
    })


def frame(spark, *values, schema="a long, b string"):
    return spark.createDataFrame(list(values), schema)


def test_tables_change_at_once(spark, store, tmp_path):
    assert store.manifest() == Manifest(0, {"plain": [], "last": [], "keys": []})
    assert store.read("plain").collect() == [] and open_table(spark, str(tmp_path / "plain")) is None
    one = store.begin()
    one.append("plain", frame(spark, (1, "x"), (None, None)))
    one.append("last", frame(spark, ("u", 1), ("v", 1), schema="k string, n long"))
    assert store.read("plain").count() == 0 and rows(one.staged("plain")) == [(1, "x"), (None, None)]
    one.publish()
    assert one.written == {"plain": 2, "last": 2}
    assert rows(store.read("plain")) == [(1, "x"), (None, None)]
    two = store.begin()
    two.append("last", frame(spark, ("u", 5), ("w", 7), schema="k string, n long"))
    two.replace("plain", frame(spark, (2, "y")))
    two.append("keys", frame(spark, schema="k string"))
    two.publish()
    assert rows(open_table(spark, str(tmp_path / "last"))) == [("u", 5), ("v", 1), ("w", 7)]
    assert rows(store.read("plain")) == [(2, "y")] and store.manifest().tables["keys"] == []
    # Earlier commits stay readable until they are cleared away.
    assert rows(store.read("last", store.manifest(1)), "k", "n") == [("u", 1), ("v", 1)]
    lost = store.begin()
    lost.append("plain", frame(spark, (9, "lost")))
    # The replaced folder, the one without rows and the first manifest go; not what is under way.
    assert len(store.vacuum()) == 3
    lost.publish()
    assert rows(store.read("plain")) == [(2, "y"), (9, "lost")]


def test_the_first_of_two_runs_wins(spark, store):
    one, two = store.begin(), store.begin()
    for commit in (one, two):
        commit.append("plain", frame(spark, (1, "x")))
    two.publish()
    with pytest.raises(Conflict):
        one.publish()
    assert store.read("plain").count() == 1 and store.versions() == [1]


def test_key_files(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "MOST_FOLDERS", 3)
    for i in range(5):
        commit = store.begin()
        commit.append("keys", spark.range(100 * i, 100 * i + 100).select(F.concat(F.lit("k"), "id").alias("k")))
        commit.publish()
        assert commit.written["keys"] == 100
    assert len(store.manifest().tables["keys"]) <= 3
    assert store.read("keys").count() == 500
    wanted = frame(spark, ("k7",), ("k499",), ("no",), (None,), schema="k string")
    found = store.matching("keys", wanted)
    assert rows(found) == [("k499",), ("k7",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    files = {r.f for r in store.read("keys").where("bucket = 3").select(F.input_file_name().alias("f")).collect()}
    assert files and all("bucket=3" in f for f in files)


EARLY = f"url not in ('{SITE}/catalog/1/b', '{SITE}/p/2')"


@pytest.fixture
def pages(spark):
    found = [(i, url, html) for i, (url, html) in enumerate(PAGES)]
    return spark.createDataFrame(found, "page_id long, url string, html string").repartition(3)


def test_counts_of_late_listings(spark, pages, tmp_path):
    """A second run completes `/b`: counts and products equal a single run's, and
    a third run changes nothing. Counters and rejected pages too."""
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    whole = [str(tmp_path / n) for n in ("campaigns1", "products1")]
    bad = spark.createDataFrame([(90, f"{SITE}/p/1", "<![foo[bar]]>")], "page_id long, url string, html string")
    pages = pages.unionByName(bad)
    assert run(pages, [f"{SITE}/"], *whole, TS)["campaigns"] == 3
    got = run(pages.filter(EARLY), [f"{SITE}/"], *paths, TS)
    assert got == {
        "found": 4, "skipped": 0, "new": 4, "campaigns": 3, "corrected": 0, "products": 3, "rejected": 1,
        "open_listings": 2, "open_products": 2,
    }
    counts = ("campaign_id", "total_products_count", "unique_products_count")
    assert rows(stored_rows(spark, paths[0]), *counts)[0] == ("1", 8, 4)
    got = run(pages, [f"{SITE}/"], *paths, TS)
    assert (got["skipped"], got["campaigns"], got["corrected"], got["products"], got["rejected"]) == (3, 0, 1, 2, 0)
    for i, columns in ((0, CAMPAIGN_COLUMNS), (1, [c for c in PRODUCT_COLUMNS])):
        assert rows(stored_rows(spark, paths[i]), *columns) == rows(stored_rows(spark, whole[i]), *columns)
    assert rows(stored_rows(spark, paths[0]), *counts)[0] == ("1", 12, 5)
    assert rows(stored_rows(spark, f"{paths[0]}-rejects"), "page_id", "html") == [(90, "<![foo[bar]]>")]
    assert rows(visited_keys(spark, paths[0])) == [(f"{SITE}/catalog/{i}",) for i in (1, 2, 3)]


def test_a_run_that_stops_anywhere(spark, pages, tmp_path, monkeypatch):
    """Stop before each write of a run and before its end; what comes then is as if it had not been."""
    tight = SiteProfile(max_products=3)
    early = cut(extract(pages.filter(EARLY), [f"{SITE}/"], tight), "extracts")
    late = cut(extract(pages, [f"{SITE}/"], tight), "extracts")

    def go(store, extracts, crash=None):
        base = store.manifest()
        visited = store.read("campaign_keys", base).drop("bucket") if base.version else None
        made = [0]
        write = Commit._write

        def counted(self, *args):
            if made[0] == crash:
                raise RuntimeError("lost")
            made[0] += 1
            return write(self, *args)

        with monkeypatch.context() as patch:
            patch.setattr(Commit, "_write", counted)
            if crash == "publish":
                patch.setattr(commits, "_write_once", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            store_run(store, pages, extracts, TS, tight, visited, pending=crawl_module._open_work(store, base))
        return made[0]

    state = lambda store: {n: rows(store.read(n).drop("bucket", "version")) for n in store.tables}
    make = lambda name: crawl_store(spark, str(tmp_path / name / "campaigns"), str(tmp_path / name / "products"))
    straight = make("straight")
    writes = go(straight, early)
    first = state(straight)
    go(straight, late)
    second = state(straight)
    assert first != second and len(first["open_listings"]) == 2 and not second["open_listings"]
    crashing = make("crashing")
    for extracts, before, after, stops in ((early, None, first, ["publish"]), (late, first, second, [*range(0, writes, 2), "publish"])):
        for crash in stops:
            with pytest.raises(RuntimeError, match="lost"):
                go(crashing, extracts, crash)
            if before:
                assert state(crashing) == before
        go(crashing, extracts)
        assert state(crashing) == after


def test_tables_of_plain_files_are_taken_over(spark, pages, tmp_path):
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    old = spark.createDataFrame([("1", f"{SITE}/catalog/1", 5, 4)], "campaign_id string, campaign_url string, total_products_count long, unique_products_count long")
    write_campaigns(old, paths[0])
    run(pages, [f"{SITE}/"], *paths, TS)
    assert rows(stored_rows(spark, paths[0]), "campaign_id", "total_products_count") == [("1", 5), ("2", 1), ("3", 0)]
    assert visited_keys(spark, paths[0]).count() == 3


def test_home_pages_without_campaigns_are_kept(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("campaigns", "products")]
    frame = spark.createDataFrame([(1, f"{SITE}/", "<p>closed</p>")], "page_id long, url string, html string")
    for _ in range(2):
        with pytest.raises(ValueError, match="no campaign"):
            run(frame, [f"{SITE}/"], *paths, TS)
    assert rows(stored_rows(spark, f"{paths[0]}-rejects"), "html", "error") == [("<p>closed</p>", "no campaign on the home pages")]


def test_a_batch_reads_no_stored_row(spark, tmp_path):
    """What a batch reads hangs on its input, not on what earlier batches stored."""
    from shelfmill.sources.pages import stream_pages
    from shelfmill.streaming.extract import stream_table

    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(4):
        spark.range(i * 500, i * 500 + 600).selectExpr("id page_id", "concat('u', id) url", "'' html").coalesce(1).write.mode("append").parquet(source)
        query = stream_table(stream_pages(spark, source), out, state, ["url"])
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p.numInputRows]
        assert sum(p.numInputRows for p in progress) == 600
    assert rows(spark.read.parquet(out), "url") == sorted((f"u{i}",) for i in range(2100))
    assert progress[-1].stateOperators[0].numRowsTotal == 2100
    stream_table(stream_pages(spark, source), out, state, ["url"]).awaitTermination()
    assert spark.read.parquet(out).count() == 2100
