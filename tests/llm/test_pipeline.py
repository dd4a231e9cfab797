"""The stages one by one against brute force, each on what the one before kept."""

import os
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from shelfmill.llm.common import cut

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = spark.createDataFrame([(-5, None, None, "s", 0), (-4, "12 34 $$", None, "s", 8)], docs.schema)
    docs = docs.unionByName(junk)
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        seen.append(cut(stage(spark, seen[-1], SF_DIR), f"test{i}"))
        if i < 4:
            assert seen[-1].columns == docs.columns
    raw, spoken, lined, single, mixed, packed = ([r.asDict() for r in df.collect()] for df in seen)
    assert {r["doc_id"] for r in raw} - {r["doc_id"] for r in spoken} == {-5, -4}

    first = defaultdict(list)
    for r in spoken:
        for line in r["text"].split("\n"):
            first[line.strip(" \t\n\x0b\x0c\r").lower()].append(r["doc_id"])
    now = {r["doc_id"]: r["text"] for r in lined}
    assert len(now) == len(spoken)
    for r in spoken:
        keep = [x for x in r["text"].split("\n") if len(k := x.strip(" \t\n\x0b\x0c\r").lower()) < 10 or min(first[k]) == r["doc_id"]]
        if r["text"].isascii():
            assert now[r["doc_id"]] == "\n".join(keep)

    sets = {}
    for i, text in now.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.encode().lower().decode())
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in sets:
        for y in sets:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    assert sorted(r["doc_id"] for r in single) == sorted(i for i in sets if root(i) == i)
    assert all(r["text"] == now[r["doc_id"]] for r in single)

    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= {r["doc_id"] for r in single} and max(copies.values()) <= 2
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(mixed) - 1.5 * words(single)) <= 0.1 * words(single)

    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_languages_keep_their_own_texts(spark):
    """Clean documents stay: of a script with thousands of letters (made up here), of a language with one
    document or few, repeated ones, very long ones; columns named like the prediction's stay as they were."""
    import numpy as np

    draw = np.random.default_rng(3)
    share = 1 / np.arange(1, 4001)
    signs = lambda: "".join(chr(0x4E00 + int(i)) for i in draw.choice(4000, 300, p=share / share.sum()))
    english = [f"the cat and the house of that man number {w} stood on the hill" for w in ("one", "two", "three", "four")] * 5
    rows = [(i, signs(), "zz", "s", 7, "kept") for i in range(120)]
    rows += [(200 + i, t, "en", "s", 7, "kept") for i, t in enumerate(english)] + [(200, english[0], "en", "s", 7, "kept")]
    rows += [(300, "η γλώσσα είναι ένα μέσο επικοινωνίας", "el", "s", 7, "kept"), (301, "η γλώσσα των ανθρώπων", None, "s", 7, "kept")]
    rows += [(302, "the cat and the house " * 40_000, None, "s", 7, "kept")]
    junk = [(400, None, None, "s", 7, "kept"), (401, "", "en", "s", 7, "kept"), (402, "12 $$ --", "en", "s", 7, "kept"),
            (403, "ქართული ენა არის სხვა", None, "s", 7, "kept")]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string, score int, lang_pred string").repartition(4)
    kept = corpus_pipeline.language(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    got = Counter(map(tuple, kept.collect()))
    clean = Counter(rows)
    assert not got - clean
    lost = clean - got
    assert sum(lost.values()) <= 1 and all(r[2] == "zz" for r in lost)


def _by_hash(spark, n):
    """Ids in the order of their hashes, which once chose 3,000 documents per language."""
    from pyspark.sql import functions as F

    return [r.id for r in spark.range(n).orderBy(F.xxhash64("id")).collect()]


def test_all_labelled_documents_teach(spark):
    """Words that stand in no early document of a large language are its words too."""
    ids = _by_hash(spark, 3100)
    rows = [(i, "the cat and the house of that man" if at < 3000 else "zyzzyva quokka wombat", "en") for at, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert corpus_pipeline.language(spark, docs, SF_DIR).count() == len(rows)


def test_floors_come_from_all_documents(spark):
    """One in ten documents of a language scores about 0.1, none of them early; its floor knows them."""
    import numpy as np

    from shelfmill.llm import language_id

    ids, draw = _by_hash(spark, 3300), np.random.default_rng(5)
    rare = lambda: "the cat and " + "".join(chr(0x4E00 + int(c)) for c in draw.integers(0, 20_000, 60))
    rows = [(i, "the cat and the house of that man" if at < 3000 else rare(), "en") for at, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.train(docs)
    assert 0 < model.predict(rows[-1][1])[1] < corpus_pipeline.LEAST_KNOWN
    assert corpus_pipeline.language(spark, docs, SF_DIR).count() == len(rows)


def test_stages_on_odd_rows(spark):
    """Repeated rows and ids, nulls in all columns, very long texts, columns named like the operators' own."""
    shared = "a line that several documents share, word by word"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(i, f"{own(i)}\n{shared}", "en", f"s{i % 3}") for i in range(30)]
    rows += [rows[0], (5, own(77), "en", "s1"), (None, own(88), None, None), (None, None, None, None), (2**62 + 1, own(99), "en", None)]
    rows += [(50, f"{own(3)} and more", "en", "s0"), (51, "word " * 200_000, "en", "s2")]
    docs = spark.createDataFrame([(*r, 1, 2, 3.0, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_lines int, size int, score double, kept string").repartition(4)
    now = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, now = now, cut(stage(spark, now, SF_DIR), f"odd{i}")
        assert now.columns == docs.columns, name
        assert now.where("n_lines <> 1 or size <> 2 or score <> 3.0 or kept <> 'x'").count() == 0, name
        if name != "mixing sources":
            assert now.count() <= before.count()
    ids = Counter(r.doc_id for r in now.select("doc_id").collect())
    assert 50 not in ids and 3 in ids  # a near copy once the shared line is gone
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == ids
