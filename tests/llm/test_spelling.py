"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from shelfmill.llm import spelling
from shelfmill.llm.spelling import count_words, spelling_variants, variant_forms

SCHEMA = "doc_id long, text string, word string, n long, form string, long int"
UPPER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(counts, ratio=5):
    form, near = {}, {}
    for a in counts:
        own = [b for b in counts if one_edit(a, b)]
        near[a] = len(own)
        best = min(own, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best and counts[best] >= ratio * counts[a] else None
    rows = []
    for a in counts:
        root = a
        while form[root]:
            root = form[root]
        rows.append((a, form[a], root, counts[a], near[a], counts.get(form[a])))
    return sorted(rows)


def counted(rows, slip=None, length=6, least=5):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least}


def result(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


def odd_texts():
    draw = random.Random(3)
    stems = ["".join(draw.choices("abcdéÿ", k=draw.randint(4, 9))) for _ in range(60)]
    words = []
    for stem in stems:
        for _ in range(draw.choice([1, 5, 30, 160])):
            words.append(stem)
            if draw.random() < 0.2:
                at = draw.randrange(len(stem))
                words.append(stem[:at] + draw.choice(["", "a", "ç" + stem[at]]) + stem[at + 1 :])
    draw.shuffle(words)
    texts = [None, "", " \n", "×÷ 12 ŒŒŒŒŒŒŒ", "É" * 20_000, "ABCDEFG abcdefg aBcDeFg ÀBCDEFG àbcdefg", "x" * 6 + " " + "x" * 7]
    texts += [draw.choice([" ", ", ", "ł", "\n"]).join(words[i : i + 40]) for i in range(0, len(words), 40)]
    texts += [" ".join(words)] * 3
    return [(None if i % 9 == 4 else i % 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("slip", [None, 3])
def test_whole_operator(spark, slip):
    rows = odd_texts()
    documents = spark.createDataFrame([(d, t, "clash", 1, "x", 2) for d, t in rows], SCHEMA).repartition(3)
    counts = counted(rows, slip)
    assert len(counts) > 60
    assert result(spelling_variants(documents, slip=slip)) == expected(counts)
    assert sum(r[1] is not None for r in expected(counts)) > 5


def test_nothing(spark):
    assert result(spelling_variants(spark.createDataFrame([], SCHEMA))) == []
    assert result(spelling_variants(spark.createDataFrame([(1, None, None, None, None, None)], SCHEMA))) == []
    assert result(variant_forms(spark.createDataFrame([(None, 4)], "word string, n long"))) == []


def test_crowded_pieces_are_split(spark, monkeypatch):
    """Many words share a half: their group is cut into blocks, and pairs across blocks are found once."""
    monkeypatch.setattr(spelling, "BLOCK", 16)
    monkeypatch.setattr(spelling, "SHARED", 8)
    monkeypatch.setattr(spelling, "STRIP", 100)
    tails = ["".join(t) for t in itertools.product("abc", repeat=4)] + ["".join(t) for t in itertools.product("ab", repeat=5)]
    counts = {"samehalf" + t: 1 + 7 * (i % 3) ** 4 for i, t in enumerate(tails)} | {t + "samehalf": 2 for t in tails[:40]}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert result(variant_forms(words)) == expected(counts)
    assert result(variant_forms(words, ratio=2)) == expected(counts, 2)


def test_chains_ties_and_wide_letters(spark):
    counts = {"aaaaaa": 1, "aaaaab": 5, "aaaabb": 25, "aaabbb": 125, "aabbbb": 625, "abbbbb": 3125, "bbbbbb": 15625}
    counts |= {"日本語日本語": 50, "日本語日本": 1, "日本語日本誌": 50, "𝒳yzxyz": 9, "yzxyz": 1, "é" * 300: 5, "é" * 301: 1}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = result(variant_forms(words))
    assert got == expected(counts)
    assert ("aaaaaa", "aaaaab", "bbbbbb", 1, 1, 5) in got
    assert ("日本語日本", "日本語日本誌", "日本語日本誌", 1, 2, 50) in got


def test_words_are_whole_runs(spark):
    rows = [(1, "word " * 5 + "naïveté! " * 5 + "straße-straße ")] * 5
    got = {r.word: r.n for r in count_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {"naïveté": 25, "straße": 10}
