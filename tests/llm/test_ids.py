"""Ids of any size, negative and null ones, repeated rows: operators 2, 5, 7 and 9."""

import hashlib
from collections import Counter

import numpy as np

from shelfmill.llm import suffix_dedup as suffix_module
from shelfmill.llm.common import mix
from shelfmill.llm.exact_dedup import exact_dedup
from shelfmill.llm.line_dedup import line_dedup
from shelfmill.llm.packing import best_fit_packing
from shelfmill.llm.suffix_dedup import suffix_dedup

ROWS = [
    (2**62 + 5, "same  text"), (2**63 - 1, "same text"), (None, "same\ntext"), (-(2**63), "alone"), (2**62, "twice"), (2**62, "twice"),
    (None, "none  here"), (None, "none here"), (None, "none here"), (None, None), (None, "single"), (0, ""),
]


def test_exact_dedup(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup(frame).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    same, first = sha("same text"), 2**62 + 5
    assert got == Counter([
        (first, first, 3, same), (2**63 - 1, first, 3, same), (None, first, 3, same), (-(2**63), -(2**63), 1, sha("alone")),
        *[(2**62, 2**62, 2, sha("twice"))] * 2, *[(None, None, 3, sha("none here"))] * 3, (None, 0, 2, sha("")), (None, None, 1, sha("single")), (0, 0, 2, sha("")),
    ])
    kept = Counter((r.doc_id, r.text_sha256) for r in exact_dedup(frame).where("kept").collect())
    # Of rows without id those of one text stay: one row, or the two that repeat it.
    assert kept.pop((None, sha("none here"))) in (1, 2)
    assert kept == Counter([(first, same), (-(2**63), sha("alone")), *[(2**62, sha("twice"))] * 2, (None, sha("single")), (0, sha(""))])


def test_packing(spark):
    frame = spark.createDataFrame(ROWS + [(None, "many words " * 40)] * 30, "doc_id long, text string").repartition(3)
    got = best_fit_packing(frame, length=64).collect()
    whole = Counter(r.doc_id for r in got if r.piece == 0)
    assert whole == Counter(d for d, _ in ROWS) + Counter({None: 30})
    places = Counter((r.sequence_id, r.offset + i) for r in got for i in range(r.length))
    assert max(places.values()) == 1 and max(at for _, at in places) < 64
    for sequence in {r.sequence_id for r in got}:
        own = sorted(at for s, at in places if s == sequence)
        assert own == list(range(len(own)))


def _expected_lines(rows):
    """Brute force of line dedup on ``(doc_id, text)`` rows with ids as owners; rows without one are told apart by text."""
    owner = lambda d, t: (d is None, d if d is not None else 0, t if d is None else "")
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    owners = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            owners.setdefault(key(line), set()).add(owner(d, t))
    out = Counter()
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(owners[key(x)]) == owner(d, t)]
        out[d, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_line_dedup(spark):
    """Ids of all sizes, repeated ids and rows, a line that is in all, keys with letters beyond ASCII."""
    rows = [
        (2**62 + 5, "Shared by many rows\nown line of the large"), (2**63 - 1, "shared by many rows \nOWN LINE OF THE LARGE"),
        (-(2**63), "alone in here, it is\nÄrger mit Öl und ÜBEL"), (7, "ärger mit öl und übel\nÄRGER mit Öl und übel\nÄrger mit Öl und Übel"),
        (2**62, "twice the same line\nshort"), (2**62, "twice the same line\nshort"), (2**62, "twice the same line\nother text"),
        (None, "single without an id"), (None, None), (0, ""), (3, "single without an id\n\n"),
        *[(i, f"Shared by many rows\nline of {i} or {i + 1}\nline of {i + 1} or {i + 2}") for i in range(100, 900)],
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in line_dedup(frame).collect())
    assert got == _expected_lines(rows)


def test_lines_of_rows_without_id(spark):
    """One row keeps a line that several rows without id hold."""
    rows = [(None, f"the very same line\n{i} and a line of its own") for i in range(40)]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r.n_dropped for r in got) == [0] + [1] * 39
    assert all(r.text.endswith("of its own") for r in got)


def _expected_bytes(docs):
    """Brute force of operator 2 on ``(key, text)`` in order of key; rows of one key and text are one document."""
    seen, out = set(), {}
    for key, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        out[key, text] = len(data), sum(gone), bytes(c for c, g in zip(data, gone) if not g)
    return out


def _passages():
    shared = [" ".join(f"w{(i * 37 + j * j) % 997}" for j in range(60)) for i in range(4)]
    own = lambda i: " ".join(f"o{(i * 7919 + j * 31) % 10007}" for j in range(40))
    return [
        (-(2**63), f"{own(1)} {shared[0]}"), (7, f"{shared[0]} {own(2)} {shared[1]}"), (2**62 + 5, f"{own(3)} {shared[1]} {own(4)}"),
        (2**63 - 1, f"x{shared[0]}y {shared[2]}"), (None, f"{own(5)} {shared[2]} {own(6)} {shared[3]}"), (9, None), (10, ""), (None, ""),
        (2**62, f"{own(7)} {shared[3]}"), (2**62, f"{own(7)} {shared[3]}"),
    ]


def _removed(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in suffix_dedup(frame).collect())


def test_suffix_dedup(spark):
    rows = _passages()
    ordered = sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = _expected_bytes(ordered)
    assert _removed(spark, rows) == Counter((d, *expected[d, t]) for d, t in rows)


def test_texts_of_one_id_keep_their_own_bytes(spark):
    """Spans of one text are not cut from another that has the same id."""
    long = " ".join(f"p{j}" for j in range(80))
    rows = [(1, long), (5, f"{long} tail"), (5, "z" + " ".join(f"q{j}" for j in range(90)))]
    got = {(d, n): gone for d, n, gone, _ in _removed(spark, rows)}
    assert got == {(1, len(rows[0][1])): 0, (5, len(rows[1][1])): len(long), (5, len(rows[2][1])): 0}


def test_strings_of_one_hash_are_told_apart(spark, monkeypatch):
    """With one of the two hashes the same for all strings, the result stays."""
    rows = [(d, t) for d, t in _passages() if d is not None] + [(i, f"{i} " + _passages()[1][1][i:]) for i in range(20, 40)]
    plain = _removed(spark, rows)
    calls = []

    def colliding(sum_, token, back):
        calls.append(back)
        return mix(mix(sum_) + token) if len(calls) % 2 == 0 else np.zeros(len(sum_), np.uint64)

    monkeypatch.setattr(suffix_module, "string_hash", colliding)
    assert _removed(spark, rows) == plain
