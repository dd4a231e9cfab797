"""Token alignment against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfmill.llm import alignment
from shelfmill.llm.alignment import align, from_bitmaps, pair_counts, planes, to_bitmaps

SCHEMA = "doc_id long, text string, n_a long, pair string, chunk int, best boolean"


def odd_texts():
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdeé", k=draw.randint(1, 9))) for _ in range(200)] + ["the", "and", "naïve", "1984", "can't", "日本", "𝒳", "<|endoftext|>", "</s>"]
    texts = [None, "", " ", "  two  spaces\n\nlines\t", "<s> </s> <unk> <|endoftext|>", "sham ▁ space", "bytes \x00\x01 ﷺ​", "x" * 5000, " " * 300]
    texts += [draw.choice([" ", "  ", ", ", "\n"]).join(draw.choices(words, k=draw.randint(1, 80))) for _ in range(120)]
    texts += [" ".join(draw.choices(words, k=30_000)), texts[12], texts[12]]
    return [(None if i % 11 == 5 else i % 90, t) for i, t in enumerate(texts)]


def tokens(text, a, b):
    """(id, start, end) of both, or nothing where they do not cut the same bytes."""
    if not text:
        return [], []
    whole = (" " + text).encode()
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    found = []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    sides = [(ids, [bytes(of[c] for c in a.id_to_token(i)) for i in ids])]
    ids = b.encode(text)
    pieces = [b.id_to_piece(i) for i in ids]
    sides.append((ids, [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]))
    for ids, parts in sides:
        if b"".join(parts) != whole:
            return [], []
        ends = np.cumsum([len(p) for p in parts]).tolist()
        found.append(list(zip(ids, [0, *ends], ends)))
    return found


def expected(rows):
    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    links, groups, sizes = [], [], []
    for _, text in rows:
        x, y = tokens(text, a, b)
        sizes.append((len(x), len(y)))
        own, j = [], 0
        for i, s, e in x:
            while j < len(y) and y[j][2] <= s:
                j += 1
            k = j
            while k < len(y) and y[k][1] < e:
                own.append((i, y[k][0]))
                k += 1
        links.append(own)
        common, parts, at = sorted({t[2] for t in x} & {t[2] for t in y}), [], [0, 0]
        for end in common:
            own_ids = []
            for k, side in enumerate((x, y)):
                stop = at[k]
                while stop < len(side) and side[stop][2] <= end:
                    stop += 1
                own_ids.append(",".join(str(t[0]) for t in side[at[k] : stop]))
                at[k] = stop
            parts.append("|".join(own_ids))
        groups.append(parts)
    n_docs = Counter(p for own in links for p in set(own))
    n_links = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (i, _), n in n_docs.items():
        most[i] = max(most[i], n)
    result = []
    for (doc, _), own, parts, (n_a, n_b) in zip(rows, links, groups, sizes):
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        result.append((doc, n_a, n_b, len(parts), len(own), sum(n_docs[p] == most[p[0]] for p in own), sum(n_docs[p] for p in own), digest))
    pairs = sorted((i, j, n, n_links[i, j], n == most[i]) for (i, j), n in n_docs.items())
    return result, pairs


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("small", [False, True])
def test_whole_operator(spark, small, monkeypatch):
    if small:  # many chunks, bitmaps sent on in parts
        monkeypatch.setattr(alignment, "BUNDLE", 500)
        monkeypatch.setattr(alignment, "HELD_LINKS", 300)
        monkeypatch.setattr(alignment, "CHUNK_LINKS", 2000)
    rows = odd_texts()
    rows = [r for r in rows if not small or len(r[1] or "") < 10_000]
    documents = spark.createDataFrame([(d, t, 9, "x", 1, True) for d, t in rows], SCHEMA).repartition(3)
    known, pairs = expected(rows)
    got = align(documents)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert order(tuple(r[n] for n in names) for r in got.collect()) == order(known)
    assert sorted((r.a, r.b, r.n_docs, r.n_links, r.best) for r in pair_counts(documents).collect()) == pairs


def test_nothing(spark):
    assert align(spark.createDataFrame([], SCHEMA)).collect() == []
    got = align(spark.createDataFrame([(None, None, None, None, None, None), (3, "", 1, "", 1, False)], SCHEMA)).collect()
    assert order(tuple(r) for r in got) == order([(None, 0, 0, 0, 0, 0, 0, ""), (3, 0, 0, 0, 0, 0, 0, "")])


def test_bitmaps():
    draw = np.random.default_rng(2)
    sets = [np.sort(draw.choice(alignment.CHUNK, n, replace=False)) for n in (1, 1023, 1024, 5, 16384, 9000, 2)]
    group = np.repeat(np.arange(len(sets)) * 7, [len(s) for s in sets])
    maps = to_bitmaps(group, np.concatenate(sets))
    assert max(len(m) for m in maps.to_pylist()) == alignment.CHUNK // 8
    for part, first in ((maps, 0), (maps.slice(2, 3), 2), (pa.concat_arrays([maps.slice(1, 2), maps.slice(4)]), None)):
        rows, slots = from_bitmaps(part)
        for i in range(len(part)):
            k = first + i if first is not None else [1, 2, 4, 5, 6][i]
            assert (np.sort(slots[rows == i]) == sets[k]).all()


def test_planes_hold_multiplicity():
    links = np.array([5 << 14 | 3] * 6 + [5 << 14 | 9] + [8 << 14 | 3] * 2)
    got = {(plane, int(p)): sorted(from_bitmaps(maps.slice(i, 1))[1]) for plane, pair, maps in planes(links) for i, p in enumerate(pair)}
    assert got == {(0, 5): [9], (1, 5): [3], (2, 5): [3], (1, 8): [3]}
