"""Components by contraction, ids of any size, mixed buckets."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from shelfmill.llm import components as module
from shelfmill.llm import near_dedup as near
from shelfmill.llm.components import components


def brute(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("kind", ["sorted chain", "shuffled chain", "star", "random"])
def test_components(spark, kind, monkeypatch):
    draw = random.Random(2)
    n = 1000
    links = {
        "sorted chain": [(i, i + 1) for i in range(n)], "star": [(7, i) for i in range(-50, 50) if i != 7],
        "random": [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)],
    }
    order = draw.sample(range(n), n)
    links["shuffled chain"] = list(zip(order, order[1:]))
    rounds, cut = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df, name: rounds.append(name) or cut(df, name))
    got = components(spark.createDataFrame(links[kind], "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == brute(links[kind])
    if kind == "sorted chain":
        assert rounds.count("step") == 1 and rounds.count("way") <= 12


def test_ids_of_any_size(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2**62 + 5, text), (2**63 - 1, text + " end"), (None, text + " other end"), (-(2**63), "alone but long enough to count here"), (2**63 - 1, None), (None, "no id"), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in near.near_dedup(frame).collect())
    assert got == [
        ((False, -(2**63)), 3, -(2**63), True), ((False, 2**62 + 5), 36, 2**62 + 5, True), ((False, 2**63 - 1), 0, 2**63 - 1, True),
        ((False, 2**63 - 1), 37, 2**62 + 5, False), ((True, 0), 1, None, True), ((True, 0), 1, None, True), ((True, 0), 38, 2**62 + 5, False),
    ]
    assert near.keep_first(frame).count() == 4


def test_mixed_buckets_meet_once(spark, monkeypatch):
    """Every pair across components shares a tile once; the largest component is not copied for a stray."""
    monkeypatch.setattr(near, "BLOCK", 4)
    sizes = {0: 30, 100: 1, 200: 9, 300: 2}
    label = {c + i: c for c, n in sizes.items() for i in range(n)}
    members = spark.createDataFrame([(i, 50, 3, 77) for i in label], "id long, n long, band int, value long")
    rows = near._tiles(members, spark.createDataFrame([(i, c) for i, c in label.items() if sizes[c] > 1], "id long, component long")).collect()
    tiles = {}
    for r in rows:
        tiles.setdefault((r.kind, r.i, r.j), []).append(r)
    seen = []
    for (kind, i, j), own in tiles.items():
        first = [r for r in own if (not r.big if kind == 0 else r.block == i)]
        second = [r for r in own if (r.big if kind == 0 else r.block == j)]
        seen += [tuple(sorted((x.id, y.id))) for x in first for y in second if x.component != y.component and (kind == 0 or i != j or x.id < y.id)]
    assert sorted(seen) == sorted((x, y) for x in label for y in label if x < y and label[x] != label[y])
    assert sum(r.big for r in rows) == 30 * 3  # 12 others in 3 blocks


def test_near_misses_beside_copies(spark):
    """A group of copies, near copies and near misses in one bucket: brute force agrees."""
    draw = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in draw.choice(120, i % 7, replace=False):
            words[at] = f"x{draw.integers(1e9)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in rows]
    links = [(a, b) for a in range(160) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    known = brute(links)
    got = {r.doc_id: r.component_id for r in near.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: known.get(i, i) for i in range(160)}


def test_common_counts(monkeypatch):
    monkeypatch.setattr(near, "COLUMNS", 7)
    draw = np.random.default_rng(8)
    sets = [np.unique(draw.integers(0, 90, n).astype(np.uint64) << np.uint64(40)) for n in (0, 1, 30, 60, 60, 5)]
    first, second = np.array([0, 2, 5]), np.array([1, 3, 4])
    got = near.common_counts(sets, first, second)
    assert got.tolist() == [[len(set(sets[a].tolist()) & set(sets[b].tolist())) for b in second] for a in first]
    assert near.common_counts(sets[:1], np.array([0]), np.array([0])).tolist() == [[0]]


def _peak(run):
    """What ``run`` gives, and the most bytes that it held meanwhile."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_tile_holds_little_beside_its_sets():
    """A million shingles, of which half are shared; equal sets, an empty one, one of a number, a long one."""
    draw = np.random.default_rng(9)
    pool = draw.integers(0, 2**64, 40_000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([draw.choice(pool, 20_000), draw.integers(0, 2**64, 15_000, dtype=np.uint64)])) for _ in range(40)]
    sets += [sets[0][:0], sets[0], np.sort(pool)[:1], np.arange(300_000, dtype=np.uint64)]
    first, second = np.arange(0, len(sets), 2), np.arange(1, len(sets), 2)
    got, peak = _peak(lambda: near.common_counts(sets, first, second))
    assert got.tolist() == [[len(np.intersect1d(sets[x], sets[y])) for y in second] for x in first]
    assert peak < 40 << 20


def test_pairs_of_a_batch_are_judged_in_parts():
    """Ten thousand pairs of sketches, every other of equal ones."""
    draw = np.random.default_rng(4)
    registers = [draw.integers(0, 9000, near.REGISTERS).astype("<u2").tobytes() for _ in range(100)]
    a, b = ([registers[(i + (i % 2) * side) % 100] for i in range(10_000)] for side in (0, 1))
    n = pa.array(np.full(10_000, 50))
    batch = pa.RecordBatch.from_arrays([n, n, pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["na", "nb", "ra", "rb"])
    got, peak = _peak(lambda: near._allowed(batch))
    assert got.tolist() == [i % 2 == 0 for i in range(10_000)]
    assert peak < 20 << 20
