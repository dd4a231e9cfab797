"""Near-duplicate detection by SetSketch registers (operator 1)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PrefixHash, cut, filter_of, in_filter, mix, read_documents, shingles
from .components import components

SHINGLE, PERCENT = 5, 75
# Registers, bands, registers per band, base of the exponential spacing, offset of
# the scale in nats. 32 bands of 4 miss a pair at similarity 0.75 in 5 of a million
# cases; with this base unrelated sets of a size share a register in 1 of 4000.
REGISTERS, BANDS, BAND, BASE, OFFSET = 512, 32, 4, 1.001, 4.0
# A pair stays a candidate unless the best similarity of 0.75 or more is less
# likely than the likeliest by so many nats (5.5 standard deviations).
NATS = 15.0
# Members and shingles of a block, pairs that share a set's making, shingles that are held
# against members at once, bits of the filter of ids whose texts move.
BLOCK, BLOCK_SHINGLES, FAN, COLUMNS, FILTER_BITS = 1024, 1 << 21, 256, 2048, 1 << 26
# Of a tile's shingles so many are sorted at once, of which every STRIDE-th finds the borders; pairs whose sketches are compared at once.
SPAN, STRIDE, PAIRS = 1 << 18, 64, 1024


def word_bytes(text: str | None) -> bytes:
    """A-Z lower-cased, words parted by one space each."""
    return b" ".join((text or "").encode("utf-8").lower().split())


def sketch(values: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Registers ``floor(1 - log_b(h))`` of the least exponential value ``h`` per
    multiplier, truncated to 16 bits. Registers of a union are the maxima of the
    parts' registers, so sketches merge."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max)
    drawn = np.empty((64, len(multipliers)), dtype=np.uint64)
    for at in range(0, len(values), 64):
        part = values[at : at + 64]
        np.multiply(part[:, None], multipliers[None], out=drawn[: len(part)])
        np.minimum(least, drawn[: len(part)].min(axis=0), out=least)
    exponential = -np.log1p(-np.minimum(least.astype(np.float64) + 1.0, 2.0**64 - 2048) / 2.0**64)
    return np.clip(np.floor(1 - (np.log(exponential) - OFFSET) / math.log(BASE)), 0, 65535).astype("<u2")


def multipliers(registers: int = REGISTERS) -> np.ndarray:
    return mix(np.arange(1, registers + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _key():
    """Tells rows apart by id and text, as rows may share an id."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("id"), _key().alias("key"), F.col("text").cast("string").alias("text"))


def _place(id_: str = "id", key: str = "key"):
    """Order of rows: by id, those without one last, then by key."""
    return F.struct(F.col(id_).isNull().alias("none"), F.col(id_).alias("id"), F.col(key).alias("key"))


def sketches(documents: DataFrame) -> DataFrame:
    """``id, key, digest, n, registers`` per row: key of id and text, digest of
    the word sequence, number of distinct shingles, sketch (empty without words).
    Whole texts are read where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, factors = PrefixHash(), multipliers()
        for batch in batches:
            digest, n, registers = [], [], []
            for text in batch.column("text"):
                words = word_bytes(text.as_py())
                values = shingles(hashes.words(words), SHINGLE)
                digest.append(hashlib.blake2b(words, digest_size=16).digest())
                n.append(len(values))
                registers.append(sketch(values, factors).tobytes() if len(values) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(registers, pa.binary())],
                ["id", "key", "digest", "n", "registers"],
            )

    return _keyed(documents).mapInArrow(run, "id long, key long, digest binary, n long, registers binary")


def plausible(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs may reach the similarity: sizes allow it, and the joint
    likelihood of equal, greater and smaller registers does not speak against."""
    greater, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - greater - smaller
    share = n_a / (n_a + n_b)

    def likelihood(similarity: np.ndarray) -> np.ndarray:
        def p(x):
            return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / math.log(BASE)

        up = np.clip(p(share - (1 - share) * similarity), 1e-12, 1.0)
        down = np.clip(p(1 - share - share * similarity), 1e-12, 1.0)
        return greater * np.log(up) + smaller * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1.0))

    least = PERCENT / 100
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    best = np.full(len(n_a), -np.inf)
    best_high = best.copy()
    for step in np.linspace(0.0, 1.0, 41):
        similarity = step * small / large
        value = likelihood(similarity)
        best = np.maximum(best, value)
        best_high = np.where(similarity >= least, np.maximum(best_high, value), best_high)
    best_high = np.maximum(best_high, likelihood(np.full(len(n_a), least)))
    return (100 * small >= PERCENT * large) & (best_high >= best - NATS)


def _registers(column) -> np.ndarray:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype="<u2").reshape(len(parts), -1)


def _words(registers: np.ndarray) -> np.ndarray:
    """The banded registers, a band in each 64-bit number."""
    return np.ascontiguousarray(registers[:, : BANDS * BAND]).view("<i8")


def _allowed(batch: pa.RecordBatch) -> np.ndarray:
    """Which rows ``(na, nb, ra, rb)`` are plausible pairs."""
    out = []
    for at in range(0, batch.num_rows, PAIRS):
        n_a, n_b, a, b = (batch.column(c).slice(at, PAIRS) for c in ("na", "nb", "ra", "rb"))
        out.append(plausible(n_a.to_numpy(), n_b.to_numpy(), _registers(a).astype(np.int32), _registers(b).astype(np.int32)))
    return np.concatenate(out)


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that the sketches allow."""
    side = {x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}")) for x in "ab"}
    met = pairs.join(side["a"], "a").join(side["b"], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.select(["a", "b"]).filter(pa.array(_allowed(batch)))

    return met.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def bands(classes: DataFrame) -> DataFrame:
    """``id, n, band, value``: four 16-bit registers are one 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _words(_registers(batch.column("registers")))
                n, m = values.shape
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.repeat(batch.column(c).to_numpy(), m)) for c in ("id", "n")), pa.array(np.tile(np.arange(m, dtype=np.int32), n)),
                     pa.array(values.reshape(-1))],
                    ["id", "n", "band", "value"],
                )

    return classes.select("id", "n", "registers").mapInArrow(run, "id long, n long, band int, value long")


def _first_pairs(members: DataFrame) -> DataFrame:
    """Each member with the smallest that it meets in any bucket: one pair at most."""
    least = members.groupBy("band", "value").agg(F.min("id").alias("a"))
    return members.join(least, ["band", "value"]).where("a <> id").groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a")).select("a", "b")


def _tiles(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(band, value, kind, i, j, block, big, id, component)`` of buckets
    ``(id, n, band, value)`` that hold several components still. A bucket's largest component is cut into
    blocks, all others together too. Tiles of ``kind`` 0 hold a block of each,
    those of ``kind`` 1 two blocks of the others: the largest component meets
    none of itself, and a stray member costs it no copy but one."""
    bucket = ["band", "value"]
    marked = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = marked.groupBy(*bucket, "component").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    mixed = sizes.groupBy(*bucket).agg(
        F.max(F.struct("size", "component", "shingles")).alias("largest"), F.sum("size").alias("size"),
        F.sum("shingles").alias("shingles"), F.count("*").alias("components"),
    ).where("components > 1")
    blocks = lambda size, n: F.greatest(F.ceil(size / BLOCK), F.ceil(n / BLOCK_SHINGLES), F.lit(1)).cast("int")
    top = F.col("largest")
    mixed = mixed.select(
        *bucket, top["component"].alias("top"), blocks(top["size"], top["shingles"]).alias("of_top"),
        blocks(F.col("size") - top["size"], F.col("shingles") - top["shingles"]).alias("of_rest"),
    )
    rows = marked.join(mixed, bucket).withColumn("big", F.col("component") == F.col("top"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.when(F.col("big"), F.col("of_top")).otherwise(F.col("of_rest"))).cast("int"))
    tile = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    block, upto = F.col("block"), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tiles = F.when(F.col("big"), F.transform(upto("of_rest"), lambda x: tile(0, block, x))).otherwise(F.concat(
        F.transform(upto("of_top"), lambda x: tile(0, x, block)),
        F.transform(upto("of_rest"), lambda x: tile(1, F.least(block, x), F.greatest(block, x))),
    ))
    return rows.select(*bucket, F.explode(tiles).alias("tile"), "block", "big", "id", "component").select(*bucket, "tile.*", "block", "big", "id", "component")


TILE = ["band", "value", "kind", "i", "j"]
_ROW = "band int, value long, kind int, i int, j int, block int, big boolean, id long, component long"


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """The rows of a tile that meet each other, and whether both sides are the same."""
    kind, i, j = (table[c][0].as_py() for c in ("kind", "i", "j"))
    if kind == 0:
        big = table["big"].to_numpy()
        return np.flatnonzero(~big), np.flatnonzero(big), False
    block = table["block"].to_numpy()
    first = np.flatnonzero(block == i)
    return (first, first, True) if i == j else (first, np.flatnonzero(block == j), False)


def _suspects(members: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of each tile that may be linked, as their sketches allow, with a
    row of another component there; at most the tile's rows, and no pairs."""
    rows = _tiles(members, labels).join(classes.select("id", "n", "registers"), "id")
    names = [f.split()[0] for f in _ROW.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        comp, n = (table[c].to_numpy() for c in ("component", "n"))
        registers = _registers(table["registers"])
        words, band = _words(registers), table["band"][0].as_py()
        first, second, same = _sides(table)
        if len(first) > len(second):
            first, second = second, first
        hit = np.zeros(table.num_rows, dtype=bool)
        for x in first:
            y = second[(comp[second] != comp[x]) & ((second > x) | (not same))]
            # A pair is looked at in the first band that it shares.
            y = y[(words[y] == words[x]).argmax(axis=1) == band] if len(y) else y
            # Far below what the likelihood allows, by count alone.
            y = y[(registers[y] == registers[x]).sum(axis=1) >= 0.62 * registers.shape[1]] if len(y) else y
            if len(y):
                own = np.broadcast_to(registers[x].astype(np.int32), (len(y), registers.shape[1]))
                y = y[plausible(np.full(len(y), n[x]), n[y], own, registers[y].astype(np.int32))]
                hit[y] = True
                hit[x] |= len(y) > 0
        return table.select(names).filter(pa.array(hit))

    # Blocks are small in bytes and long in work: keep them apart.
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(2 * width, *TILE).groupBy(*TILE).applyInArrow(run, _ROW)


def common_counts(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets of numbers, each of ``first`` with
    each of ``second``: products of 0/1 matrices, some columns at a time. Numbers
    that one set alone holds count for nothing. The sets are gone through range
    by range, so that beside them and the counts a bounded part is held."""
    total = np.zeros((len(first), len(second)), dtype=np.int64)
    borders = np.sort(np.concatenate([x[::STRIDE] for x in sets]))[SPAN // STRIDE :: SPAN // STRIDE]
    edges = np.array([[0, *np.searchsorted(x, borders), len(x)] for x in sets])
    for low, high in zip(edges.T[:-1], edges.T[1:]):
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), high - low)
        values = np.concatenate([x[i:j] for x, i, j in zip(sets, low, high)])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        column = np.cumsum(np.diff(values, prepend=values[:1]) != 0)
        shared = np.bincount(column)[column] > 1
        column, owner = column[shared], owner[shared]
        column = np.cumsum(np.diff(column, prepend=column[:1]) != 0)
        columns = int(column[-1]) + 1 if len(column) else 0
        for at in range(0, columns, COLUMNS):
            part = slice(*np.searchsorted(column, (at, at + COLUMNS)))
            held = np.zeros((len(sets), min(COLUMNS, columns - at)), dtype=np.float32)
            held[owner[part], column[part] - at] = 1
            total += (held[first] @ held[second].T).astype(np.int64)
    return total


def _confirmed(suspects: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components, from full sets of the suspects of each tile. A
    tile's texts meet once; of the links it finds, it gives as many as join
    its components."""
    def run(table: pa.Table) -> pa.Table:
        hashes = PrefixHash()
        ids, comp = (table[c].to_numpy() for c in ("id", "component"))
        sets = [shingles(hashes.words(word_bytes(t.as_py())), SHINGLE) for t in table["text"]]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        first, second, _ = _sides(table)
        common = common_counts(sets, first, second)
        linked = 100 * common >= PERCENT * (size[first][:, None] + size[second][None] - common)
        linked &= comp[first][:, None] != comp[second][None]
        parent = {c: c for c in comp.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        out = []
        for x, hits in zip(first.tolist(), linked):
            near = second[hits]
            for c, k in zip(*np.unique(comp[near], return_index=True)):
                a, b = root(int(comp[x])), root(int(c))
                if a != b:
                    parent[a] = b
                    out.append(sorted((int(ids[x]), int(ids[near[k]]))))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = suspects.join(texts, "id")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(2 * width, *TILE).groupBy(*TILE).applyInArrow(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity. A text travels
    once per pair it is the larger id of; the other's set is made once for up to
    some ``FAN`` pairs, which follow it in order, so a hub is spread over tasks
    and a task holds one set at a time."""
    wide = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).cast("int").alias("parts"))
    heads = wide.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(
        texts.select(F.col("id").alias("a"), "text"), "a"
    ).select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    tails = pairs.join(wide, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).join(
        texts.select(F.col("id").alias("b"), "text"), "b"
    ).select("a", "part", "b", "text")
    rows = heads.unionByName(tails).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHash()
        own = np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text")):
                values = shingles(hashes.words(word_bytes(text.as_py())), SHINGLE)
                if b is None:
                    own = values
                    continue
                at = np.minimum(np.searchsorted(own, values), max(len(own) - 1, 0))
                common = int((own[at] == values).sum()) if len(own) else 0
                if 100 * common >= PERCENT * (len(own) + len(values) - common):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_dedup(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``documents(doc_id,
    text)``. Words are runs free of ASCII white space, A-Z lower-cased; sets are
    distinct shingles of five words, or the whole sequence if shorter. Documents
    whose sets share three quarters of their union are linked; a component is
    named by its smallest id, and ``kept`` is whether that is the row's own.

    Equal word sequences are one class from the start, named by its smallest id.
    Classes that share a band are candidates: first each with the smallest that
    it meets, then, in buckets that still hold several components, the pairs
    between those, tile by tile. Candidates pass the joint likelihood of their
    sketches and are confirmed on full sets; a tile gives no pairs but links
    that join components. Links, components and sketches stay in Spark.

    Null, empty and blank texts have no shingles and are linked with nothing, so
    each such row is its own component. A null id is the largest; its component
    is null when no other row has one. Rows that repeat an id and a text share
    its answer. Other columns are ignored; an empty table gives an empty result.
    """
    return near_classes(documents).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.when(F.col("id").isNull(), F.col("key") == F.col("head")).otherwise(F.col("id") == F.col("component")).alias("kept"),
    )


def near_classes(documents: DataFrame) -> DataFrame:
    """``id, key, n, component, head`` per row: the component's smallest id, null
    if it has none, and the key of one row that has it. Classes are known by the
    key of their first row, so texts that share an id stay apart."""
    rows = cut(sketches(documents), "sketches")
    grouped = rows.where("n > 0").groupBy("digest").agg(
        F.min(_place()).alias("first"), F.first("n").alias("n"), F.first("registers").alias("registers")
    )
    classes = cut(
        grouped.select("digest", F.col("first.key").alias("id"), F.col("first.id").alias("doc"), "n", "registers"), "classes"
    )
    every = cut(bands(classes), "bands")
    many = every.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1").drop("size")
    members = cut(every.join(many, ["band", "value"]), "members")

    def text_of(ids: DataFrame) -> DataFrame:
        """Texts of ``ids``; others are left out before they move."""
        source = _keyed(documents).select(F.col("key").alias("id"), "text")
        looked = in_filter(source, "id", filter_of(ids, "id", FILTER_BITS), FILTER_BITS, "maybe")
        return looked.where("maybe").drop("maybe").join(ids, "id").groupBy("id").agg(F.min("text").alias("text"))

    tried = cut(_likely(_first_pairs(members), classes), "pairs")
    ends = tried.select(F.col("a").alias("id")).unionByName(tried.select(F.col("b").alias("id"))).distinct()
    links = cut(_verify(tried, text_of(ends)), "links")
    labels = components(links)
    suspects = cut(_suspects(members, classes, labels), "suspects")
    if not suspects.isEmpty():
        links = cut(links.unionByName(_confirmed(suspects, text_of(suspects.select("id").distinct()))), "links")
        labels = components(links)
    marked = labels.join(classes.select("id", "doc"), "id")
    heads = marked.groupBy("component").agg(F.min(_place("doc", "id")).alias("least"))
    linked = labels.join(heads, "component").select("id", "least")
    named = classes.join(linked, "id", "left").select(
        "digest", F.coalesce("least", _place("doc", "id")).alias("least")
    )
    out = rows.drop("registers").join(named, "digest", "left").withColumn("least", F.coalesce("least", _place()))
    return out.select("id", "key", "n", F.col("least.id").alias("component"), F.col("least.key").alias("head"))


def keep_first(documents: DataFrame) -> DataFrame:
    """One row of each component of ``documents``, of the smallest id, all columns
    kept. Unrelated texts that share an id are all kept; only rows equal in id and
    text are collapsed."""
    first = near_classes(documents).where("key = head").select(F.col("key").alias("__key")).distinct()
    return documents.withColumn("__key", _key()).join(first, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(read_documents(spark, sf_dir))
