"""What the operators share: ids, white space, sets in filters, numeric hashes."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

cloudpickle.register_pickle_by_value(sys.modules["shelfmill"])  # task code travels with the job

# Ids are below this; rows without one are numbered from here on by their text.
NO_ID = 2**62
SPACE_CHARS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = [
    "NO_ID", "SPACES", "SPACE_CHARS", "LOWER", "UPPER", "cut", "id_or_last", "filter_of",
    "in_filter", "mix", "PrefixHash", "shingles", "read_documents",
]


def read_documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_or_last(name: str = "doc_id", text: str = "text") -> Column:
    """The id; without one, a number above all ids that differs by text."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text), 2))


# -- Bloom filters as tables of 64-bit words ---------------------------------------------------

def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits)) for seed in (11, 23)]


def filter_of(keys: DataFrame, key: str, bits: int, least: int = 1) -> DataFrame:
    """Bloom filter of the keys that may stand at least ``least`` times in
    ``keys``: rows ``(word, mask)``, at most ``bits / 64`` of them. Slots are
    counted where they are read before they move."""
    slots = keys.select(F.explode(F.array_distinct(F.array(*_slots(F.col(key), bits)))).alias("slot"))
    if least > 1:
        slots = slots.groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return slots.groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask")
    )


def in_filter(df: DataFrame, key: str, words: DataFrame, bits: int, name: str) -> DataFrame:
    """Add the boolean ``name``: false means that the key is surely not in the
    filter. The broadcast holds ``bits / 64`` rows at most."""
    found = []
    for i, slot in enumerate(_slots(F.col(key), bits)):
        side = words.select(F.col("word").alias(f"__w{i}"), F.col("mask").alias(f"__m{i}"))
        df = df.withColumn(f"__s{i}", slot)
        df = df.join(F.broadcast(side), F.expr(f"shiftright(__s{i}, 6)") == F.col(f"__w{i}"), "left")
        found.append(F.expr(f"coalesce(getbit(__m{i}, cast(__s{i} & 63 as int)), 0) = 1"))
    drop = [f"__{c}{i}" for c in "wms" for i in range(len(found))]
    return df.withColumn(name, found[0] & found[1]).drop(*drop)


# -- numeric hashes in tasks -------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PrefixHash:
    """Hash of any stretch of a byte string from two prefix sums. Made in a
    task, used for all its documents; the power tables grow with the longest.
    Of two ``seed`` values, the hashes are independent."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, seed: int = 0):
        spread = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
        self.of_byte = mix(spread ^ np.uint64(seed)) | np.uint64(1)
        self._grow(1 << 15)

    def _grow(self, n: int) -> None:
        def powers(base):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            return np.cumprod(out)

        self.power, self.inverse = powers(self.BASE), powers(pow(self.BASE, -1, 2**64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        while len(data) >= len(self.power):
            self._grow(2 * len(self.power))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.of_byte[data] * self.power[: len(data)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverse[start])

    def words(self, text: bytes) -> np.ndarray:
        """One hash per word of a text; words are runs free of ASCII white space."""
        data = np.frombuffer(text, dtype=np.uint8)
        solid = np.zeros(len(data) + 2, dtype=np.int8)
        solid[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.diff(solid)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return self.stretch(self.sums(data), start, end) + (end - start).astype(np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all ``size`` words in a row; of fewer words,
    the whole sequence is the only one."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = mix(total * np.uint64(0x9FB21C651E98DF25) + words[i : n - width + 1 + i])
    return np.unique(total)
