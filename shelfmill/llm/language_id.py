"""Language identification by bit-sliced n-gram filters (operator 10)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mix, read_documents

# Bounds of the model, whatever the corpus: n-grams kept per language, slots of the filter, hash functions.
FEATURES, SLOTS, HASHES = 20_000, 1 << 19, 3
HELD = 1 << 21  # n-grams that a task holds before it counts them
SIZES = (3, 4)
_MARK = re.compile(r"[\W\d_]+")


def ngrams(text: str) -> np.ndarray:
    """Hashes of all letter n-grams of a text; runs of anything but letters are
    one space, so that word ends count."""
    codes = np.frombuffer(f" {_MARK.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.uint64)
    out = []
    for size in SIZES:
        n = len(codes) - size + 1
        if n > 0:
            total = np.full(n, size, np.uint64)
            for i in range(size):
                total = total * np.uint64(0x9FB21C651E98DF25) + codes[i : n + i]
            out.append(total)
    return mix(np.concatenate(out))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    """``slices[l]`` are the slots of language ``l`` as bits; ``masks`` holds the
    same bits turned round: per slot one number with a bit per language, so one
    look-up answers for all languages."""

    languages: list[str]
    masks: np.ndarray  # slots x words of 64 languages
    false_rate: np.ndarray

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Per language, how many of the n-grams its filter holds."""
        found = None
        for slot in _slots(grams, len(self.masks)):
            found = self.masks[slot] if found is None else found & self.masks[slot]
        return np.array(
            [np.count_nonzero(found[:, i >> 6] >> np.uint64(i & 63) & np.uint64(1)) for i in range(len(self.languages))]
        )

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of n-grams, freed of the filter's expected
        false positives; ties go to the smaller name. ``und`` without letters."""
        if not self.languages or not has_letter(text):
            return "und", 0.0
        grams = ngrams(text)
        if not len(grams):
            return "und", 0.0
        share = (self.hits(grams) / len(grams) - self.false_rate) / (1 - self.false_rate)
        best = int(np.argmax(share))
        return self.languages[best], float(min(max(share[best], 0.0), 1.0))


def _slots(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    high = grams >> np.uint64(32)
    return [((grams + np.uint64(i) * high) % np.uint64(slots)).astype(np.int64) for i in range(HASHES)]


def build(features: dict[str, np.ndarray], slots: int = SLOTS) -> Model:
    """Bloom filters of all languages in one table of masks."""
    languages = sorted(features)
    masks = np.zeros((slots, max(1, (len(languages) + 63) // 64)), np.uint64)
    false_rate = np.zeros(len(languages))
    for i, name in enumerate(languages):
        for slot in _slots(features[name], slots):
            masks[np.unique(slot), i >> 6] |= np.uint64(1) << np.uint64(i & 63)
        false_rate[i] = np.count_nonzero(masks[:, i >> 6] >> np.uint64(i & 63) & np.uint64(1)) / slots
    return Model(languages, masks, false_rate**HASHES)


def _teaching(labelled: DataFrame) -> DataFrame:
    """The rows that teach, ``doc_id, text, lang``."""
    text, lang = (F.col(c).cast("string").alias(c) for c in ("text", "lang"))
    return labelled.select("doc_id", text, lang).where("lang is not null and text is not null")


def train(labelled: DataFrame, features: int = FEATURES, slots: int = SLOTS) -> Model:
    """Model from ``(doc_id, text, lang)``; rows without lang or letter teach
    nothing. All other rows do, by their whole texts. An n-gram belongs to a language if it
    stands in two of its documents, or its only one, and is at least half as frequent there as in
    any other language; of those, the ``features`` most frequent. Only these, a
    bounded number, reach the driver."""
    taught = _teaching(labelled)
    narrow = taught.select("doc_id", "lang", F.xxhash64("text").alias("h")).distinct()
    sizes = narrow.groupBy("lang").agg(F.count("*").alias("docs"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                grams = np.unique(ngrams(text.as_py()))
                held.setdefault(lang, []).append(grams)
                size += len(grams)
                if size >= HELD:
                    yield from _counted(held)
                    held, size = {}, 0
        yield from _counted(held)

    seen = taught.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    share = seen.groupBy("gram", "lang").agg(F.sum("n").alias("n")).join(F.broadcast(sizes), "lang")
    share = share.withColumn("share", F.col("n") / F.col("docs"))
    share = share.withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    kept = share.where("n >= least(2, docs) and share * 2 >= most").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("share"), "gram"))
    ).where(F.col("rank") <= features)
    found: dict[str, np.ndarray] = {}
    for lang, grams in kept.groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect():
        found[lang] = np.sort(np.array(grams, dtype=np.int64)).view(np.uint64)
    return build(found, slots)


def _counted(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for lang, grams in held.items():
        gram, n = np.unique(np.concatenate(grams), return_counts=True)
        for i in range(0, len(gram), 1 << 16):
            part = gram[i : i + (1 << 16)].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(part)), pa.array(part), pa.array(n[i : i + (1 << 16)])], ["lang", "gram", "n"]
            )


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``documents`` plus ``lang_pred, score``. Only the
    whole text is read. Null texts and texts without a letter are ``und`` with
    score 0, as is everything when nothing was learnt. Columns of these two
    names are replaced; an empty table gives an empty one."""
    # Bounded: slots x words of languages. Plain values, as broadcasts carry no code.
    shared = documents.sparkSession.sparkContext.broadcast((model.languages, model.masks, model.false_rate))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        import pandas as pd

        known = Model(*shared.value)
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    # Not deterministic as far as Spark knows, so that a filter on the prediction moves below no join.
    predicted = documents.withColumn("__said", predict.asNondeterministic()(F.col("text").cast("string")))
    return predicted.withColumns({"lang_pred": F.col("__said.lang_pred"), "score": F.col("__said.score")}).drop("__said")


def least_shares(predicted: DataFrame, model: Model, at_most: float) -> dict[str, float]:
    """Per language, the score below which a text is none of its own: half of
    what 99 in 100 of the documents that taught it reach, and ``at_most`` at
    most. A script of many letters, or a language of few documents, has many
    n-grams that the model does not hold, so its own texts score low; that says
    how low. An n-gram counts if a second document holds it, so these scores are
    about those of new texts. One document cannot say: its language's floor is 0,
    as is that of a language none of whose documents is told right.

    ``predicted`` are all documents that taught, as ``identify`` gives them, with
    ``doc_id, text, lang``. They are read once, and a task sends a bounded sketch per language."""
    rows = predicted.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), "lang_pred", "score")
    own = F.when(F.col("lang_pred") == F.col("lang"), F.col("score"))
    key = F.struct("doc_id", F.xxhash64(F.col("text").cast("string")))
    found = rows.where("lang is not null and text is not null").groupBy("lang").agg(
        F.percentile_approx(own, 0.01, 10_000).alias("low"), F.min(key).eqNullSafe(F.max(key)).alias("single")
    )
    low = {r.lang: r.low / 2 for r in found.where("low is not null and not single").collect()}
    return {name: min(at_most, low.get(name, 0.0)) for name in model.languages}


def held_out(name: str = "doc_id"):
    return F.crc32(F.col(name).cast("string").cast("binary")) % 3 == 1


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    documents = read_documents(spark, sf_dir)
    model = train(documents.where(~F.coalesce(held_out(), F.lit(False))))
    return identify(documents.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
