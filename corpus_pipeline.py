"""From raw documents to packed training sequences, five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.llm.common import cut, read_documents
from shelfmill.llm.language_id import identify, least_shares, train
from shelfmill.llm.line_dedup import line_dedup
from shelfmill.llm.near_dedup import keep_first
from shelfmill.llm.packing import best_fit_packing
from shelfmill.llm.source_mix import mix_sources

# A text of which less than this share of n-grams is known in its best language
# is rejected, as is one without a letter. Prose of alphabets has over four
# fifths; languages whose own documents score lower have a lower floor.
LEAST_KNOWN = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the labelled ones teach; where no row
    has a label nothing can be judged, and only texts without a letter go.

    Null and empty texts go; long ones are read whole; of languages that score
    the same the smaller name is taken, which matters to its floor alone; repeated
    rows stay or go together; all columns stay as they were, also those named as
    the prediction's; no rows give none."""
    model = train(docs)
    own = {"score": "__score", "lang_pred": "__lang_pred"}
    known = identify(docs.withColumnsRenamed(own), model)
    if model.languages:
        known = cut(known, "predicted")  # one prediction gives the floors and is held against them
        floors = least_shares(known, model, LEAST_KNOWN)
        floor = F.lit(0.0)
        for name, least in floors.items():
            if least < LEAST_KNOWN:
                floor = F.when(F.col("lang_pred") == name, least).otherwise(floor)
        usual = [name for name, least in floors.items() if least == LEAST_KNOWN]
        floor = F.when(F.col("lang_pred").isin(usual), LEAST_KNOWN).otherwise(floor)
        known = known.where((F.col("lang_pred") != "und") & (F.col("score") > 0) & (F.col("score") >= floor))
    else:
        known = known.where(F.col("text").rlike(r"\p{L}"))
    return known.drop(*own).withColumnsRenamed({new: old for old, new in own.items()}).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds.

    Null and empty texts keep their one empty line; texts of any length are read
    whole; of rows that repeat an id, the first by text keeps a line; all columns
    stay as they were, also those named as the counts are; no rows give none."""
    own = {"n_lines": "__n_lines", "n_dropped": "__n_dropped"}
    done = line_dedup(docs.withColumnsRenamed(own)).drop(*own)
    return done.withColumnsRenamed({new: old for old, new in own.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that of the smallest id.

    Texts without words are near to nothing and stay; of rows equal in id and
    text one stays; unrelated texts of one id all stay; other columns are kept."""
    return keep_first(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target weight says.

    Null sources are one source; texts without words have no size; repeated rows
    are taken alike; columns are kept; no rows give none."""
    return mix_sources(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mixture's tokens into sequences: a row per piece.

    Null and empty texts are their end id; long ones are cut into pieces; each
    repeated row is packed; other columns are left out; no rows give none."""
    return best_fit_packing(docs)


STAGES = [
    ("language ID", language), ("line dedup", lines), ("MinHash near-dedup", near_duplicates),
    ("mixing sources", mixture), ("best-fit packing", sequences),
]

ORACLE_SQL = None  # near-dedup and packing are not expressible; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each on what the one before wrote."""
    docs = read_documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
