"""The numbered queries on the smallest tables: SQL twins, accuracy, recall."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import connect, differences
from shelfmill.llm.queries import llm_oracles, llm_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_twin(spark, name):
    assert differences(llm_queries()[name](spark, SF_DIR), connect(SF_DIR), llm_oracles()[name]) == []


@pytest.mark.parametrize("name", ["op7_line_dedup", "op9_exact_dedup"])
def test_native_plans_hold_no_python(spark, name, capsys):
    llm_queries()[name](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "BroadcastNestedLoop"))


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = llm_queries()["op10_language_id"](spark, SF_DIR).join(documents, "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 30 and right >= 0.9


def test_recall(spark):
    got = llm_queries()["op4_neighbours"](spark, SF_DIR).toPandas()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]]) & set(got.vec_id[got.query_id == ids[i]]))
    assert hits >= 0.95 * len(got)
