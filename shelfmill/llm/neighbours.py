"""Nearest neighbours by collision-counting hashing (operator 4)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 20
# Single projections, half-width of a window per radius, collisions that make a
# candidate, first radius and its growth. A vector at the radius collides in a
# projection with probability 0.79, so 20 of 32 find it in 98 of 100 cases.
PROJECTIONS, HALF_WIDTH, COLLISIONS, RADIUS, GROWTH = 32, 1.25, 20, 0.4, 1.1
BLOCK, QUERY_BLOCK = 8192, 4096


class Index:
    """Sorted arrays of single projections over one block of vectors.

    Largest inner product becomes nearest distance: vectors are scaled by the
    block's largest norm and get one more component that makes them unit; a
    query is scaled to unit and gets a zero."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        self.ids, self.vectors = ids, vectors
        norms = np.linalg.norm(vectors, axis=1)
        self.longest = float(norms.max())
        rest = np.sqrt(np.maximum(0.0, 1.0 - (norms / self.longest) ** 2))
        self.lines = np.random.default_rng(20).standard_normal((projections, vectors.shape[1] + 1))
        values = self.lines[:, :-1] @ (vectors.T / self.longest) + np.outer(self.lines[:, -1], rest)
        order = np.argsort(values, axis=1, kind="stable")
        # All arrays in one, each moved past the one before: one search finds the
        # places of a query in all of them.
        self.low, self.high = float(values.min()) - 1.0, float(values.max()) + 1.0
        self.shift = np.arange(projections) * (self.high - self.low + 1.0)
        self.sorted = (np.take_along_axis(values, order, axis=1) + self.shift[:, None]).reshape(-1)
        self.order = order.reshape(-1)
        self.begin = np.arange(projections) * len(ids)
        self.radius = RADIUS

    def _places(self, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.sorted, np.clip(values, self.low, self.high) + self.shift)

    def _count(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        parts = [self.order[a:b] for a, b in zip(start.tolist(), stop.tolist()) if b > a]
        return np.bincount(np.concatenate(parts), minlength=len(self.ids)) if parts else 0

    def search(self, query_id: int, query: np.ndarray, k: int, collisions: int = COLLISIONS) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the ``k`` best other vectors. Windows round
        the query's projections grow with the radius; only what a step adds is
        counted. It ends when ``k`` verified vectors lie within the radius, or
        when the radius covers everything. It starts a step below where the last
        query of the block ended; a wider window holds all of a smaller one."""
        n = len(self.ids)
        length = float(np.linalg.norm(query))
        centre = self.lines[:, :-1] @ (query / length)
        left = right = None
        counts, verified = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        rows, scores, found = [], [], np.zeros(0)
        radius = self.radius
        while True:
            last = radius >= 2.0  # no two unit vectors are further apart
            if last:
                new = np.flatnonzero(~verified)
            else:
                reach = HALF_WIDTH * radius
                low, high = self._places(centre - reach), self._places(centre + reach)
                if left is not None:
                    counts += self._count(low, left) + self._count(right, high)
                elif (high - low).sum() * 2 < len(self.order):
                    counts += self._count(low, high)
                else:  # fewer lie outside
                    counts += len(self.begin) - self._count(self.begin, low) - self._count(high, self.begin + n)
                left, right = low, high
                new = np.flatnonzero((counts >= collisions) & ~verified)
            if len(new):
                verified[new] = True
                new = new[self.ids[new] != query_id]
                rows.append(new)
                # Taking many rows out costs more than a product with all.
                scores.append((self.vectors @ query)[new] if len(new) * 6 > n else self.vectors[new] @ query)
            found = np.concatenate(scores) if scores else found
            if len(found) >= k:
                worst = np.partition(found, len(found) - k)[len(found) - k]
                if 2.0 - 2.0 * worst / (length * self.longest) <= radius * radius:
                    break
            if last:
                break
            radius *= GROWTH
        self.radius = max(RADIUS, min(radius, 2.0) / GROWTH)
        rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        if len(found) > k:
            worst = np.partition(found, len(found) - k)[len(found) - k]
            rows = rows[found >= worst - 1e-9 * max(1.0, abs(worst))]
        # Row by row, so that equal vectors have equal scores.
        exact = (self.vectors[rows] * query).sum(axis=1)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return rows[best], exact[best]


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v, dim`` of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.coalesce(fine, F.lit(False))
    ).withColumn("dim", F.size("v"))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k``
    vectors with the largest inner product, all that there are if fewer, ties to
    the smaller id; a vector never meets its own id.

    Vectors are dealt by a hash of their id into blocks of about ``block``, which
    spreads copies, and queries into blocks too; each pair of blocks is a task of
    bounded size that indexes its vectors and gives ``k`` rows per query. Vectors
    that are null, zero, or hold null or non-finite components take no part, nor
    do rows without id. Vectors of another length than the query's don't meet it.
    Repeated ids count as separate vectors. Other columns are ignored; an empty
    side gives an empty result. Recall is tested against brute force.
    """
    rows, asked = clean(vectors, id_col, vector_col), clean(queries, id_col, vector_col)
    n_rows, n_asked = rows.count(), asked.count()
    blocks, query_blocks = max(1, math.ceil(n_rows / block)), max(1, math.ceil(n_asked / query_block))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    def search(data: pa.Table, questions: pa.Table) -> pa.Table:
        kinds = (pa.int64(), pa.int64(), pa.float64())
        names = ["query_id", "vec_id", "score"]
        if not data.num_rows or not questions.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names)

        def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return table["id"].to_numpy(), flat.reshape(table.num_rows, -1)

        index = Index(*matrix(data))
        out = [], [], []
        for query_id, query in zip(*matrix(questions)):
            found, score = index.search(int(query_id), query, k)
            out[0].append(np.full(len(found), query_id))
            out[1].append(index.ids[found])
            out[2].append(score)
        return pa.Table.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(out, kinds)], names)

    key = ["dim", "rows", "asked"]
    left = dealt(rows, "rows", blocks, "asked", query_blocks).groupBy(*key)
    right = dealt(asked, "asked", query_blocks, "rows", blocks).groupBy(*key)
    partial = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op4_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


SQL = """
WITH ok AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, x -> x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, round(list_inner_product(q.v, d.v), 12) AS score
  FROM ok q JOIN ok d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
