"""Exact top-k by inner product, by columnar branch and bound.

Components become ``floor(256 * x)``. Candidates and queries are dealt into blocks of bounded size, and every pair of
blocks is one task's work. In a task the candidates lie dimension by dimension. Scores are summed over groups of dimensions,
those with most mass first; what the rest can still add is at most the product of the two vectors' remaining
norms. A candidate whose sum and bound stay below the k-th best sum less its bound is out, and the columns that follow
are read for the survivors only. Each block gives its k best per query, and the best of those are the result.

Defined cases: a vector that is null, or holds a null or a component that is not finite, takes no part, and neither does a null
``vec_id``; vectors of different lengths are not compared; ties go to the smaller ``vec_id``; of rows that repeat a query's ``vec_id``
the smallest vector is the query, and none of them is its candidate; repeated candidates each take a rank; fewer
candidates than k give fewer rows. Sums must stay below 2^63.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stash

CANDIDATES, QUERIES = 8192, 1024  # rows of a block
GROUP = 8  # dimensions summed at once
TILE = 128  # queries whose first sums are held at once


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: whole-number vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x * 256).cast("long")).alias("v")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = (column if isinstance(column, pa.Array) else column.chunk(0)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64)


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, vec_id, score) of each query's ``k`` best candidates."""
    dims = candidates.shape[1]
    largest = float(np.abs(candidates).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, dims)
    kind = np.float64 if largest < 2.0 ** 50 else np.int64  # sums are exact
    rounding = 1 + largest * 2.0 ** -50  # of a sum and its bound
    by_mass = np.argsort(-np.square(candidates.astype(np.float64)).sum(axis=0), kind="stable")
    groups = [by_mass[i:i + GROUP] for i in range(0, dims, GROUP)]
    columns = [np.ascontiguousarray(candidates[:, g].T.astype(kind)) for g in groups]
    parts = [queries[:, g].astype(kind) for g in groups]

    def left(of: list[np.ndarray]) -> list[np.ndarray]:
        """Norms of what lies behind each group, rounded up."""
        squares = [np.square(x.astype(np.float64)).sum(axis=axis) for x, axis in of]
        return [np.sqrt(sum(squares[i + 1:], np.zeros_like(squares[i]))) * (1 + 1e-9) for i in range(len(squares))]

    left_c, left_q = left([(c, 0) for c in columns]), left([(p, 1) for p in parts])
    found = []
    order = np.lexsort((np.arange(len(ids)), ids))  # so that a stable sort by score leaves ties by id
    for first in range(0, len(queries), TILE):
        tile = slice(first, first + TILE)
        sums_of_tile = parts[0][tile] @ columns[0] if groups else np.zeros((len(queries[tile]), len(ids)), np.float64)
        for q in range(len(sums_of_tile)):
            at = first + q
            alive = order[ids[order] != query_ids[at]]
            sums = sums_of_tile[q][alive]
            for g in range(len(groups)):
                if g:
                    sums = sums + parts[g][at] @ columns[g][:, alive]
                if len(alive) <= k:
                    continue
                slack = left_q[g][at] * left_c[g][alive] + (rounding if g + 1 < len(groups) else 0)
                sure = np.partition(sums - slack, len(alive) - k)[len(alive) - k]
                stay = sums + slack >= sure
                if not stay.all():
                    alive, sums = alive[stay], sums[stay]
            best = np.argsort(-sums, kind="stable")[:k]
            found += [(int(query_ids[at]), int(ids[alive[i]]), int(sums[i])) for i in best]
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best."""
    rows = stash(quantised(vectors).withColumn("dims", F.size("v")).withColumn("is_query", is_query)
                 .withColumn("deal", F.xxhash64("vec_id", F.monotonically_increasing_id())), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if("is_query")).head()
    c_blocks, q_blocks = max(1, math.ceil(n / CANDIDATES)), max(1, math.ceil(n_queries / QUERIES))
    candidates = (rows.withColumn("c", F.pmod("deal", F.lit(c_blocks)))
                  .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).select("c", "q", "dims", "vec_id", "v"))
    queries = (rows.where("is_query").groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v"))
               .withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int"))
               .withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long")))).select("c", "q", "dims", "vec_id", "v"))

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            out = best_of_block(_matrix(left["v"]), left["vec_id"].to_numpy(), _matrix(right["v"]), right["vec_id"].to_numpy(), k)
        return pa.table([pa.array([row[i] for row in out], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    best = queries.groupBy("c", "q", "dims").cogroup(candidates.groupBy("c", "q", "dims")).applyInArrow(pair, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
