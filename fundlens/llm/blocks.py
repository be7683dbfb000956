"""A query set against all vectors, in blocks.

Queries and vectors hash into blocks of bounded size. Every pair of a query block and a vector
block is one group of a cogroup, searched by numpy in one task's memory; a group gives at most
k rows per query, and the best k of all groups are kept per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import pick
from fundlens.session import materialize

QUERIES_PER_BLOCK = 4096
VECTORS_PER_BLOCK = 8192

KEYS = ["dim", "query_block", "block"]


def valid_vectors(df: DataFrame, id_column: str, vector_column: str, nonzero: bool = False) -> DataFrame:
    """vec_id and v (array<double>), one row per id.

    Left out: null ids, null vectors, and vectors with null, NaN or infinite components (and
    zero vectors, if nonzero). An id that repeats counts once, with its least vector.
    """
    rows = pick(df, vec_id=id_column, v=vector_column).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite)
    if nonzero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v")))


def _spread(rows: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
    """Give each row its block, and a copy for each block of the other side."""
    return rows.select(
        F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias(own),
        F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), "*")


def search(vectors: DataFrame, is_query: Column, k: int, find: Callable, score_type: str) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all groups, ties to the smaller vec_id.

    find(query_ids, queries, ids, vectors) gets a group's arrays, ids ascending, and returns
    arrays (query positions, ids, scores). Vectors meet queries of their own length only.
    """
    queries = vectors.where(is_query)
    query_blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    blocks = max(1, -(-vectors.count() // VECTORS_PER_BLOCK))
    left = _spread(queries, "query_block", query_blocks, "block", blocks)
    right = _spread(vectors, "block", blocks, "query_block", query_blocks)
    kind = pa.int64() if score_type == "long" else pa.float64()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            at, ids, scores, query_ids = [], [], [], np.empty(0, np.int64)
        else:
            query_ids, q = _arrays(left)
            at, ids, scores = find(query_ids, q, *_arrays(right))
        return pa.table({"query_id": pa.array(query_ids[np.asarray(at, np.int64)], pa.int64()),
                         "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, kind)})

    found = left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInArrow(
        run, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _arrays(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = side["vec_id"].to_numpy()
    flat = side["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1)[order]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id (ids ascend)."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]
