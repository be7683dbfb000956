"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments; of each the mean and the standard deviation are kept. For two
vectors the squared distance is at least the sum over segments of
length * ((mean - mean')^2 + (deviation - deviation')^2), so with the vectors' own norms these
statistics bound the inner product from above:
q.x = (|q|^2 + |x|^2 - distance^2) / 2. Few segments are tried first; pairs whose bound is
below the k-th exact score known so far are dropped, the others go to the next, finer
resolution, and the survivors are scored exactly in integers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.blocks import best_of, search, valid_vectors

K = 10
SCALE = 1024
QUERY_STEP = 100
RESOLUTIONS = (2, 8, 32)
# Queries bounded together inside a task.
QUERIES_AT_ONCE = 64


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row: mean and deviation of each segment, times the root of its length."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    parts = [x[:, a:b] for a, b in zip(cuts, cuts[1:])]
    if not parts:
        return np.zeros((len(x), 0))
    roots = [np.sqrt(p.shape[1]) for p in parts]
    return np.stack([p.mean(1) * r for p, r in zip(parts, roots)] + [p.std(1) * r for p, r in zip(parts, roots)], 1)


def least_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances, from the statistics of one resolution."""
    squares = (q * q).sum(1)[:, None] + (x * x).sum(1)[None]
    return np.maximum(squares - 2 * (q @ x.T), 0)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; whole-number floats are exact while sums stay below 2^53."""
    if not x.size or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < 2**53:
        return (q @ x.T).astype(np.int64)
    wide = np.array([[int(a) for a in row] for row in q], object) @ np.array([[int(a) for a in row] for row in x], object).T
    if any(abs(s) >= 2**63 for s in wide.flat):
        raise OverflowError("a score does not fit a long")
    return wide.astype(np.int64)


def find_in_block(k: int):
    def find(query_ids, queries, ids, vectors):
        q_all, x = np.floor(SCALE * queries), np.floor(SCALE * vectors)
        x_norm, q_norms = (x * x).sum(1), (q_all * q_all).sum(1)
        levels = [(segment_statistics(q_all, s), segment_statistics(x, s)) for s in RESOLUTIONS]
        at, found, scores = [], [], []
        for start in range(0, len(q_all), QUERIES_AT_ONCE):
            rows = slice(start, start + QUERIES_AT_ONCE)
            q, q_norm = q_all[rows], q_norms[rows]
            alive = ids[None] != query_ids[rows][:, None]  # a query's own row is no candidate
            slack = 1e-9 * (q_norm[:, None] + x_norm[None]) + 1e-6
            known = np.full(len(q), -np.inf)
            for q_stat, x_stat in levels:
                bound = (q_norm[:, None] + x_norm[None] - least_distances(q_stat[rows], x_stat)) / 2 + slack
                bound[~alive] = -np.inf
                if alive.shape[1] > k:  # exact scores of the k best bounds raise what must be reached
                    likely = np.argpartition(-bound, k - 1, axis=1)[:, :k]
                    for i in range(len(q)):
                        sure = likely[i][alive[i, likely[i]]]
                        if len(sure) == k:
                            known[i] = max(known[i], exact_scores(q[i:i + 1], x[sure]).min())
                alive &= bound >= known[:, None]
            columns = np.flatnonzero(alive.any(0))
            exact = exact_scores(q, x[columns])
            for i in range(len(q)):
                own = np.flatnonzero(alive[i, columns])
                best = own[best_of(ids[columns[own]], exact[i, own], k)]
                at.append(np.full(len(best), start + i))
                found.append(ids[columns[best]])
                scores.append(exact[i, best])
        return np.concatenate(at), np.concatenate(found), np.concatenate(scores)

    return find


def top_k(df: DataFrame, k: int = K, step: int = QUERY_STEP, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query (ids divisible by step) among all other rows.

    Vectors are floor(1024 * x) per component; the score is their inner product. Null ids and
    vectors, and vectors with null or non-finite components, take no part; an id that repeats
    counts once (`blocks.valid_vectors`); ties go to the smaller id; a query with fewer than k
    candidates gets them all, and none gives no rows. Other columns are dropped.
    """
    vectors = valid_vectors(df, id_column, vector_column)
    return search(vectors, F.col("vec_id") % step == 0, k, find_in_block(k), "long")
