"""Approximate nearest neighbours by multi-index hashing.

Codes: on a bounded sample, principal axes and rotations are learned that make signs of the
rotated components keep distances (iterative quantisation); several rotations give more bits.
Each byte of a code is a substring with an index of its own, a bitmap of rows per value. By
the pigeonhole principle a code within Hamming radius r = m * p + a of a query's (m substrings)
has one of the first a + 1 substrings within p, or another one within p - 1. So probing these
values in each index retrieves every code within the radius; the retrieved codes are checked,
and the rows that remain are ranked by their original vectors.

The radius is learned: exact neighbours of a bounded set of queries among all rows are found
once, and the radius is what holds a given part of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.blocks import best_of, search, valid_vectors

K = 20
QUERY_STEP = 20
# Vectors the rotations are fitted on, queries the radius is fitted on, and the part of their
# neighbours that it must hold. All vectors are indexed and searched.
SAMPLE = 10_000
RADIUS_QUERIES = 100
RADIUS_RECALL = 0.97
BITS = 128
ROUNDS = 25
SEED = 7

NEAR = [np.array([v for v in range(256) if v.bit_count() == d]) for d in range(9)]


def learn_rotations(sample: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The mean, and the directions (dim x bits) whose signs are the code."""
    dim, rng = sample.shape[1], np.random.default_rng(SEED)
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    reduced = centred @ axes
    directions = []
    for _ in range(-(-bits // dim)):
        turn, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(reduced @ turn > 0, 1.0, -1.0).T @ reduced)
            turn = (u @ v).T
        directions.append(axes @ turn)
    return mean, np.concatenate(directions, 1)


def codes(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """One byte per substring; without a model every vector has the same code."""
    if model is None:
        return np.zeros((len(vectors), 1), np.uint8)
    mean, directions = model
    return np.packbits((vectors - mean) @ directions > 0, axis=1)


class MultiIndex:
    """The indexes of one block of codes."""

    def __init__(self, rows: np.ndarray):
        self.codes, self.near = rows, {}
        self.buckets = [np.packbits(rows[:, j][None] == np.arange(256, dtype=np.uint8)[:, None], axis=1)
                        for j in range(rows.shape[1])]

    def probe(self, j: int, value: int, radius: int) -> np.ndarray:
        """Bitmap of the rows whose substring j is within radius of value."""
        key = (j, value, radius)
        if key not in self.near:
            values = np.concatenate(NEAR[:radius + 1]) ^ value
            self.near[key] = np.bitwise_or.reduce(self.buckets[j][values], axis=0)
        return self.near[key]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        m = len(code)
        if radius >= 8 * m:
            return np.arange(len(self.codes))
        p, a = divmod(radius, m)
        bitmap = np.zeros(self.buckets[0].shape[1], np.uint8)
        for j, value in enumerate(code.tolist()):
            reach = p if j <= a else p - 1
            if reach >= 0:
                bitmap |= self.probe(j, value, min(reach, 8))
        rows = np.flatnonzero(np.unpackbits(bitmap, count=len(self.codes)))
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1, dtype=np.int64) <= radius]


def inner_products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors have equal scores wherever they stand."""
    return (vectors * query).sum(1)


def find_in_block(k: int, models: dict, radii: dict):
    def find(query_ids, queries, ids, vectors):
        dim = vectors.shape[1]
        index = MultiIndex(codes(vectors, models.get(dim)))
        wanted = min(k, len(ids))
        at, found, scores = [], [], []
        for i, (own, q, code) in enumerate(zip(query_ids, queries, codes(queries, models.get(dim)))):
            radius, bits = radii.get(dim, 8 * len(code)), 8 * len(code)
            rows = index.within(code, radius)
            while len(rows) <= wanted and radius < bits:  # too few: look further out
                radius = min(bits, radius + max(1, bits // 16))
                rows = index.within(code, radius)
            rows = rows[ids[rows] != own]
            score = inner_products(q, vectors[rows])
            best = best_of(ids[rows], score, k)
            at.append(np.full(len(best), i))
            found.append(ids[rows[best]])
            scores.append(score[best])
        return np.concatenate(at), np.concatenate(found), np.concatenate(scores)

    return find


def learn_radii(vectors: DataFrame, is_query, models: dict, k: int) -> dict[int, int]:
    """Per vector length, the radius that holds RADIUS_RECALL of the exact neighbours.

    RADIUS_QUERIES queries, the first by a hash of the id, against all vectors.
    """
    chosen = vectors.where(is_query).orderBy(F.xxhash64("vec_id"), "vec_id").limit(RADIUS_QUERIES)
    own = [r.vec_id for r in chosen.select("vec_id").collect()]
    exact = search(vectors, F.col("vec_id").isin(own), k, find_in_block(k, {}, {}), "double")
    pairs = exact.join(vectors.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id").join(vectors, "vec_id")
    far: dict[int, list[int]] = {}
    for r in pairs.select("q", "v").collect():  # at most RADIUS_QUERIES * k rows
        model = models.get(len(r.v))
        if model is not None:
            a, b = codes(np.array([r.q, r.v]), model)
            far.setdefault(len(r.v), []).append(int(np.bitwise_count(a ^ b).sum()))
    return {dim: int(np.ceil(np.quantile(d, RADIUS_RECALL))) for dim, d in far.items()}


def neighbours(df: DataFrame, k: int = K, step: int = QUERY_STEP, id_column: str = "vec_id",
               vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (inner product) of each query (ids divisible by step).

    Candidates are all rows but the query's own. Null ids and vectors, zero vectors and vectors
    with null or non-finite components take no part; an id that repeats counts once
    (`blocks.valid_vectors`); vectors meet those of their own length; ties go to the smaller
    id; a query with fewer than k candidates gets them all. Other columns are dropped.
    """
    vectors = valid_vectors(df, id_column, vector_column, nonzero=True)
    is_query = F.col("vec_id") % step == 0
    sample: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect():
        sample.setdefault(len(r.v), []).append(r.v)
    models = {dim: learn_rotations(np.array(v)) for dim, v in sample.items() if dim and len(v) > 1}
    radii = learn_radii(vectors, is_query, models, k)
    return search(vectors, is_query, k, find_in_block(k, models, radii), "double")
