import random

import numpy as np
import pytest

from fundlens.llm import blocks, multi_index, segment_topk


def exact(rows, step, k, change, nonzero):
    """Brute force over (id, vector) pairs."""
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or (nonzero and not any(v)):
            continue
        good[i] = min(good.get(i, v), v)
    out = {}
    for q in good:
        if q % step == 0:
            pairs = [(-change(good[q], good[c]), c) for c in good if c != q and len(good[c]) == len(good[q])]
            out[q] = [(c, -s) for s, c in sorted(pairs)[:k]]
    return out


def integer(a, b):
    f = lambda v: [int(np.floor(1024 * float(x))) for x in v]
    return sum(x * y for x, y in zip(f(a), f(b)))


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, v int, query_id string")


@pytest.fixture(params=[1, 2])
def odd(request):
    rng = random.Random(request.param)
    draw = lambda n: [float(np.float32(rng.gauss(0, 1))) for _ in range(n)]
    rows = [(i, draw(7)) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # a very common vector
    rows += [(40, rows[40][1]), (None, draw(7)), (2000, None), (2001, [float("nan")] * 7), (2002, [None] * 7),
             (2003, [float("inf")] + [0.0] * 6), (2020, [0.0] * 7), (3000, draw(3)), (3001, draw(3)), (4000, []), (-100, draw(7))]
    return rows


def test_exact_top_k_is_brute_force(spark, odd, monkeypatch):
    want = {q: r for q, r in exact(odd, 100, 10, integer, False).items() if r}
    assert result(segment_topk.top_k(frame(spark, odd))) == want
    monkeypatch.setattr(blocks, "VECTORS_PER_BLOCK", 50)
    monkeypatch.setattr(blocks, "QUERIES_PER_BLOCK", 2)
    assert result(segment_topk.top_k(frame(spark, odd))) == want


def test_wide_integers(spark):
    rows = [(i, [5e3 * (i + 1), -9e3 * i]) for i in range(120)]
    assert result(segment_topk.top_k(frame(spark, rows))) == exact(rows, 100, 10, integer, False)


def test_segment_bounds_hold():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(200, 30)), rng.normal(size=(20, 30))
    true = ((q[:, None] - x[None]) ** 2).sum(2)
    before = np.zeros_like(true)
    for segments in (1, 2, 4, 8, 16):
        low = segment_topk.least_distances(*(segment_topk.segment_statistics(a, segments) for a in (q, x)))
        assert (low <= true + 1e-9).all() and low.mean() >= before.mean()
        before = low


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 256, (500, 5), dtype=np.uint8)
    index = multi_index.MultiIndex(rows)
    for radius in (0, 3, 7, 12, 20, 40):
        for code in rows[:20]:
            far = np.bitwise_count(rows ^ code).sum(1)
            assert index.within(code, radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_neighbours_hold_nine_tenths(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact(rows, 20, 20, lambda a, b: float((np.array(a) * np.array(b)).sum()), True)
    got = result(multi_index.neighbours(df))
    assert set(got) == set(want) and all(len(r) == 20 for r in got.values())
    hits = sum(len({c for c, _ in got[q]} & {c for c, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_neighbours_of_odd_rows(spark, odd):
    want = exact(odd, 20, 20, lambda a, b: float((np.array(a) * np.array(b)).sum()), True)
    got = result(multi_index.neighbours(frame(spark, odd)))
    assert set(got) == {q for q, r in want.items() if r} and 2020 not in got
    assert {q: len(r) for q, r in got.items()} == {q: len(r) for q, r in want.items() if r}
    assert multi_index.neighbours(frame(spark, odd).limit(0)).count() == 0
    assert segment_topk.top_k(frame(spark, odd).limit(0)).count() == 0
