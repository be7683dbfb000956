import re
from collections import Counter, defaultdict

import pytest

from fundlens.llm import collocations

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, min_count, top):
    """The contract in loops over all phrases, in Python integers."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        covered = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and a >= candidates.get(p[i:j], a + 1):
                        covered.add(p[i:j])
        found = []
        for p, a in candidates.items():
            if p not in covered:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("min_count,top", [(100, 2000), (8, 50)])
def test_documents_equal_brute_force(documents, min_count, top):
    want = plain([tuple(r) for r in documents.select("lang", "text").collect()], min_count, top)
    assert len(want) > 20
    assert result(collocations.collocations(documents, min_count, top=top)) == want


def test_small_batches_and_hot_phrases(spark, monkeypatch):
    """Runs go on over many batches and partitions; the bitmaps are nearly full."""
    monkeypatch.setattr(collocations, "MAX_BITS", 15)
    monkeypatch.setattr(collocations, "BYTES_AT_ONCE", 500)
    rows = [("en", "a a a a a a a a b c")] * 300 + [(None, "x y z, x y z! X Y Z\nx y; Ünd ünd Ünd")] * 60 + [("und", "x y z w v u t s")] * 50
    rows += [("de", f"w{i % 7} w{i % 5} w{i % 3} w{i % 2} end of it {i}") for i in range(900)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert result(collocations.collocations(df, 20, top=None)) == plain(rows, 20, None)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(odd_documents):
    df = odd_documents.union(odd_documents)
    rows = [(r[2], r[1]) for r in df.collect()]
    assert result(collocations.collocations(df, 2)) == plain(rows, 2, 2000)
    assert result(collocations.collocations(df.limit(0))) == set()


def test_products_may_pass_64_bits(spark):
    """Streams of counts that no small text has."""
    big = 3 * 10**12
    rows = [([1, 0, 0, 0, 0], [1, 0, 0, 0, 0], 1, big + 1, 10**15 + 7), ([2, 0, 0, 0, 0], [2, 0, 0, 0, 0], 1, big + 3, 10**15 + 7),
            ([1, 2, 0, 0, 0], [2, 1, 0, 0, 0], 2, big - 5, 10**15 + 7)]
    streams = spark.createDataFrame(rows, "forward array<long>, backward array<long>, length int, f long, n long")
    got = collocations.scored(streams, 5).collect()
    assert [r.score for r in got] == [1000 * (big - 5) * (10**15 + 7) // ((big + 1) * (big + 3))]


def test_streams_are_merge_joined(spark):
    rows = [([1, 0, 0, 0, 0], [1, 0, 0, 0, 0], 1, 5, 9), ([1, 1, 0, 0, 0], [1, 1, 0, 0, 0], 2, 4, 9)]
    streams = spark.createDataFrame(rows, "forward array<long>, backward array<long>, length int, f long, n long")
    joined = collocations.not_contained(collocations.scored(streams, 5), streams, 5)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" not in plan
