from collections import Counter, defaultdict

from fundlens.llm import mixing


def simulate(sizes, weights, budget, epochs):
    """Clamp and share again, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, wanted = {}, budget * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = wanted - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > epochs * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: epochs * sizes[s] for s in above}


def check(df, **options):
    rows = mixing.mix(df, **options).collect()
    size, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    # a source is known by its target and size in the result
    for r in rows:
        key = (r.target, r.source_size)
        size[key] += r.size
        taken[key] += r.taken
        biggest[key] = max(biggest[key], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= options.get("max_epochs", 2)
    assert all(abs(taken[k] - k[0]) <= biggest[k] / 2 + 1e-6 for k in taken)
    return rows


def test_targets_follow_the_water_filling(spark):
    words = {"a": 10, "b": 500, "c": 40, "d": 3000, "é": 7, None: 90}
    df = spark.createDataFrame(
        [(100 * i + k, "w " * (n // 10) + "x " * (n % 10 if k == 0 else 0), s)
         for i, (s, n) in enumerate(words.items()) for k in range(10)], "doc_id long, text string, source string")
    want = simulate(words, mixing.WEIGHTS, 1.5, 2)
    got = {(r.source_size, round(r.target, 6)) for r in check(df)}
    assert got == {(n, round(want[s], 6)) for s, n in words.items()}
    assert sorted(check(df)) == sorted(mixing.mix(df.repartition(7)).collect())


def test_odd_rows(spark, odd_documents):
    assert len(check(odd_documents)) == odd_documents.count()
    assert mixing.mix(odd_documents.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0, 0.0, 0)] * 2


def test_one_source_with_repeated_and_null_ids(spark):
    rows = [(None if i % 3 == 0 else i % 7, "w " * (i % 11 + 1), "s") for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    total = sum(i % 11 + 1 for i in range(400))
    assert got[0].target == 1.5 * total and abs(sum(r.taken for r in got) - 1.5 * total) < 0.1 * total


def test_sample_repeats_rows_and_keeps_all_columns(odd_documents):
    got = mixing.sample(odd_documents)
    assert got.columns == odd_documents.columns
    copies = Counter()
    for r in mixing.mix(odd_documents).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r[0] for r in got.collect()) == +copies
