import zlib
from collections import defaultdict

import numpy as np
import pytest

from fundlens.llm import language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in df.collect()}
    rows = language_id.identify(df).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def model_and_counts(order, texts):
    """A model of `texts` and plain counts of (language, context, byte)."""
    counts = defaultdict(lambda: defaultdict(int))
    total = defaultdict(int)
    for lang, text in texts:
        raw = bytes(order) + text
        for i in range(order, len(raw)):
            total[lang, int.from_bytes(raw[i - order:i + 1], "big")] += 1
            for k in range(order + 1):
                counts[lang, raw[i - k:i]][raw[i]] += 1
    langs = sorted({lang for lang, _ in texts})
    keys = sorted(total)
    model = language_id.Model(langs, np.array([langs.index(g[0]) for g in keys]),
                              np.array([g[1] for g in keys], np.int64), np.array([total[g] for g in keys], np.int64))
    return model, counts, sorted({b for _, t in texts for b in t})


def slow_bits(counts, alphabet, kept, lang, context, byte):
    """PPM with escapes and exclusion, byte by byte."""
    chain = [context[len(context) - k:] for k in range(len(context), -1, -1) if context[len(context) - k:] in kept]
    excluded, p = set(), 1.0
    for c in chain:
        seen = {b: n for b, n in counts[lang, c].items() if b not in excluded}
        if seen:
            whole = sum(seen.values()) + len(seen)
            if byte in seen:
                return -np.log2(p * seen[byte] / whole)
            p *= len(seen) / whole
        # bytes of any language's tree that this language saw here are excluded below
        excluded |= set(counts[lang, c])
    return -np.log2(p / (256 - len(excluded)))


def test_code_lengths_are_ppm(monkeypatch):
    monkeypatch.setattr(language_id, "MIN_SEEN", 1)
    texts = [("a", b"abracadabra abracadabra"), ("b", b"banana bandana cabana"), ("b", b"abba")]
    model, counts, alphabet = model_and_counts(3, texts)
    kept = {c for _, c in counts}
    for text in (b"abracadabra", b"banana", b"zebra!", b"ab", b"", b"\xff\xfe"):
        raw = bytes(3) + text
        past = bytes(b if b in alphabet else 0 for b in raw)  # unseen bytes look like the start
        want = [sum(slow_bits(counts, alphabet, kept, lang, past[i - 3:i], raw[i]) for i in range(3, len(raw))) for lang in "ab"]
        assert model.code_lengths([text])[0] == pytest.approx(want, rel=1e-5)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    texts = [("a", rng.integers(97, 103, 3000, dtype=np.uint8).tobytes()), ("b", rng.integers(97, 107, 3000, dtype=np.uint8).tobytes())]
    model, _, alphabet = model_and_counts(3, texts)
    p = np.exp2(-model.bits.astype(float)).reshape(-1, model.symbols, 2)
    p[:, 0] *= 256 - len(alphabet)
    assert len(p) > 50 and np.allclose(p.sum(1), 1, atol=1e-4)


def test_pieces_change_nothing(monkeypatch):
    model, _, _ = model_and_counts(3, [("a", b"the cat sat on the mat " * 20), ("b", b"le chat est sur le tapis " * 20)])
    texts = [b"the chat sat sur the mat" * 9, b"", b"x"]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(language_id, "BYTES_AT_ONCE", 7)
    assert np.allclose(model.code_lengths(texts), whole, rtol=1e-5)


def test_every_context_seen_often_is_in_the_tree(monkeypatch):
    monkeypatch.setattr(language_id, "MIN_SEEN", 1)
    rng = np.random.default_rng(1)
    texts = [(f"l{k:02}", rng.integers(60, 120, 300, dtype=np.uint8).tobytes()) for k in range(20)]
    model, counts, _ = model_and_counts(3, texts)
    assert len(model.child) == len({c for _, c in counts}) > 6000


def test_pruning_in_spark_keeps_all_counts(spark, documents, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_GRAMS", 500, raising=False)  # caps that there were
    monkeypatch.setattr(language_id, "TABLE_BYTES", 50_000, raising=False)
    rows = [(r.lang, r.text.encode()) for r in documents.where("lang IS NOT NULL AND text IS NOT NULL").collect()]
    want, counts, _ = model_and_counts(3, rows)
    got = language_id.train(documents.select("text", "lang"))
    total = defaultdict(int)
    for (_, context), seen in counts.items():
        total[context] += sum(seen.values())
    assert len(got.child) == sum(n >= language_id.MIN_SEEN for n in total.values()) > 1000
    assert got.langs == want.langs and np.array_equal(got.child, want.child) and np.array_equal(got.bits, want.bits)


def test_odd_rows(spark, odd_documents):
    rows = language_id.identify(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (1, 2, 8)] == ["und"] * 3 and by[1].score == 0.0
    assert all(by[i].lang_pred in {"en", "de", "fr", "es"} for i in (3, 4, 5, 6, 7, None))
    assert language_id.identify(odd_documents.limit(0)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language_id.identify(unlabelled).collect()] == ["und"]
    kept = language_id.identified(odd_documents)
    assert kept.columns == odd_documents.columns and sorted(r[0] or -1 for r in kept.collect()) == [-1, 3, 3, 4, 5, 6, 7]
