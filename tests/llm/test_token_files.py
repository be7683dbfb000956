import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from fundlens.llm import rans, token_files
from fundlens.llm.word_ids import Encoder

PATH = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(open(PATH).read(), 2)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def check(library, df, rows):
    """Digests equal the library's, and starts follow each other in id order."""
    pairs = [(r[0], r[1]) for r in df.collect()]
    want = Counter()
    for doc_id, text in pairs:
        ids = ids_of(library, text)
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at, last = 0, None
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and (last is None or (r.doc_id is not None and r.doc_id >= last))
        at, last = at + r.n_tokens, r.doc_id


def test_documents(spark, library, documents, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 5000)
    check(library, documents, token_files.round_trip(documents.repartition(5), PATH).collect())


def test_odd_rows(library, odd_documents):
    df = odd_documents.union(odd_documents)
    check(library, df, token_files.round_trip(df, PATH).collect())
    assert token_files.round_trip(df.limit(0), PATH).collect() == []


def test_files_give_the_ids(spark, library, documents, tmp_path):
    token_files.write(documents, str(tmp_path / "f"), PATH)
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in token_files.read(spark, str(tmp_path / "f")).collect():
        assert r.ids == ids_of(library, text[r.doc_id])
    blocks = spark.read.parquet(str(tmp_path / "f" / "blocks")).collect()
    table = spark.read.parquet(str(tmp_path / "f" / "table")).toPandas()
    assert table.frequency.sum() == 1 << 20
    held, size = sum(b.n_ids for b in blocks), sum(len(b.data) for b in blocks)
    assert size < 0.75 * 2 * held  # smaller than two bytes an id


def test_encoder_equals_the_library(library, encoder):
    """Every Latin-1 character in every neighbourhood, contractions, special strings, others."""
    rng = random.Random(1)
    texts = [f"a{chr(i)}b 1{chr(i)}2 {chr(i)}{chr(i)} '{chr(i)} {chr(i)}'s" for i in range(256)]
    pieces = ["'", "''", "'s", "'S", "'re", "'RE", "'r", "'ll", "'ve", "'m", "'d", "'t", "a", "É", "é", "ß", "ÿ", "×", "÷", "µ", "ª", "½",
              "2", "33", " ", "  ", "\n", "\t", "\x85", "\xa0", "!", "?!", "<|", "|>", "word", "World", "re", "l", "ve", "\x1c", "\x00"]
    texts += ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(5000)]
    texts += ["".join(rng.choices([*pieces, "日本", "İ", "é", "Σ", "<|endoftext|>", "<|startoftext|>", "\U0001f600"], k=9)) for _ in range(1500)]
    texts += ["", None, "<|endoftext|>", "x" * 70_000]
    got = encoder.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, got):
        assert ids.tolist() == ids_of(library, text), repr(text)[:200]


@pytest.mark.parametrize("symbols", [1, 2, 300, 60_000])
def test_blocks_round_trip(symbols):
    rng = np.random.default_rng(symbols)
    ids = np.sort(rng.choice(200_000, symbols, replace=False))
    weight = 1 / np.arange(1, symbols + 1)
    sizes = [0, 1, 31, 32, 33, 5000, rans.CHECKPOINT * rans.LANES, rans.CHECKPOINT * rans.LANES + 1, 70_000, 200]
    blocks = [rng.choice(ids, n, p=weight / weight.sum()).astype(np.uint32) for n in sizes]
    table = rans.Table.of_counts(ids, 1e9 * weight)
    packed = rans.encode(blocks, table)
    for a, b in zip(blocks, rans.decode(packed, table)):
        assert np.array_equal(a, b)
    entropy = sum(np.log2(float(table.frequencies.sum()) / table.frequencies[np.searchsorted(table.ids, b)].astype(float)).sum() for b in blocks)
    overhead = sum(rans.HEAD + 4 * rans.LANES * 2 + (4 + 8 * rans.LANES) * (len(b) // 16384 + 1) for b in packed)
    assert sum(map(len, packed)) <= entropy / 8 * 1.001 + overhead + 300 * len(sizes)


def test_stretches_decode_alone():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 50, 60_000).astype(np.uint32)
    table = rans.Table.of_counts(np.arange(50), np.bincount(block))
    parsed = [rans.read(rans.encode([block], table)[0])]
    span = rans.CHECKPOINT * rans.LANES
    for k in (3, 0, 2):
        assert np.array_equal(rans.decode_stretches(parsed, [(0, k)], table)[0], block[k * span:(k + 1) * span])


def test_damage_is_found():
    block = np.arange(5000, dtype=np.uint32) % 7
    table = rans.Table.of_counts(np.arange(7), np.ones(7))
    good = rans.encode([block], table)[0]
    for i in (0, 5, 20, 30, len(good) // 2, len(good) - 1):
        bad = bytearray(good)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            rans.decode([bytes(bad)], table)
