"""Token counts and byte-level BPE against the public libraries."""

import hashlib
import random

import pytest
import tiktoken
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

from fundlens.llm import byte_bpe, token_counts

JSON, RANKS = path("byte_bpe_50k.json"), path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def counts(df):
    return sorted(tuple(r) for r in token_counts.count_tokens(df, JSON).na.fill({"doc_id": -1}).collect())


def expected_counts(rows, library):
    out = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        out.append((-1 if doc_id is None else doc_id, len((text or "").encode()), n, n > 512))
    return sorted(out)


def first_two(df):
    return [(r[0], r[1]) for r in df.collect()]


def test_counts_equal_the_library(documents, odd_documents, library):
    for df in (documents, odd_documents, odd_documents.limit(0)):
        assert counts(df) == expected_counts(first_two(df), library)


def test_disputed_characters_go_to_the_library(library):
    spec = open(JSON).read()
    counter = token_counts.Counter(spec, *token_counts._proofs(spec))
    disputed = "".join(map(chr, token_counts._proofs(spec)[1])) + chr(0xE0001) + chr(0x100000)
    rng = random.Random(1)
    pool = disputed[::97] + "ab 1.\n'sé中 "
    for _ in range(300):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), ascii(text)


def test_counts_with_a_small_memory(library, monkeypatch, documents):
    monkeypatch.setattr(token_counts, "MAX_REMEMBERED", 3)
    counter = token_counts.Counter(open(JSON).read(), token_counts.whole_tokens(library), [0x558])
    for (text,) in documents.select("text").limit(20).collect():
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_other_kinds_of_tokenizers_are_refused(documents):
    with pytest.raises(ValueError):
        token_counts.count_tokens(documents, path("word_bpe_49k.json"))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_round_trip_equals_the_library(documents, odd_documents, tik):
    for df in (documents, odd_documents, odd_documents.limit(0)):
        got = sorted(tuple(r) for r in byte_bpe.round_trip(df, RANKS).na.fill({"doc_id": -1}).collect())
        want = []
        for doc_id, text in first_two(df):
            ids = tik.encode_ordinary(text or "")
            want.append((-1 if doc_id is None else doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
        assert got == sorted(want)


def test_encode_then_decode_gives_the_text(documents, tik):
    encoded = byte_bpe.encode(documents, RANKS)
    texts = dict(first_two(documents))
    rows = encoded.collect()
    assert all(list(r.ids) == tik.encode_ordinary(texts[r.doc_id]) for r in rows)
    assert {r.doc_id: bytes(r.bytes).decode() for r in byte_bpe.decode(encoded, RANKS).collect()} == texts


def codec():
    ranks = byte_bpe.read_ranks(RANKS)
    return byte_bpe.Codec(ranks, *byte_bpe.merge_pairs(ranks))


def test_recursion_and_heap_agree_with_the_library(tik):
    c, rng = codec(), random.Random(2)
    words = ["".join(rng.choice(a) for _ in range(rng.randrange(1, 60)))
             for a in ("ab", "eatnhis", "áéñü", "!#%.", "中文字") for _ in range(60)]
    for word, packed in zip(words, c.merge([w.encode() for w in words])):
        ids = tik._encode_single_piece(word)
        if word.encode() not in c.ranks:
            assert list(memoryview(packed).cast("i")) == ids
            assert c.merge_long(word.encode()).tolist() == ids


@pytest.mark.parametrize("count,length", [(600, 390), (20_000, 70), (2_000, 400), (1, 100_000)])
def test_many_long_words_stay_within_memory(tik, count, length):
    rng = random.Random(count)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=length)) for _ in range(count))
    c = codec()
    (ids,) = c.encode([text])
    assert ids.tolist() == tik.encode_ordinary(text)
    assert c.decode([ids]) == [text.encode()]


def test_decode_refuses_unknown_ids():
    with pytest.raises(ValueError):
        codec().decode([byte_bpe.np.array([10**6], "i4")])


def test_decode_in_pieces(monkeypatch):
    c = codec()
    monkeypatch.setattr(byte_bpe, "TOKENS_PER_QUERY", 7)
    texts = ["", "the quick brown fox jumps over the lazy dog again and again", "a", "one two three four"]
    assert [b.decode() for b in c.decode(c.encode(texts))] == texts
