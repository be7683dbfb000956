"""Token ids of texts, for a byte-level BPE tokenizer with word ends over lower-cased words.

A text of Latin-1 characters is cut into words by array operations on its bytes; the tokenizer's
model merges each distinct word once. Other texts, and texts that hold a special token's string, are
encoded by the tokenizer as they are.
"""

from __future__ import annotations

import json
import os
import unicodedata
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from fundlens.llm.pretokens import byte_alphabet
from fundlens.llm.runs import borders, coded, extents, flat

# Words a worker remembers, and the longest (in bytes).
MAX_REMEMBERED = 400_000
MAX_REMEMBERED_BYTES = 64
# New words that the tokenizer gets at once.
WORDS_TOGETHER = 4096

SPACE, LETTER, DIGIT, OTHER = range(4)
# The word pattern that the array operations below follow.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


def _kind(c: str) -> int:
    if c in "\t\n\v\f\r \x85\xa0":
        return SPACE
    return {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], OTHER)


ONE = np.array([_kind(chr(i)) for i in range(128)] + [OTHER] * 128, np.uint8)
TWO = np.array([_kind(chr(i)) for i in range(128, 256)], np.uint8)  # U+0080 to U+00FF
LOWER_ONE = np.array([ord(chr(i).lower()) for i in range(128)] + list(range(128, 256)), np.uint8)


def check_supported(spec: str) -> None:
    parsed = json.loads(spec)
    cleaning = parsed["normalizer"]["normalizers"] if parsed["normalizer"] else []
    steps = [step["type"] for step in cleaning]
    split, byte_level = parsed["pre_tokenizer"]["pretokenizers"]
    if not (steps == ["NFC", "Replace", "Lowercase"] and cleaning[1]["content"] == " " and split["pattern"]["Regex"] == WORDS
            and split["invert"] and not byte_level["add_prefix_space"] and parsed["model"]["type"] == "BPE"
            and parsed["model"]["end_of_word_suffix"] and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parsed["added_tokens"])):
        raise ValueError("only lower-casing BPE tokenizers with this word pattern are supported")


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, which of them are in words, and the words' starts and ends.

    data: UTF-8 of texts without characters beyond U+00FF.
    """
    lead = np.flatnonzero(data >= 0xC2)
    kind, lower = ONE[data], LOWER_ONE[data]
    if len(lead):
        wide = TWO[((data[lead] & 1) << 6) | (data[lead + 1] & 0x3F)]
        kind[lead] = kind[lead + 1] = wide
        upper = lead[(data[lead] == 0xC3) & (data[lead + 1] <= 0x9E) & (data[lead + 1] != 0x97)]
        lower[upper + 1] += 32
    first = borders(data, offsets)
    begins = first.copy()  # words begin at texts, where the kind changes, and at each digit
    begins[1:] |= kind[1:] != kind[:-1]
    digit = kind == DIGIT
    digit[lead + 1] = False
    begins |= digit
    quote = np.flatnonzero((lower == 0x27) & begins)
    size = len(data)
    at = lambda k: np.minimum(quote + k, size - 1)
    same = quote + 1 < size
    same &= ~first[at(1)]
    same2 = same & (quote + 2 < size)
    same2 &= ~first[at(2)]
    for ending in ENDINGS:
        is_it = same & (lower[at(1)] == ord(ending[0]))
        if len(ending) == 2:
            is_it &= same2 & (lower[at(2)] == ord(ending[1]))
        q = quote[is_it]
        begins[q + 1] = False
        after = q + 1 + len(ending)
        begins[after[after < size]] = True
    inside = kind != SPACE
    return lower, inside, *extents(inside, begins)


class Encoder:
    def __init__(self, spec: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        check_supported(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.end_id = end_id
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        # the same model without the steps before it: words come cut and lower-cased
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = WhitespaceSplit()
        self.alphabet = {byte: c for c, byte in byte_alphabet().items() if byte != 0x20}
        suffix = json.loads(spec)["model"]["end_of_word_suffix"]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True

    def library(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def by_word(self, distinct: list[bytes]) -> list[bytes]:
        """Packed ids of each word."""
        if len(self.known) > MAX_REMEMBERED:
            self.known.clear()
        out = list(map(self.known.get, distinct))
        new = [i for i, ids in enumerate(out) if ids is None]
        for k in range(0, len(new), WORDS_TOGETHER):
            part = new[k:k + WORDS_TOGETHER]
            for i, ids in zip(part, self.joined([distinct[i] for i in part])):
                out[i] = ids
        self.known.update((distinct[i], out[i]) for i in new if len(distinct[i]) <= MAX_REMEMBERED_BYTES)
        return out

    def joined(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words that the merging model gets as one text, its bytes in the model's
        alphabet: a word's last id, and no other, is that of a token with a word end."""
        text = b" ".join(words).decode("latin-1").translate(self.alphabet)
        ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
        if len(ends) != len(words) or ends[-1] != 4 * len(ids):
            return [i.tobytes() for i in self.library([w.decode() for w in words])]
        packed = ids.tobytes()
        return [packed[a:b] for a, b in pairwise([0, *ends.tolist()])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids (uint32) of each text, with the end id behind; nulls are empty texts."""
        texts = pc.fill_null(texts, "")
        data, offsets = flat(texts)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(offsets, np.flatnonzero(data >= 0xC4), side="right") - 1] = True
        for special in self.special:
            odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        simple = np.flatnonzero(~odd)
        out: list = [None] * len(texts)
        if odd.any():
            data, offsets = flat(texts.take(pa.array(simple)))
            for i, ids in zip(np.flatnonzero(odd), self.library(texts.filter(pa.array(odd)).to_pylist())):
                out[i] = np.append(ids, np.uint32(self.end_id))
        lower, inside, starts, ends = words(data, offsets)
        codes, distinct = coded(lower, inside, starts, ends)
        packed = self.by_word(distinct.to_pylist())
        sizes = np.array([len(p) >> 2 for p in packed], np.int64)
        begin = np.cumsum(sizes) - sizes
        joined = np.frombuffer(b"".join(packed), np.uint32)
        many = sizes[codes]
        place = np.cumsum(many) - many
        ids = np.empty(int(many.sum()), np.uint32)
        at = np.flatnonzero(many)
        for k in range(int(many.max(initial=0))):  # the k-th id of all words that have one
            at = at[many[at] > k]
            if len(at) < 64:
                for w in at.tolist():
                    ids[place[w] + k:place[w] + many[w]] = joined[begin[codes[w]] + k:begin[codes[w]] + many[w]]
                break
            ids[place[at] + k] = joined[begin[codes[at]] + k]
        # words per text, then ids per text
        last = np.searchsorted(starts, offsets[1:])
        per_text = np.diff(np.append(0, np.append(0, np.cumsum(many))[last]))
        with_end = np.full(len(ids) + len(per_text), self.end_id, np.uint32)
        stop = np.cumsum(per_text + 1)
        mask = np.ones(len(with_end), bool)
        mask[stop - 1] = False
        with_end[mask] = ids
        for i, a, b in zip(simple.tolist(), (stop - per_text - 1).tolist(), stop.tolist()):
            out[i] = with_end[a:b]
        return out
