"""Token counts by the whole-token shortcut.

Most pre-tokens of real text are themselves vocabulary entries. Before the job starts the
driver proves, with the tokenizer itself, which vocabulary strings are one pre-token and
encode alone as exactly one token. Tasks count those by a dictionary hit; only the rest are
merged, each distinct one once while it stays in a bounded memory.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from hashlib import md5
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundlens.llm.common import per_worker, pick
from fundlens.llm.pretokens import FULL, byte_alphabet, is_latin1, split

# Merged pre-tokens a worker remembers, and the longest one it remembers.
MAX_REMEMBERED = 400_000
MAX_REMEMBERED_CHARS = 64
# Code points that are compared (above them only private and unassigned ones follow), per probe.
PROBED = 0x40000
PROBE = 64


def whole_tokens(tokenizer: Tokenizer) -> list[str]:
    """Vocabulary strings proven to be one pre-token that encodes alone as one token."""
    alphabet = byte_alphabet()
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    texts = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if entry in added or any(c not in alphabet for c in entry):
            continue
        try:
            text = bytes(alphabet[c] for c in entry).decode()
        except UnicodeDecodeError:  # part of a character
            continue
        if FULL.findall(text) == [text] and not any(a in text for a in added):
            texts.append(text)
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, encoded) if len(e.ids) == 1]


def disputed_points(tokenizer: Tokenizer) -> list[int]:
    """Code points that the tokenizer's own splitter and `split` see differently.

    The two carry different editions of the Unicode tables. A text that holds such a
    character, or one from PROBED on, is left to the tokenizer as a whole.
    """
    def probe(points):
        return "".join(f"a{c}1{c} {c}." for c in map(chr, points))

    def differs(points) -> bool:
        text = probe(points)
        spans = [m.span() for m in FULL.finditer(text)]
        return spans != [s for _, s in tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    found: list[int] = []
    for start in range(0, PROBED, PROBE):
        block = [p for p in range(start, start + PROBE) if not 0xD800 <= p < 0xE000]
        if block and differs(block):
            found += [p for p in block if differs([p])]
    return found


class Lengths(dict):
    """Pre-token -> number of tokens. Starts with the whole tokens; merges and remembers others."""

    def __init__(self, tokenizer: Tokenizer, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.whole = tokenizer, whole

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= MAX_REMEMBERED_CHARS:
            if len(self) >= len(self.whole) + MAX_REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n


class Counter:
    def __init__(self, spec: str, whole: list[str], disputed: list[int]):
        self.tokenizer = Tokenizer.from_str(spec)
        self.lengths = Lengths(self.tokenizer, whole)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.disputed = re.compile(f"[{''.join(map(chr, disputed))}{chr(PROBED)}-\U0010ffff]")

    def count(self, text: str) -> int:
        if not is_latin1(text) and self.disputed.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        length = self.lengths.__getitem__
        if self.added is None:
            return sum(map(length, split(text)))
        parts = self.added.split(text)  # an added token inside a text is one token
        return len(parts) - 1 + sum(sum(map(length, split(p))) for p in parts)


def check_supported(spec: str) -> None:
    """The shortcut holds for byte-level BPE without normaliser, prefix space or word ends."""
    parsed = json.loads(spec)
    model, pre = parsed["model"], parsed["pre_tokenizer"] or {}
    plain = all(not t.get(k) for t in parsed["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized"))
    if not (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex")
            and not pre.get("add_prefix_space") and not parsed["normalizer"] and plain):
        raise ValueError("only plain byte-level BPE tokenizers are supported")


@lru_cache(maxsize=2)
def _proofs(spec: str) -> tuple[list[str], list[int]]:
    tokenizer = Tokenizer.from_str(spec)
    return whole_tokens(tokenizer), disputed_points(tokenizer)


def count_tokens(df: DataFrame, tokenizer_path: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), one row per input row.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and ids, null ids too, are
    counted row by row; an empty table gives no rows; other columns are dropped. Texts are
    read whole at any length, without a shuffle. Strings of added tokens inside a text count
    as that token, the library's default.
    """
    spec = Path(tokenizer_path).read_text()
    check_supported(spec)
    key = md5(spec.encode()).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast((spec, *_proofs(spec)))  # bounded by the vocabulary

    def run(batches):
        counter = per_worker(("token_counts", key), lambda: Counter(*sent.value))
        for batch in batches:
            texts = batch.column("text")
            n_tokens = [counter.count(t.as_py()) if t.is_valid else 0 for t in texts]
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = pick(df, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
