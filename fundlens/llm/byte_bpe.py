"""Byte-level BPE encoding and decoding with recursive SQL inside each task.

A task splits its texts into pre-tokens, which are its words. Words that are vocabulary
entries are one token. The others, each distinct one once while it stays in a bounded memory,
become token-position rows in a private in-memory DuckDB: a recursive query joins neighbouring
tokens with the merge table, contracts the leftmost pair of least rank in every word, and ends
when no word has a pair left. Decoding joins ids with the vocabulary and concatenates the bytes
by an aggregation in position order.
"""

from __future__ import annotations

import base64
import heapq
from hashlib import md5, sha256
from itertools import islice, pairwise
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fundlens.llm.common import bounded_batches, forget_kept, give_back, per_worker, pick, tidy
from fundlens.llm.pretokens import split
from fundlens.llm.runs import slices

# Words read together, words per recursive query, rows of all its rounds at most (a word of n
# bytes has up to n * n), tokens per decoding query, and words a worker remembers.
WORDS_PER_CHUNK = 200_000
WORDS_PER_QUERY = 20_000
ROWS_PER_QUERY = 2_000_000
TOKENS_PER_QUERY = 500_000
MAX_REMEMBERED = 600_000
# Bytes of text encoded, digested and decoded together.
BYTES_AT_ONCE = 4 << 20
# Longer words (bytes) are merged with a heap: the recursion contracts one pair per round, so
# its rows grow with the square of a word's length. Both give the same tokens.
MAX_RECURSIVE_BYTES = 400
MAX_REMEMBERED_CHARS = 64

MERGE_SQL = """
WITH RECURSIVE step AS (
  SELECT word, pos, token, lead(token) OVER w AS next, lag(pos) OVER w AS before, 0 AS depth
  FROM start WINDOW w AS (PARTITION BY word ORDER BY pos)
  UNION ALL
  SELECT word, pos, token, lead(token) OVER w, lag(pos) OVER w, depth FROM (
    SELECT s.word, s.pos, depth + 1 AS depth,
           CASE WHEN s.pos = best & 1023 THEN (best >> 10)::INT ELSE token END AS token
    FROM step s JOIN (
      SELECT word, min(merged::BIGINT << 10 | pos) AS best
      FROM step JOIN merges ON pair = (token::BIGINT << 32 | next) GROUP BY word) b ON s.word = b.word
    WHERE before IS NULL OR before <> best & 1023)
  WINDOW w AS (PARTITION BY word ORDER BY pos)
)
SELECT word, token FROM step JOIN (SELECT word, max(depth) AS depth FROM step GROUP BY word)
USING (word, depth) ORDER BY word, pos
"""

DECODE_SQL = """
SELECT doc, string_agg(hex, '' ORDER BY pos) AS hex
FROM tokens JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank, which is its id, per line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All (left id, right id) whose bytes together are a token, and that token's id."""
    pairs, merged = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs.append(left << 32 | right)
                merged.append(rank)
    return np.array(pairs, np.int64), np.array(merged, np.int32)


def merge_with_heap(tokens: list[int], merges: dict[int, int]) -> list[int]:
    """The tokens of one long word: its leftmost least pair first, in n log n steps."""
    n = len(tokens)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            rank = merges.get(tokens[i] << 32 | tokens[after[i]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, tokens[i], tokens[after[i]]))

    for i in range(n):
        offer(i)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or tokens[i] != left or tokens[j] != right:
            continue  # a neighbour has merged since
        tokens[i], alive[j], after[i] = rank, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [t for t, a in zip(tokens, alive) if a]


class Codec:
    def __init__(self, ranks: dict[bytes, int], pairs: np.ndarray, merged: np.ndarray):
        self.ranks, self.pairs, self.merged = ranks, pairs, merged
        self.ids = np.array(list(ranks.values()), np.int32)
        self.bytes_to_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.names = np.array([str(i) for i in range(max(ranks.values()) + 1)], object)
        self.known: dict[str, bytes] = {}
        self.merges: dict[int, int] | None = None
        self.con = duckdb.connect(":memory:", config={
            "threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.put("merges", pair=pairs, merged=merged)
        self.put("vocabulary", id=self.ids, hex=[t.hex() for t in ranks])

    def put(self, name: str, **columns) -> None:
        self.con.register("incoming", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word, by the recursive query."""
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        joined = np.frombuffer(b"".join(words), np.uint8)
        self.put("start", word=np.repeat(np.arange(len(words), dtype=np.int32), sizes),
                 pos=(np.arange(len(joined)) - np.repeat(starts, sizes)).astype(np.int32),
                 token=self.bytes_to_id[joined])
        got = self.con.execute(MERGE_SQL).fetchnumpy()
        cuts = 4 * np.searchsorted(got["word"], np.arange(len(words) + 1))
        packed = np.asarray(got["token"], np.int32).tobytes()
        return [packed[a:b] for a, b in pairwise(cuts.tolist())]

    def merge_long(self, word: bytes) -> np.ndarray:
        if self.merges is None:
            self.merges = dict(zip(self.pairs.tolist(), self.merged.tolist()))
        tokens = self.bytes_to_id[np.frombuffer(word, np.uint8)].tolist()
        return np.array(merge_with_heap(tokens, self.merges), np.int32)

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of new words."""
        found, rest = {}, []
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                found[word] = np.int32(rank).tobytes()
            elif len(raw) > MAX_RECURSIVE_BYTES:
                found[word] = self.merge_long(raw).tobytes()
            else:
                rest.append((word, raw))
        for block in self.blocks(rest):
            found.update(zip((word for word, _ in block), self.merge([raw for _, raw in block])))
        return found

    @staticmethod
    def blocks(words: list[tuple[str, bytes]]):
        """Words that one recursive query can take within its rows."""
        rows = first = 0
        for i, (_, raw) in enumerate(words):
            rows += len(raw) ** 2
            if i > first and (rows > ROWS_PER_QUERY or i - first >= WORDS_PER_QUERY):
                yield words[first:i]
                rows, first = len(raw) ** 2, i
        if first < len(words):
            yield words[first:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the new words of a bounded number of words are merged together."""
        parts: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        n = 0
        for i, text in enumerate(texts):
            words = iter(split(text))
            while block := list(islice(words, WORDS_PER_CHUNK)):
                waiting.append((i, block))
                n += len(block)
                if n >= WORDS_PER_CHUNK:
                    self.pack(waiting, parts)
                    waiting, n = [], 0
        self.pack(waiting, parts)
        return [np.frombuffer(b"".join(p), np.int32) for p in parts]

    def pack(self, waiting: list[tuple[int, list[str]]], parts: list[list[bytes]]) -> None:
        if len(self.known) > MAX_REMEMBERED:
            self.known.clear()
        new = {w for _, words in waiting for w in words if w not in self.known}
        self.known.update(self.learn(new))
        for i, words in waiting:
            parts[i].append(b"".join(map(self.known.__getitem__, words)))
        for word in new:
            if len(word) > MAX_REMEMBERED_CHARS:
                del self.known[word]

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        pieces = [(i, ids[k:k + TOKENS_PER_QUERY])
                  for i, ids in enumerate(texts) for k in range(0, len(ids), TOKENS_PER_QUERY)]
        out: list[list[bytes]] = [[] for _ in texts]
        while pieces:
            n = count = 0
            while n < len(pieces) and (n == 0 or count + len(pieces[n][1]) <= TOKENS_PER_QUERY):
                count += len(pieces[n][1])
                n += 1
            block, pieces = pieces[:n], pieces[n:]
            ids = np.concatenate([p for _, p in block])
            if not np.isin(ids, self.ids).all():
                raise ValueError("an id is not in the vocabulary")
            sizes = [len(p) for _, p in block]
            self.put("tokens", doc=np.repeat(np.arange(n, dtype=np.int32), sizes),
                     pos=np.arange(len(ids), dtype=np.int64), id=ids)
            for doc, text in sorted(self.con.execute(DECODE_SQL).fetchall()):
                out[block[doc][0]].append(bytes.fromhex(text))
        return [b"".join(p) for p in out]


def _codec(spark, path: str):
    """A function that gives the worker's codec for a rank file, which the driver reads."""
    bounded_batches(spark)
    ranks = read_ranks(path)
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks a single byte")
    sent = spark.sparkContext.broadcast((ranks, *merge_pairs(ranks)))  # bounded by the vocabulary
    key = md5(Path(path).read_bytes()).hexdigest()

    def build():
        forget_kept()
        return Codec(*sent.value)

    return lambda: per_worker(("byte_bpe", key), build)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t if t is not None else "" for t in batch.column("text").to_pylist()]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*ids, np.empty(0, np.int32)]), pa.int32()))


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values if x.is_valid else [], np.int32) for x in column]


def encode(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ids (array<int>), one row per input row.

    A null or empty text has no ids. Repeated rows and ids, null ids too, are encoded row by
    row; an empty table gives no rows; other columns are dropped. Texts are read whole at any
    length, without a shuffle. Strings of special tokens are ordinary text.
    """
    codec, rows = _codec(df.sparkSession, path), pick(df, doc_id=id_column, text=text_column)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(codec().encode(_texts(batch)))], ["doc_id", "ids"])

    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """doc_id and bytes (binary), one row per input row; null or no ids give no bytes.

    An id outside the vocabulary is an error. Repeated rows and ids are decoded row by row; an
    empty table gives no rows; other columns are dropped.
    """
    codec, rows = _codec(df.sparkSession, path), pick(df, doc_id=id_column, ids=ids_column)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codec().decode(_ids(batch.column("ids"))), pa.binary())],
                ["doc_id", "bytes"])

    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary")


def digested(codec: Codec, batches):
    """Digests of pieces of the batches (doc_id, text); what a piece took is given back before the next."""
    for batch in (part for batch in batches for part in slices(batch, BYTES_AT_ONCE)):
        ids = codec.encode(_texts(batch))
        out = pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array([len(i) for i in ids], pa.int64()),
            pa.array([sha256(",".join(codec.names[i]).encode()).hexdigest() for i in ids]),
            pa.array([sha256(b).hexdigest() for b in codec.decode(ids)]),
        ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        del ids
        give_back()
        yield out


def round_trip(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256.

    Encodes like `encode` and decodes the ids like `decode`, in one pass over the texts. A null or
    empty text has no ids and the digests of nothing; repeated rows and ids are rows like
    others; an empty table gives no rows; other columns are dropped.
    """
    codec, rows = _codec(df.sparkSession, path), pick(df, doc_id=id_column, text=text_column)

    def run(batches):
        yield from digested(codec(), batches)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
