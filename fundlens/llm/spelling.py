"""Spelling variants: words one edit apart, found on sorted lists.

The vocabulary is sorted twice, by its words and by their reversals, and cut into blocks of
bounded size. Words one edit apart share their first half or, reversed, the other half, so a
word meets only the blocks that its half reaches into, and of those only blocks whose shared
prefix is within one edit. Inside a pair of blocks every word walks through its part of the
sorted list: rows of the edit matrix, three cells wide, are kept by depth and reused up to the
common prefix with the next word; when a row exceeds one edit, the walk skips all words that
share that prefix. All words of a block walk at the same time, as arrays.
"""

from __future__ import annotations

from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import pick, stored
from fundlens.llm.runs import LOWER, borders, coded, extents, flat, slices, text_of
from fundlens.session import materialize

# Fixed values of the contract.
FOLD = 31
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
# A block of a sorted list holds at most so many words, and closes beyond so many characters.
BLOCK_WORDS = 8192
BLOCK_CHARS = 1 << 20
# Block borders are told to all tasks, cut to so many characters.
BORDER = 64
TOP = b"\xff" * BORDER


def counted(ids: list, texts: pa.Array, fold: int, min_length: int) -> tuple[list[str], list[int]]:
    """Words of some texts and how often they occur; each text deletes by its own id."""
    data, offsets = flat(texts)
    data = LOWER[data]
    lead = data == 0xC3  # leads the two bytes of each of U+00C0 to U+00FF
    inside = lead | ((data >= 97) & (data <= 122))
    inside[1:] |= lead[:-1]
    starts, ends = extents(inside, borders(data, offsets))
    codes, distinct = coded(data, inside, starts, ends)
    if not len(codes):
        return [], []
    words = distinct.cast(pa.large_string())
    long = pc.greater_equal(pc.utf8_length(words), min_length).to_numpy(zero_copy_only=False)
    kept = long[codes]
    key, times = np.unique(text_of(starts[kept], offsets) * len(words) + codes[kept], return_counts=True)
    at, code = np.divmod(key, len(words))
    raw = distinct.to_pylist()
    prefix = [crc32(f"{'' if i is None else i}:".encode()) for i in ids]
    h = np.fromiter((crc32(raw[c], prefix[d]) for d, c in zip(at.tolist(), code.tolist())), np.int64, len(key))
    cut = h % fold == 0
    n = np.bincount(code[~cut], times[~cut], len(words)).astype(np.int64)
    some = np.flatnonzero(n)
    out, counts = words.take(pa.array(some)).to_pylist(), n[some].tolist()
    for c, k, x in zip(code[cut].tolist(), times[cut].tolist(), h[cut].tolist()):
        word = raw[c].decode()
        x %= len(word)
        if len(word) > min_length:
            out.append(word[:x] + word[x + 1:])
            counts.append(k)
    return out, counts


def vocabulary(df: DataFrame, fold: int = FOLD, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word and n: the words of all texts after the deletions, as often as min_count or more."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words, counts = counted(part.column("doc_id").to_pylist(), part.column("text"), fold, min_length)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    rows = pick(df, doc_id=id_column, text=text_column).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] equals b[:low], a[:high] does not equal b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def reaches(word: bytes, shared: bytes) -> bool:
    """Whether some word that begins with `shared` can be within one edit of `word`."""
    p = common_prefix(word, shared)
    rest = shared[p + 1:]
    return (p >= len(shared) - 1 or word[p + 1:p + 1 + len(rest)] == rest
            or word[p:p + len(rest)] == rest or word[p + 1:p + 2 + len(rest)] == shared[p:])


class SortedList:
    """Sorted words as flat bytes, with the common prefix of each with the one before it."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.at = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.lcp = np.array([0] + [common_prefix(a, b) for a, b in zip(words, words[1:])], np.int64)
        self.least = [self.lcp]  # least[k][i]: the least lcp of i .. i + 2**k - 1
        while 2 << (len(self.least) - 1) <= len(words):
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    def skip(self, i: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first word after each i that does not share its prefix of that depth."""
        i = i + 1
        for k in range(len(self.least) - 1, -1, -1):
            least = self.least[k]
            fits = i < len(least)
            fits[fits] = least[i[fits]] >= depth[fits]
            i = i + (fits.astype(np.int64) << k)
        return i

    def range(self, prefix: bytes) -> tuple[int, int]:
        """Where the words that begin with prefix are."""
        low = bisect_left(self.words, prefix)
        after = prefix.rstrip(b"\xff")  # the least string behind all that begin with prefix
        high = bisect_left(self.words, after[:-1] + bytes([after[-1] + 1]), low) if after else len(self.words)
        return low, high


def one_edit(queries: list[bytes], halves: list[int], listed: SortedList) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word of the list) exactly one edit apart that share the query's half.

    rows[q, depth] is the row of query q's edit matrix after `depth` characters of the walk's
    current word: the cells of the query's first depth - 1, depth and depth + 1 characters,
    with 2 for all above one edit.
    """
    sizes = np.array([len(q) for q in queries], np.int64)
    # padding before and behind each query that equals no character
    data = np.zeros(int(sizes.sum()) + 5 * len(queries), np.uint8)
    at = np.cumsum(sizes + 5) - sizes - 3
    for q, a in zip(queries, at.tolist()):
        data[a:a + len(q)] = np.frombuffer(q, np.uint8)
    rows = np.full((len(data), 3), 2, np.uint8)
    low, high = (np.array(x, np.int64) for x in zip(*(listed.range(q[:h]) for q, h in zip(queries, halves))))
    depth = np.array(halves, np.int64)
    rows[at + depth] = (1, 0, 1)
    word = low.copy()
    active = np.flatnonzero(low < high)
    found_q, found_w = [], []
    while len(active):
        w, d, base = word[active], depth[active], at[active]
        ended = d == listed.sizes[w]
        # words that ended: is the last cell one edit?
        q, i = active[ended], w[ended]
        over = sizes[q] - listed.sizes[i] + 1
        near = (over >= 0) & (over <= 2)
        near[near] = rows[at[q[near]] + d[ended][near], over[near]] == 1
        found_q.append(q[near])
        found_w.append(i[near])
        # the others: one row deeper
        q, i, k, base = active[~ended], w[~ended], d[~ended], base[~ended]
        c = listed.data[listed.at[i] + k]
        before, row, room = rows[base + k], base + k, sizes[q] - k
        first = np.minimum(before[:, 0] + (data[row - 1] != c), before[:, 1] + 1)
        first[room < 0] = 2
        second = np.minimum(np.minimum(before[:, 1] + (data[row] != c), before[:, 2] + 1), first + 1)
        second[room < 1] = 2
        third = np.minimum(before[:, 2] + (data[row + 1] != c), second + 1)
        third[room < 2] = 2
        new = np.minimum(np.stack([first, second, third], 1), 2).astype(np.uint8)
        alive = new.min(1) < 2
        rows[row[alive] + 1] = new[alive]
        depth[q[alive]] = k[alive] + 1
        # on to the next word: behind the ended one, or behind all that share the dead prefix
        moved = np.concatenate([active[ended], q[~alive]])
        to = np.concatenate([w[ended] + 1, listed.skip(i[~alive], k[~alive] + 1)])
        word[moved] = to
        going = to < high[moved]
        depth[moved[going]] = listed.lcp[to[going]]
        active = np.concatenate([q[alive], moved[going]])
    return np.concatenate([*found_q, np.empty(0, np.int64)]), np.concatenate([*found_w, np.empty(0, np.int64)])


def half(size: int, reverse: bool) -> int:
    """Characters that a word shares with its near words: the first half of a word of that
    size, or the other half, counted from the end. One edit leaves one of the two whole."""
    return (size + 1) // 2 if reverse else size // 2


def sorted_blocks(words: DataFrame, reverse: bool) -> DataFrame:
    """block, key, n: the words (reversed) in order, each block a stretch of bounded size."""

    def cut(batches):
        from pyspark import TaskContext

        block, held, chars = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            blocks = []
            for size in pc.utf8_length(batch.column("key")).to_pylist():
                if held >= BLOCK_WORDS or chars >= BLOCK_CHARS:
                    block, held, chars = block + 1, 0, 0
                held, chars = held + 1, chars + size
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *batch.columns], ["block", "key", "n"])

    key = F.reverse("word") if reverse else F.col("word")
    return stored(words.select(key.alias("key"), "n").orderBy("key").mapInArrow(cut, "block long, key string, n long"), "blocks")


def routed(blocks: DataFrame, reverse: bool) -> DataFrame:
    """block, of, key: each word (of block `of`) with each block that may hold near words."""
    ends = blocks.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    cut = lambda c: F.encode(F.substring(c, 1, BORDER), "ISO-8859-1")
    # one short row per block of 8,192 words
    table = ends.select("block", cut("first").alias("first"), cut("last").alias("last")).orderBy("block").toArrow()
    numbers = table["block"].to_numpy()
    firsts, lasts = table["first"].to_pylist(), table["last"].to_pylist()
    shared = [a[:common_prefix(a, b)] for a, b in zip(firsts, lasts)]
    sent = blocks.sparkSession.sparkContext.broadcast((numbers, firsts, lasts, shared))

    def run(batches):
        numbers, firsts, lasts, shared = sent.value
        for batch in batches:
            to, rows = [], []
            for row, key in enumerate(batch.column("key").to_pylist()):
                word = key.encode("latin-1")
                prefix = word[:half(len(word), reverse)][:BORDER]
                i, end = bisect_left(lasts, prefix), (prefix + TOP)[:BORDER]
                while i < len(firsts) and firsts[i] <= end:
                    if reaches(word, shared[i]):
                        to.append(numbers[i])
                        rows.append(row)
                    i += 1
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int64()), batch.column("block").take(rows), batch.column("key").take(rows)], ["block", "of", "key"])

    return blocks.mapInArrow(run, "block long, of long, key string")


def near_words(words: DataFrame, reverse: bool) -> DataFrame:
    """word, n_near, best: how many near words share the word's half, and the best of them."""
    blocks = sorted_blocks(words, reverse)
    queries = materialize(routed(blocks, reverse))
    wanted = blocks.join(queries.select("block", F.col("of").alias("query_block")).distinct(), "block")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        queries = sorted(k.encode("latin-1") for k in left["key"].to_pylist())
        pairs = sorted((k.encode("latin-1"), n) for k, n in zip(right["key"].to_pylist(), right["n"].to_pylist()))
        best: dict[bytes, tuple] = {}
        if queries and pairs:
            halves = [half(len(q), reverse) for q in queries]
            for q, i in zip(*(x.tolist() for x in one_edit(queries, halves, SortedList([k for k, _ in pairs])))):
                query, (word, n) = queries[q], pairs[i]
                if reverse:
                    query, word = query[::-1], word[::-1]
                    h = half(len(query), False)
                    if query[:h] == word[:h]:
                        continue  # found on the list of words
                count, m, other = best.get(query, (0, -1, b""))
                best[query] = (count + 1, n, word) if (-n, word) < (-m, other) else (count + 1, m, other)
        found = list(best.items())
        return pa.table({
            "word": pa.array([w.decode("latin-1") for w, _ in found], pa.string()),
            "n_near": pa.array([b[0] for _, b in found], pa.int64()),
            "m": pa.array([-b[1] for _, b in found], pa.int64()),
            "near": pa.array([b[2].decode("latin-1") for _, b in found], pa.string())})

    return queries.groupBy("block", "of").cogroup(wanted.groupBy("block", "query_block")).applyInArrow(
        search, "word string, n_near long, m long, near string")


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last of the forms that lead on from each word with a form.

    Each step doubles the forms followed. A form is at least ten times as frequent as its
    word, so chains are short and end.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(now.join(ahead, "root", "left").select("word", "root", "further"))
        if not step.where(F.col("further").isNotNull()).take(1):
            return now
        now = step.select("word", F.coalesce("further", "root").alias("root"))


def group(df: DataFrame, ratio: int = RATIO, fold: int = FOLD, min_length: int = MIN_LENGTH,
          min_count: int = MIN_COUNT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per distinct word.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; the id and the word
    decide which texts spell it without one of its characters. A null text has no words, a null
    id counts as empty text, repeated rows count row by row. Words with fewer than min_length
    characters or min_count occurrences are left out. An empty table gives no rows; other
    columns are dropped. Texts are read whole at any length, and only words are shuffled. Ties
    between forms go to the smallest word.
    """
    words = stored(vocabulary(df, fold, min_length, min_count, id_column, text_column), "vocabulary")
    pairs = near_words(words, False).unionByName(near_words(words, True))
    near = pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("m", "near")).alias("best"))
    form_n = -F.col("best.m")
    has_form = form_n >= ratio * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, form_n).alias("form_n")), "forms")
    last = roots(found.where(F.col("form").isNotNull()))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
