"""Phrase collocations from count streams in prefix and suffix order.

Counting never needs a table of all phrases. A phrase occurs as often as the least frequent part
of it allows, so words are counted first, then pairs of words, and then one record per place
where pairs that are frequent follow each other: the words from there on, five at most. Records
are sorted in prefix order, where all occurrences of a phrase stand together, and runs of equal
beginnings are counted on the way through. Filters between the passes are bitmaps of bounded
size that may let more pass, never less.

The counted phrases are then kept as two sorted streams, by their words and by their words
reversed. Left parts and right extensions of a phrase are its neighbours in the first, right
parts and left extensions its neighbours in the second; merge joins walk both in step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import pick, stored
from fundlens.llm.runs import LOWER, borders, coded, extents, flat, slices, text_of

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
UNKNOWN = "und"
BYTES_AT_ONCE = 16 << 20
# A bitmap has so many bits per member, and at most two to this power in all (32 MB).
BITS_PER_MEMBER = 32
MAX_BITS = 28

# Fixed values of the contract: bytes that end a word (1), and those that end a piece too (2).
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[list(b".,;:!?") + list(range(0x0A, 0x0E))] = 2

MIX = np.uint64(0x9E3779B97F4A7C15)
# A phrase is five numbers of words, zeros behind its last one, in either order.
PHRASE = [f"w{i}" for i in range(1, LONGEST + 1)]


class Words:
    """The words of some texts of one language, in order."""

    def __init__(self, lang: str, texts: pa.Array, seed: int):
        data, offsets = flat(texts)
        kind = KIND[data]
        inside = kind == 0
        first = borders(data, offsets)
        starts, ends = extents(inside, first)
        self.codes, self.distinct = coded(LOWER[data], inside, starts, ends)
        # a piece ends at some separators and with its text
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        text = text_of(starts, offsets)
        self.joined = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        name = f"{len(lang)}:{lang}".encode()
        # positive numbers: a phrase's zeros sort before all words
        self.numbers = np.fromiter(
            ((xxhash.xxh3_64_intdigest(name + w, seed) >> 1) or 1 for w in self.distinct.to_pylist()), np.int64, len(self.distinct))


def by_language(batch: pa.RecordBatch, seed: int):
    """The words of a batch's texts (lang and text), one language after another."""
    for part in slices(batch, BYTES_AT_ONCE):
        langs = part.column("lang")
        for lang in langs.unique().to_pylist():
            mine = pc.equal(langs, lang)
            yield lang, Words(lang, part.filter(mine).column("text"), seed)


def columns(arrays, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names)


def word_counts(rows: DataFrame, seed: int) -> DataFrame:
    """lang, word, w1 (the word's number), f: every distinct word."""

    def run(batches):
        for batch in batches:
            for lang, words in by_language(batch, seed):
                times = np.bincount(words.codes, minlength=len(words.distinct)).astype(np.int64)
                yield columns([pa.array([lang] * len(times), pa.string()), words.distinct.cast(pa.large_string()).cast(pa.string()),
                               words.numbers, times], ["lang", "word", "w1", "f"])

    found = rows.mapInArrow(run, "lang string, word string, w1 long, f long")
    return found.groupBy("lang", "word").agg(F.first("w1").alias("w1"), F.sum("f").alias("f"))


def numbered_words(rows: DataFrame) -> tuple[DataFrame, int]:
    """word_counts under the first seed that gives all words different numbers, and the seed."""
    seed = 0
    while True:
        words = stored(word_counts(rows, seed), "words")
        if not words.groupBy("w1").count().where("count > 1").take(1):
            return words, seed
        seed += 1


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """63-bit numbers of pairs of words."""
    h = (first.view(np.uint64) * MIX) ^ second.view(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * MIX
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(1)).view(np.int64)


def bitmap(members: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap over the leading bits of `member` (positive, 63 bits), and how far to shift.

    Built in parts of 32,768 bits by an aggregation; the driver holds at most 32 MB of it.
    """
    bits = min(MAX_BITS, max(15, (members.count() * BITS_PER_MEMBER).bit_length()))
    # positions count from one in the bitmap functions
    at = F.shiftright("member", 63 - bits) + 1
    parts = members.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).toArrow()
    out = np.zeros(1 << bits >> 3, np.uint8)
    for bucket, part in zip(parts["bucket"].to_pylist(), parts["bits"].to_pylist()):
        out[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(part, np.uint8)
    return out, 63 - bits


def within(numbers: np.ndarray, bits: np.ndarray, shift: int) -> np.ndarray:
    at = numbers >> shift
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def pair_counts(rows: DataFrame, often: DataFrame, seed: int, min_count: int) -> DataFrame:
    """w1, w2, f of all pairs of words that follow each other min_count times or more."""
    bits, shift = bitmap(often.select(F.col("w1").alias("member")))
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for _, words in by_language(batch, seed):
                fits = within(words.numbers, sent.value, shift)[words.codes]
                at = np.flatnonzero(words.joined & fits[1:] & fits[:-1])
                key, times = np.unique(words.codes[at] << 32 | words.codes[at + 1], return_counts=True)
                yield columns([words.numbers[key >> 32], words.numbers[key & 0xFFFFFFFF], times.astype(np.int64)], ["w1", "w2", "f"])

    found = rows.mapInArrow(run, "w1 long, w2 long, f long")
    return found.groupBy("w1", "w2").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def places(rows: DataFrame, pairs: DataFrame, seed: int, longest: int) -> DataFrame:
    """The words from each place on where two frequent pairs or more follow each other, up to
    `longest`, and f: how many of some texts' places have these."""

    def member(batch):
        for b in batch:
            yield columns([mixed(b.column("w1").to_numpy(), b.column("w2").to_numpy())], ["member"])

    bits, shift = bitmap(pairs.mapInArrow(member, "member long"))
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for _, words in by_language(batch, seed):
                number = words.numbers[words.codes]
                pair = words.joined & within(mixed(number[:-1], number[1:]), sent.value, shift) if len(number) else words.joined
                pair = np.append(pair, np.zeros(longest, bool))
                at = np.flatnonzero(pair[:-1] & pair[1:])
                follows = np.ones(len(at), bool)
                record = [words.codes[at] + 1]  # 0: no word
                for i in range(1, longest):
                    follows &= pair[at + i - 1]
                    record.append(np.where(follows, words.codes[np.minimum(at + i, len(number) - 1)] + 1, 0))
                order = np.lexsort(record[::-1])
                record = [r[order] for r in record]
                new = np.ones(len(at), bool)
                new[1:] = np.logical_or.reduce([r[1:] != r[:-1] for r in record])
                first = np.flatnonzero(new)
                numbers = np.append(0, words.numbers)
                yield columns([*(numbers[r[first]] for r in record), np.diff(np.append(first, len(at)))], [*names, "f"])

    names = PHRASE[:longest]
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "f"]))


def runs_of_prefixes(records: DataFrame, min_count: int, longest: int) -> DataFrame:
    """Phrases of three words and more with f, from records in prefix order.

    Each batch of the sorted stream passes on the runs it holds: those that touch its borders
    may go on in another batch, of the others only those that occur min_count times.
    """
    names = PHRASE[:longest]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            *words, f = (c.to_numpy() for c in batch.columns)
            changed = np.zeros(len(f), bool)
            changed[0] = True
            for k, word in enumerate(words):
                changed[1:] |= word[1:] != word[:-1]
                if k < 2:
                    continue
                first = np.flatnonzero(changed)
                times = np.add.reduceat(f, first)
                keep = times >= min_count
                keep[[0, -1]] = True
                keep &= word[first] != 0
                at = first[keep]
                none = np.zeros(len(at), np.int64)
                yield columns([*(w[at] if i <= k else none for i, w in enumerate(words)), times[keep]], [*names, "f"])

    order = records.repartitionByRange(*names).sortWithinPartitions(*names)
    found = order.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "f"]))
    return found.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def first_words(phrase: Column, n: Column, longest: int) -> list[Column]:
    """A phrase's first n numbers, zeros behind them."""
    return [F.when(n > i, phrase[i]).otherwise(F.lit(0).cast("long")) for i in range(longest)]


def in_step(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """A merge join of two streams in the order of the same columns."""
    return left.join(right.hint("merge"), names, how)


def scored(streams: DataFrame, longest: int) -> DataFrame:
    """Candidates (phrases of two words and more) with their least cut: forward, length, a, l, r, n, score.

    streams: forward and backward (arrays of numbers, zeros behind), length, f, n (the words of
    the language).
    """
    names = PHRASE[:longest]
    tuple_of = lambda column: [F.col(column)[i].alias(c) for i, c in enumerate(names)]
    prefix_order = streams.select(*tuple_of("forward"), F.col("f").alias("l"))
    suffix_order = streams.select(*tuple_of("backward"), F.col("f").alias("r"))
    cuts = streams.where(F.col("length") > 1).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    lefts = cuts.select("*", *(c.alias(n) for c, n in zip(first_words(F.col("forward"), F.col("k"), longest), names)))
    lefts = in_step(lefts, prefix_order, names).drop(*names)
    rights = lefts.select("*", *(c.alias(n) for c, n in zip(first_words(F.col("backward"), F.col("length") - F.col("k"), longest), names)))
    both = in_step(rights, suffix_order, names).drop(*names)
    score = F.expr("(1000bd * CAST(f AS DECIMAL(16,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least")
    return both.groupBy("forward", "backward", "length", "f", "n").agg(least).select(
        "forward", "backward", "length", F.col("f").alias("a"), "n", "least.l", "least.r", "least.score")


def not_contained(candidates: DataFrame, streams: DataFrame, longest: int) -> DataFrame:
    """Candidates that no longer phrase contains as often.

    A phrase that contains a candidate as often as it occurs contains an extension of it by one
    word as often, so the counts of the extensions to the right (neighbours in prefix order) and
    to the left (in suffix order) decide.
    """
    names = PHRASE[:longest]
    for column in ("forward", "backward"):
        extended = streams.where(F.col("length") > 2).select(
            *(c.alias(n) for c, n in zip(first_words(F.col(column), F.col("length") - 1, longest), names)), "f")
        extended = extended.groupBy(*names).agg(F.max("f").alias("extended"))
        mine = candidates.select("*", *(F.col(column)[i].alias(c) for i, c in enumerate(names)))
        candidates = in_step(mine, extended, names, "left").where(
            F.col("extended").isNull() | (F.col("extended") < F.col("a"))).drop(*names, "extended")
    return candidates


def collocations(df: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int | None = TOP,
                 lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases (all, if None).

    A null language is "und", together with rows that say so; a null or empty text has no
    words, and a language without a frequent phrase no rows. Repeated rows count row by row. An
    empty table gives no rows; other columns are dropped. Texts are read whole at any length,
    three times, and never shuffled. Equal scores are ranked by a, then by the phrase's bytes; the cut
    with the lowest score counts, the shortest first part among equal ones. Products may pass 64
    bits: they are decimals of 38 digits.
    """
    rows = pick(df, lang=lang_column, text=text_column).select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    words, seed = numbered_words(rows)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = stored(words.where(F.col("f") >= min_count).join(totals, "lang"), "often")
    pairs = stored(pair_counts(rows, often, seed, min_count), "pairs")
    records = stored(places(rows, pairs, seed, longest), "places")
    names = PHRASE[:longest]
    counted = pairs.unionByName(often.select("w1", "f"), allowMissingColumns=True)
    counted = counted.unionByName(runs_of_prefixes(records, min_count, longest), allowMissingColumns=True)
    forward = F.array(*(F.coalesce(c, F.lit(0)) for c in names))
    length = F.size(F.filter("forward", lambda x: x != 0))
    last_first = F.reverse(F.slice("forward", 1, F.col("length")))
    streams = stored(
        counted.select(F.col("w1").alias("head"), forward.alias("forward"), "f")
        .withColumn("length", length)
        .withColumn("backward", F.concat(last_first, F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.col("length"))))
        .join(often.select(F.col("w1").alias("head"), "lang", "n"), "head"), "streams")
    kept = not_contained(scored(streams, longest), streams, longest)
    heads = often.select(F.col("w1").alias("head"), "lang")
    kept = kept.withColumn("head", F.col("forward")[0]).join(heads, "head")
    order = [F.desc("score"), F.desc("a")]
    if top is not None:  # those that can be among the first by score and count; the phrase settles ties
        first = F.rank().over(Window.partitionBy("lang").orderBy(*order))
        kept = kept.withColumn("first", first).where(F.col("first") <= top).drop("first")
    spelled = kept.select("*", F.posexplode(F.slice("forward", 1, F.col("length"))).alias("at", "w1")).join(
        often.select("w1", "word"), "w1")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ")
    spelled = spelled.groupBy("lang", "forward", "a", "l", "r", "n", "score").agg(phrase.alias("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
