"""Language identification by prediction by partial matching (PPM).

Training counts, per language, which byte follows which context of up to ORDER bytes. The
contexts form one tree of variable order: every context that was seen MIN_SEEN times is kept, and
counts in the others go to their longest kept part. The statistics then are frozen: for every
context, byte and language the code length in bits is computed once. A byte that was seen in
the context costs -log2(count / (total + distinct)); another one costs the escape,
-log2(distinct / (total + distinct)), plus its cost in the next shorter context, where bytes of
the longer context are excluded, so that probabilities sum to 1. A text's language is the one
whose model codes it shortest.

Counting is an aggregation with map-side combining over all training rows, and pruning is done
in Spark too; the driver gets the counts in kept contexts. Scoring walks the
tree for all positions of a batch at once, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm.common import bounded_batches, doc_fold, forget_kept, pick, tagged, tidy, untagged
from fundlens.llm.runs import slices
from fundlens.session import materialize

ORDER = 3
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
# A context is in the tree if it was seen this often, in all languages together.
MIN_SEEN = 20
# Different grams a task counts per language before it passes them on.
GRAMS_IN_TASK = 1_000_000
# Bytes a task counts or scores together; longer texts are cut in pieces that overlap by ORDER.
# Scoring holds some ten numbers per byte, counting merges its counts with those so far.
BYTES_AT_ONCE = 1 << 20
SCORED_AT_ONCE = 256 << 10


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def pieces(texts: list[bytes], limit: int):
    """Lists of (position of text, context length, bytes), each list of some `limit` bytes."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), limit):
            head = min(start, ORDER)
            part = text[start - head:start + limit]
            group.append((i, head, part))
            size += len(part)
            if size >= limit:
                yield group
                group, size = [], 0
    if group:
        yield group


def joined(group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a group with ORDER zero bytes before each piece; where scored bytes are; owner."""
    parts, counted, owner = [], [], []
    at = 0
    for i, head, part in group:
        parts.append(bytes(ORDER) + part)
        counted.append(np.arange(at + ORDER + head, at + ORDER + len(part)))
        owner.append(np.full(len(part) - head, i))
        at += ORDER + len(part)
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(counted), np.concatenate(owner)


def grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """ORDER + 1 bytes ending at each position, the oldest first, as one number."""
    out = np.zeros(len(at), np.uint32)
    for back in range(ORDER, -1, -1):
        out = out << np.uint32(8) | data[at - back].astype(np.uint32)
    return out


class Tally:
    """Counts of grams of one language in one task, sorted."""

    def __init__(self):
        self.values, self.n = np.empty(0, np.uint32), np.empty(0, np.int64)

    def add(self, texts: list[bytes]) -> None:
        for group in pieces(texts, BYTES_AT_ONCE):
            data, at, _ = joined(group)
            values, n = np.unique(grams(data, at), return_counts=True)
            every, where = np.unique(np.concatenate([self.values, values]), return_inverse=True)
            self.n = np.bincount(where, weights=np.concatenate([self.n, n])).astype(np.int64)
            self.values = every

    def batch(self, lang: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(self.n), pa.string()), pa.array(self.values.astype(np.int64)), pa.array(self.n)],
            ["lang", "gram", "n"])


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, gram, n over rows (text, lang) without nulls."""

    def run(batches):
        forget_kept()
        tallies: dict[str, Tally] = {}
        for batch in (part for batch in batches for part in slices(batch, BYTES_AT_ONCE)):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array([t.encode() for t in batch.column("text").to_pylist()], object)
            for lang in set(langs):
                tally = tallies.setdefault(lang, Tally())
                tally.add(texts[langs == lang].tolist())
                if len(tally.n) > GRAMS_IN_TASK:
                    yield tally.batch(lang)
                    del tallies[lang]
        for lang, tally in tallies.items():
            yield tally.batch(lang)

    return rows.select("text", "lang").mapInArrow(tidy(run), "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def pruned(counted: DataFrame) -> DataFrame:
    """lang, gram, n, reach: the bytes of context of a gram that are in the tree; older bytes are 0 and their counts summed."""
    reach = F.lit(0)
    for depth in range(1, ORDER + 1):
        context = F.shiftright("gram", 8).bitwiseAND((1 << 8 * depth) - 1).alias(f"c{depth}")
        counted = counted.select("*", context)
        kept = counted.groupBy(f"c{depth}").agg(F.sum("n").alias(f"n{depth}")).where(F.col(f"n{depth}") >= MIN_SEEN)
        # short contexts are at most 256 or 65,536; a long one has few grams in each language
        counted = counted.join(F.broadcast(kept) if depth < 3 else kept, f"c{depth}", "left")
        reach = F.when(F.col(f"n{depth}").isNotNull(), depth).otherwise(reach)
    part = F.col("gram").bitwiseAND(F.expr("shiftleft(1L, 8 * (reach + 1)) - 1"))
    return counted.select("lang", "gram", "n", reach.alias("reach")).select("lang", part.alias("gram"), "n", "reach").groupBy(
        "lang", "gram", "reach").agg(F.sum("n").alias("n"))


class Model:
    """The frozen tree and its code lengths.

    child[node, symbol] walks from a context to the one with one older byte (-1: not kept);
    bits[node * symbols + symbol] are the code lengths, one per language. Symbol 0 stands for
    all bytes never seen in training and, as a context, for the start of a text. `reach`: so many
    bytes of each gram's context are known, by default all.
    """

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, reach: np.ndarray | None = None):
        self.langs = langs
        seen = np.unique(np.concatenate([(gram >> 8 * k) & 255 for k in range(ORDER + 1)] + [[0]]))
        seen = seen[np.isin(seen, gram & 255)]
        self.symbol = np.zeros(256, np.int32)
        self.symbol[seen.astype(int)] = np.arange(1, len(seen) + 1)
        self.symbols = a = len(seen) + 1
        reach = np.full(len(gram), ORDER) if reach is None else reach
        next_symbol = self.symbol[gram & 255]
        older = [self.symbol[(gram >> 8 * k) & 255] for k in range(1, ORDER + 1)]
        self.child = np.full((1, a), -1, np.int32)
        nodes = np.zeros(len(gram), np.int64)  # the node each gram has reached; -1 when it left the tree
        counts = [self._table(nodes, next_symbol, lang, n, 1)]
        parents = [np.zeros(1, np.int64)]
        total = 1
        for depth in range(ORDER):
            key = np.where((nodes >= 0) & (reach > depth), nodes * a + older[depth], -1)
            keys, where = np.unique(key, return_inverse=True)
            often = np.bincount(where, weights=n)
            often[keys < 0] = 0
            kept = np.flatnonzero(often >= MIN_SEEN)
            number = np.full(len(keys), -1, np.int64)
            number[kept] = np.arange(total, total + len(kept))
            self.child.reshape(-1)[keys[kept]] = number[kept]
            self.child = np.concatenate([self.child, np.full((len(kept), a), -1, np.int32)])
            nodes = number[where]
            counts.append(self._table(np.where(nodes >= 0, nodes - total, -1), next_symbol, lang, n, len(kept)))
            parents.append(keys[kept] // a)
            total += len(kept)
        self.bits = self._code_lengths(np.concatenate(counts), np.concatenate(parents))

    def _table(self, nodes, symbols, lang, n, size) -> np.ndarray:
        out = np.zeros(size * self.symbols * len(self.langs))
        ok = nodes >= 0
        np.add.at(out, (nodes[ok] * self.symbols + symbols[ok]) * len(self.langs) + lang[ok], n[ok])
        return out.reshape(size, self.symbols, len(self.langs))

    def _code_lengths(self, counts: np.ndarray, parents: np.ndarray) -> np.ndarray:
        """Bits per (context, symbol, language); contexts come after their parents."""
        a = self.symbols
        unseen_bytes = 256 - (a - 1)
        width = np.ones(a)
        width[0] = unseen_bytes  # symbol 0 is that many bytes, each as likely as another

        def level(c: np.ndarray, excluded: np.ndarray, lower: np.ndarray) -> np.ndarray:
            """Probabilities in one context, given its counts without the excluded symbols."""
            c = np.where(excluded, 0, c)
            total, distinct = c.sum(0), (c > 0).sum(0)
            whole = np.maximum(total + distinct, 1)
            escape = np.where(total > 0, distinct / whole, 1.0)
            return np.where(c > 0, c / whole, escape * lower)

        def even(excluded: np.ndarray) -> np.ndarray:
            """Order -1: even over the bytes not excluded; of symbol 0, for one byte."""
            left = np.where(excluded, 0, width[:, None]).sum(0)
            return np.where(excluded, 0, 1 / np.maximum(left, 1))

        bits = np.empty(counts.shape, np.float32)
        for node in range(len(counts)):
            chain = [node]
            while chain[-1]:
                chain.append(int(parents[chain[-1]]))
            excluded = [np.zeros(counts.shape[1:], bool)]
            for c in chain:
                excluded.append(excluded[-1] | (counts[c] > 0))
            p = even(excluded[-1])
            for c, skip in zip(reversed(chain), reversed(excluded[:-1])):
                p = level(counts[c], skip, p)
            bits[node] = -np.log2(np.maximum(p, 1e-300))
        return bits.reshape(-1, len(self.langs))

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        for group in pieces(texts, min(BYTES_AT_ONCE, SCORED_AT_ONCE)):
            data, at, owner = joined(group)
            symbol = self.symbol[data]
            node = np.zeros(len(at), np.int32)
            going = self.child[node, symbol[at - 1]]
            node = np.where(going >= 0, going, node)
            for back in range(2, ORDER + 1):
                further = np.where(going >= 0, self.child[np.maximum(going, 0), symbol[at - back]], -1)
                node = np.where(further >= 0, further, node)
                going = further
            cost = self.bits[node * self.symbols + symbol[at]]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[starts]] += np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lengths = self.code_lengths([t.encode() if t else b"" for t in texts])
        best = lengths.argmin(1)  # the first in code-point order of equal ones
        share = 1 / np.exp2(lengths[np.arange(len(texts)), best][:, None] - lengths).sum(1)
        known = [bool(t) and has_letter(t) for t in texts]
        return ([self.langs[b] if k else UNKNOWN for b, k in zip(best, known)],
                [float(s) if k else 0.0 for s, k in zip(share, known)])


def train(rows: DataFrame) -> Model | None:
    """A model of all rows (text, lang) that have both, or None if there is none.

    The counts of kept contexts reach the driver; they grow with the tree.
    """
    bounded_batches(rows.sparkSession)
    counted = materialize(count_grams(rows.where("text IS NOT NULL AND lang IS NOT NULL")))
    table = pruned(counted).toArrow()
    if table.num_rows == 0:
        return None
    langs, lang = np.unique(np.array(table["lang"].to_pylist(), str), return_inverse=True)
    return Model(langs.tolist(), lang, *(table[c].to_numpy() for c in ("gram", "n", "reach")))


def _predictor(spark: SparkSession, model: Model | None):
    """Texts -> (languages, scores), for use in tasks."""
    if model is None:
        return lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts))
    sent = spark.sparkContext.broadcast(model)  # contexts x symbols x languages
    return lambda texts: sent.value.predict(texts)


def identify(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             lang_column: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1, the share of the best model), one row per row.

    Learns from rows with text and language whose crc32(id as text) mod 3 is not 1; the other
    rows are held_out. A null text, or one without a letter, is `und` with score 0, and so is
    every text if there is nothing to learn from. Null ids count as empty text in the fold.
    Repeated rows are rows like others; an empty table gives no rows; other columns are dropped.
    """
    rows = pick(df, doc_id=id_column, text=text_column, lang=lang_column)
    held_out = doc_fold(F.col("doc_id"), FOLDS) == HELD_OUT
    predict = _predictor(df.sparkSession, train(rows.where(~held_out)))

    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, BYTES_AT_ONCE)):
            langs, scores = predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        tidy(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identified(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               lang_column: str = "lang") -> DataFrame:
    """The rows of df, with all columns, whose language `identify` knows; a null language becomes
    the one it predicts.

    Null texts and texts without a letter go, and all rows if there is nothing to learn from.
    Repeated rows and null ids are treated as by `identify`; an empty table gives no rows.
    """
    named = tagged(df, doc_id=id_column, text=text_column, lang=lang_column)
    learn = named.where(doc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    predict = _predictor(df.sparkSession, train(learn))
    rows = named.drop("doc_id", "lang")
    at = df.columns.index(lang_column)

    def run(batches):
        for batch in (part for batch in batches for part in slices(batch, BYTES_AT_ONCE)):
            langs, _ = predict(batch.column("text").to_pylist())
            filled = batch.set_column(at, batch.schema.field(at), pc.coalesce(batch.column(at), pa.array(langs, batch.column(at).type)))
            yield filled.filter(pa.array([lang != UNKNOWN for lang in langs], pa.bool_()))

    return untagged(rows.mapInArrow(tidy(run), rows.schema), df)
