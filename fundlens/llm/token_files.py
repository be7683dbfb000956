"""Token ids of a corpus as compressed binary files, and back.

A folder of files has three tables. `table` is the frequency table of the numeral system, shared
by all blocks, with one row per id that occurs. `blocks` has one row per block: its part and
number, how many ids it holds, the documents in it with their lengths, and its bytes (see
`rans`). A block holds whole documents, in order, and closes beyond BLOCK_IDS ids. `parts` says
for each part how many ids lie before it, so that parts are written independently. All three are
written by Spark as Parquet, which commits whole files only and reads rows without the others.
"""

from __future__ import annotations

from hashlib import md5
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlens.llm.common import fresh_folder, per_worker, pick, stored
from fundlens.llm.rans import IDS_TOGETHER, Table, decode, encode
from fundlens.llm.runs import slices
from fundlens.llm.word_ids import Encoder

END_ID = 2
BLOCK_IDS = 1 << 16


def _encoder(spark: SparkSession, path: str, end_id: int):
    spec = Path(path).read_text()
    sent = spark.sparkContext.broadcast(spec)  # bounded by the vocabulary
    key = md5(spec.encode()).hexdigest()
    return lambda: per_worker(("word_ids", (key, end_id)), lambda: Encoder(sent.value, end_id))


def tokenized(rows: DataFrame, encoder) -> DataFrame:
    """doc_id, hash (of the text) and ids, packed as little-endian numbers of 2 bytes, or of 4
    where an id needs them: a written table."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                ids = encoder().encode(part.column("text"))
                narrow = [i.astype("<u2" if not len(i) or i.max() < 1 << 16 else "<u4") for i in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("hash"), pa.array([i.itemsize == 4 for i in narrow]),
                    pa.array([i.tobytes() for i in narrow], pa.binary())], ["doc_id", "hash", "wide", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    hashed = rows.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    return stored(hashed.mapInArrow(run, f"doc_id {kind}, hash long, wide boolean, ids binary"), "tokens", compression="zstd")


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u4" if w else "<u2").astype(np.uint32)
            for b, w in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())]


def id_counts(tokens: DataFrame) -> Table:
    """The frequency table of all ids; the driver gets one row per id that occurs."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            n = np.bincount(np.concatenate([*_unpacked(batch), np.empty(0, np.uint32)]))
            if len(n) > len(total):
                n, total = total, n.astype(np.int64)
            total[:len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = tokens.select("wide", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return Table([0], [1])
    return Table.of_counts(counts["id"].to_numpy(), counts["n"].to_numpy())


def in_order(tokens: DataFrame) -> DataFrame:
    """Rows sorted by id (nulls first), rows of one id by the hash of their text.

    Where rows come from is the last key, so that many equal rows spread over tasks.
    """
    placed = tokens.withColumn("place", F.monotonically_increasing_id())
    return placed.orderBy(F.asc_nulls_first("doc_id"), "hash", "place").select("doc_id", "wide", "ids")


def write(df: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
          id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the ids of every text, each followed by end_id, in ascending order of the id column.

    A null or empty text has the end id alone. Null ids come first; rows of one id are all
    written, in the order of a hash of their texts. An empty table gives files without blocks.
    Texts are read whole at any length, once; their ids are stored, counted for the table, and
    shuffled by id for the blocks. Strings of special tokens in a text are those tokens, the
    library's default.
    """
    spark = df.sparkSession
    tokens = tokenized(pick(df, doc_id=id_column, text=text_column), _encoder(spark, tokenizer_path, end_id))
    table = id_counts(tokens)
    spark.createDataFrame(pa.table({"id": pa.array(table.ids.astype(np.int64)), "frequency": pa.array(table.frequencies.astype(np.int64))})
                          ).coalesce(1).write.parquet(f"{folder}/table")
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        waiting, doc_ids, ids, held, total = [], [], [], 0, 0

        def close() -> None:
            nonlocal doc_ids, ids, held, total, number
            waiting.append((number, doc_ids, [len(i) for i in ids], np.concatenate(ids)))
            number, total = number + 1, total + held
            doc_ids, ids, held = [], [], 0

        def rows_of(blocks) -> pa.RecordBatch:
            numbers, documents, lengths, joined = zip(*blocks)
            return pa.RecordBatch.from_arrays([
                pa.array([part] * len(blocks), pa.int32()), pa.array(numbers, pa.int64()),
                pa.array([len(b) for b in joined], pa.int64()), pa.array([pa.array(d, type=doc_type) for d in documents], pa.list_(doc_type)),
                pa.array(lengths, pa.list_(pa.int64())), pa.array(encode(list(joined), table), pa.binary())],
                ["part", "block", "n_ids", "doc_ids", "lengths", "data"])

        doc_type = pa.null()
        for batch in batches:
            doc_type = batch.column("doc_id").type
            for doc_id, found in zip(batch.column("doc_id"), _unpacked(batch)):
                doc_ids.append(doc_id)
                ids.append(found)
                held += len(found)
                if held >= BLOCK_IDS:
                    close()
                    if total >= IDS_TOGETHER:
                        yield rows_of(waiting)
                        waiting, total = [], 0
        if ids:
            close()
        if waiting:
            yield rows_of(waiting)

    blocks = in_order(tokens).mapInArrow(
        run, f"part int, block long, n_ids long, doc_ids array<{kind}>, lengths array<long>, data binary")
    blocks.write.parquet(f"{folder}/blocks")
    # one row per part
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ids_before")).coalesce(1).write.parquet(f"{folder}/parts")


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """part, block, and how many ids lie before the block; blocks' bytes are not read."""
    blocks = spark.read.parquet(f"{folder}/blocks").select("part", "block", "n_ids")
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.parquet(f"{folder}/parts")
    return blocks.join(parts, "part").select(
        "part", "block", (F.col("ids_before") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).alias("first"))


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (array<int>), from the files.

    digest: n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in
    place of the ids. Blocks are decoded apart from each other; a damaged one is an error.
    """
    stored = spark.read.parquet(f"{folder}/table").toArrow()  # one row per id of the vocabulary
    sent = spark.sparkContext.broadcast(Table(stored["id"].to_numpy(), stored["frequency"].to_numpy()))
    blocks = spark.read.parquet(f"{folder}/blocks").join(block_starts(spark, folder), ["part", "block"])
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            n = np.cumsum(batch.column("n_ids").to_numpy())
            cuts = [0, *(np.flatnonzero(np.diff(n // IDS_TOGETHER)) + 1).tolist(), len(n)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                ids = decode(part.column("data").to_pylist(), sent.value)
                lengths = [np.array(x, np.int64) for x in part.column("lengths").to_pylist()]
                firsts = part.column("first").to_pylist()
                starts = [first + np.cumsum(m) - m for first, m in zip(firsts, lengths)]
                texts = [piece for block, m in zip(ids, lengths) for piece in np.split(block, np.cumsum(m)[:-1])]
                columns = [part.column("doc_ids").flatten(), pa.array(np.concatenate([*starts, np.empty(0, np.int64)]))]
                if digest:
                    columns += [pa.array([len(t) for t in texts], pa.int64()), pa.array([crc32(t.astype("<u4").tobytes()) for t in texts], pa.int64())]
                else:
                    columns.append(pa.array([t.astype(np.int32) for t in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", *(["n_tokens", "ids_crc32"] if digest else ["ids"])]
    rest = "n_tokens long, ids_crc32 long" if digest else "ids array<int>"
    return blocks.mapInArrow(run, f"doc_id {kind}, start long, {rest}")


def round_trip(df: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per row, read back from files written as by `write`.

    The files go to `folder`, or to a new one under the shared checkpoint folder. Nulls, empty
    texts, repeated rows and empty tables are treated as by `write`; other columns are dropped.
    """
    folder = folder or fresh_folder(df.sparkSession, "token-files")
    write(df, folder, tokenizer_path, end_id, id_column, text_column)
    return read(df.sparkSession, folder, digest=True)
