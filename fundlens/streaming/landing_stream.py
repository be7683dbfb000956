"""The landing folder as a stream: one file per micro-batch, each loaded exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundlens.plans.incremental_load import load_rows, newest_of, require_loaded, ticker_watermarks
from fundlens.sources.files import text_lines
from fundlens.sources.landing import list_files, parse_price_lines
from fundlens.sources.loads import Load
from fundlens.sources.tables import read_loads


WHOLE_EVERY = 16


def start_landing_stream(
    spark: SparkSession,
    root: str,
    incoming: str,
    checkpoint: str,
    name: str,
    archive: str | None = None,
    files_per_batch: int = 1,
    interval: str | None = None,
) -> StreamingQuery:
    """Load landing files as they arrive; without an interval, load what is there and stop.

    A micro-batch is load <name>-<batch number>. It reads the watermarks that the batches before
    it left and takes the place of an earlier run of the same batch, so a batch that Spark
    replays after a failure changes nothing. It writes the watermarks of the tickers in it; every
    WHOLE_EVERY-th batch writes those of all, so that a batch reads few others. `name`
    belongs to the checkpoint: a new checkpoint needs a new name. Between its batches
    the stream is the only writer of prices. Files come in order of modification time.
    With `archive`, Spark moves files there once they are done.
    """
    require_loaded(spark, root)
    _check_name(spark, root, checkpoint, name)
    reader = (
        spark.readStream.option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = text_lines(reader, incoming)

    def load_batch(batch: DataFrame, number: int) -> None:
        load = Load(batch.sparkSession, root, batch_load_id(name, number))
        rows = parse_price_lines(batch, files_per_batch)
        load_rows(load, rows, watermarks_before(load, name, number), whole=number % WHOLE_EVERY == 0)

    writer = lines.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def batch_load_id(name: str, number: int) -> str:
    return f"{name}-{number:012d}"


def watermarks_before(load: Load, name: str, number: int) -> DataFrame:
    """Watermarks before a batch: those of all prices, and what the stream's batches moved.

    The last whole ones and the changes since are read. A fresh load that has emptied the tables
    since has emptied these too.
    """
    start = max(0, number - 1) // WHOLE_EVERY * WHOLE_EVERY
    earlier = F.col("load_id").isin([batch_load_id(name, i) for i in range(start, number)])
    moved = load.others("watermarks").unionByName(load.others("watermark_changes")).where(earlier)
    return newest_of(ticker_watermarks(load).unionByName(moved.select("ticker", "wm")))


def _check_name(spark: SparkSession, root: str, checkpoint: str, name: str) -> None:
    """Batch numbers restart with a new checkpoint and would overwrite older loads of the name."""
    started = list_files(spark, checkpoint, "metadata").take(1)
    used = read_loads(spark, root, "runs").where(F.col("load_id").startswith(f"{name}-")).take(1)
    if used and not started:
        raise ValueError(f"stream name {name!r} belongs to another checkpoint: choose a new one")
