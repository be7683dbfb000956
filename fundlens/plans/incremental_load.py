"""Loading landing files past the watermark: in one batch job, or one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.operators import summaries
from fundlens.operators.load import append_new, classify_landing, incremental_summary
from fundlens.sources.files import as_price_table
from fundlens.sources.landing import ARRIVAL, landing_files, list_files, parse_price_lines, price_lines
from fundlens.sources.archive import handled_files
from fundlens.sources.commits import snapshot
from fundlens.sources.loads import Load
from fundlens.sources.summaries import day_summary, security_summary
from fundlens.sources.tables import read_loads, read_table


def ticker_watermarks(load: Load) -> DataFrame:
    """Newest date per ticker that other loads hold, from the summaries of the price table."""
    by_id = summaries.high_watermark(load.securities())
    names = load.read("constituents").select(F.col("id").alias("constituent_id"), "ticker")
    return by_id.join(names, "constituent_id").select("ticker", "wm")


def load_rows(load: Load, rows: DataFrame, watermarks: DataFrame, whole: bool = True) -> DataFrame:
    """Validate, admit and write parsed landing rows, and commit; returns the one-row summary.

    Nothing is seen before the commit, and a repeated load takes the place of its first run.
    `whole`: store the watermarks of all tickers, else of those that the rows move.
    """
    constituents = load.read("constituents")
    rows = load.write_and_read(rows, "staged")
    verdicts = classify_landing(rows, watermarks, constituents, arrival=ARRIVAL)
    mismatch = F.coalesce((F.col("low") > F.col("close")) | (F.col("high") < F.col("close")), F.lit(False))
    labelled = load.write_and_read(verdicts.withColumn("ohlc_mismatch", mismatch), "labelled")
    fresh = as_price_table(labelled.where(F.col("issue").isNull()).drop("issue"), constituents)
    load.write(_not_loaded(load, fresh), "prices")
    load.write(*(next_watermarks(labelled, watermarks), "watermarks") if whole else (moved_watermarks(labelled), "watermark_changes"))
    passed = F.col("issue").isNull() | F.col("issue").isin("duplicate", "unknown_ticker")
    handled = labelled.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(passed).alias("passed"),
        F.count_if(F.col("issue").isNull()).alias("inserted"),
    )
    load.write(handled, "files")
    summary = incremental_summary(labelled, watermarks).withColumn("finished_at", F.current_timestamp())
    load.write(summary, "runs")
    load.commit()
    return summary


def _not_loaded(load: Load, fresh: DataFrame) -> DataFrame:
    """Second guard besides the watermark: drop keys other loads hold."""
    return append_new(stored_among(load, fresh), fresh, ["constituent_id", "date"])


def stored_among(load: Load, rows: DataFrame) -> DataFrame:
    """Other loads' prices, as far as they may hold keys (constituent_id, date) of `rows`.

    Only rows whose date lies within their security's stored dates can be stored already. Months
    before and after theirs are not read; if there are none, as in plain appends, nothing is.
    """
    month = F.date_format("date", "yyyy-MM")
    first, last = summaries.possibly_stored(rows, load.securities()).agg(F.min(month), F.max(month)).first()
    if first is None:
        return load.spark.createDataFrame([], load.others("prices").schema)
    return load.others("prices").where(F.col("month").between(first, last))


def moved_watermarks(labelled: DataFrame) -> DataFrame:
    """The newest date of each ticker with rows that passed validation."""
    passed = F.col("issue").isNull() | F.col("issue").isin("duplicate", "unknown_ticker")
    return labelled.where(passed).groupBy("ticker").agg(F.max("date").alias("wm"))


def newest_of(watermarks: DataFrame) -> DataFrame:
    return watermarks.groupBy("ticker").agg(F.max("wm").alias("wm"))


def next_watermarks(labelled: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Watermarks after the rows that passed validation, one row per ticker ever seen."""
    return newest_of(watermarks.unionByName(moved_watermarks(labelled)))


def require_loaded(spark: SparkSession, root: str) -> None:
    if not read_table(spark, root, "prices").take(1):
        raise ValueError("the price table is empty: run the full load first")


def run_incremental(
    spark: SparkSession, root: str, incoming: str, load_id: str, dry_run: bool = False
) -> DataFrame:
    """Handle all pending files of the landing folder in path order, in one job.

    dry_run returns the rows per pending file and loads nothing. Handled files are
    remembered in the `files` table; a load that is repeated handles its files again. A file that
    came after one of its name was archived is pending.
    """
    require_loaded(spark, root)
    load = Load(spark, root, load_id)
    waiting = list_files(spark, incoming).join(handled_files(spark, root, load), "file", "left_anti")
    # File names only, the same list Spark's own file index keeps on the driver.
    pending = [r["path"] for r in waiting.select("path").collect()]
    if not pending:
        return spark.createDataFrame([], "files_processed bigint, files_skipped bigint, rows_inserted bigint, rows_dropped bigint, new_watermark date")
    rows = parse_price_lines(price_lines(spark, pending), len(pending))
    if dry_run:
        return rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    return load_rows(load, rows, ticker_watermarks(load))


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every row that was not stored, with the reason and the load that read it."""
    return read_loads(spark, root, "labelled").where(F.col("issue").isNotNull())


def recent_runs(spark: SparkSession, root: str, n: int = 100) -> DataFrame:
    """The last n run records, newest first."""
    return read_loads(spark, root, "runs").orderBy(F.col("finished_at").desc(), F.col("load_id").desc()).limit(n)


def ingest_status(spark: SparkSession, root: str, incoming: str) -> DataFrame:
    """Status of the tables and the landing folder, from the summaries: no price row is read."""
    at = snapshot(spark, root)
    files = landing_files(list_files(spark, incoming), read_table(spark, root, "files", at=at), handled_files(spark, root))
    return summaries.ingest_status(security_summary(spark, root, at=at), day_summary(spark, root, at=at), files)


def ticker_spans(spark: SparkSession, root: str, sort: str | None = None, ascending: bool = True) -> DataFrame:
    """First and last date and row count of every ticker, from the summaries."""
    at = snapshot(spark, root)
    return summaries.watermarks(security_summary(spark, root, at=at), read_table(spark, root, "constituents", at=at), sort, ascending)


def lagging_tickers(spark: SparkSession, root: str) -> DataFrame:
    """Tickers whose newest date is before the newest of all, from the summaries."""
    at = snapshot(spark, root)
    return summaries.lagging_tickers(security_summary(spark, root, at=at), read_table(spark, root, "constituents", at=at))
