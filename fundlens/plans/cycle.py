"""Runs that leave a record whatever becomes of them, and the whole cycle: fetch, land, load, archive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.operators.load import feed_first_n_days
from fundlens.plans.incremental_load import require_loaded, run_incremental
from fundlens.sources.archive import archive_handled
from fundlens.sources.commits import ConcurrentLoad
from fundlens.sources.landing import write_feed
from fundlens.sources.loads import Load
from fundlens.sources.summaries import security_summary
from fundlens.sources.tables import SCHEMAS, read_table
from fundlens.sources.vendor import Provider

MAX_ERROR_CHARS = 2000
TRIES = 5


def record_run(spark: SparkSession, root: str, load_id: str, kind: str, started: datetime, rows: int = 0, error: str | None = None) -> None:
    """Store one line about a run, as a commit of its own, also beside other writers."""
    now = datetime.now(timezone.utc)
    line = [(load_id, kind, started, now, error is None, rows, error and error[:MAX_ERROR_CHARS])]
    for left in reversed(range(TRIES)):
        record = Load(spark, root, f"run-{uuid4().hex}")
        record.write(spark.createDataFrame(line, SCHEMAS["run_log"]), "run_log")
        try:
            record.commit()
            return
        except ConcurrentLoad:
            if not left:
                raise


def recorded(spark: SparkSession, root: str, load_id: str, kind: str, job: Callable[[], DataFrame], count: Callable[[DataFrame], int]) -> DataFrame:
    """The job's result; its run is recorded with count(result) rows, or with its error."""
    started = datetime.now(timezone.utc)
    try:
        result = job()
        rows = count(result)
    except Exception as error:
        record_run(spark, root, load_id, kind, started, error=f"{type(error).__name__}: {error}")
        raise
    record_run(spark, root, load_id, kind, started, rows)
    return result


def run_recorded(spark: SparkSession, root: str, incoming: str, load_id: str, dry_run: bool = False, archive: str | None = None) -> DataFrame:
    """run_incremental with a record, failed and dry runs too; handled files then go to `archive`.

    Files that an earlier run left unmoved go first, so a run that died between its commit and
    its moves is finished by the next.
    """
    if archive is not None and not dry_run:
        archive_handled(spark, root, incoming, archive)
    column = "rows" if dry_run else "rows_inserted"
    total = lambda df: df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
    result = recorded(spark, root, load_id, "dry_run" if dry_run else "incremental",
                      lambda: run_incremental(spark, root, incoming, load_id, dry_run), total)
    if archive is not None and not dry_run:
        archive_handled(spark, root, incoming, archive)
    return result


def fetch_next_days(spark: SparkSession, root: str, provider: Provider, n: int = 1, until: date | None = None) -> DataFrame:
    """The provider's bars of the next n days after the newest stored one, for all known tickers.

    The provider is asked for ranges that double until they hold n days, or reach `until` (today
    at the latest): it is never asked for all later history because of a gap.
    """
    tickers = read_table(spark, root, "constituents").select("ticker")
    stored = security_summary(spark, root).agg(F.max("latest_date").alias("date"))
    last = stored.first()[0]
    until = until or date.today()
    span = n + n // 2 + 6
    while True:
        end = min(last + timedelta(days=span), until)
        bars = provider(spark, tickers, last + timedelta(days=1), end)
        if end >= until or bars.select("date").distinct().limit(n).count() >= n:
            return feed_first_n_days(bars, stored, n)
        span *= 2


def run_cycle(spark: SparkSession, root: str, incoming: str, load_id: str, provider: Provider, n: int = 1,
              archive: str | None = None, until: date | None = None) -> DataFrame:
    """Fetch the next n days, land them as files, load what is pending, archive what was handled.

    Returns the summary of the load. The run is recorded, a failed one with its error.
    """
    require_loaded(spark, root)

    def job() -> DataFrame:
        write_feed(fetch_next_days(spark, root, provider, n, until), incoming)
        return run_incremental(spark, root, incoming, load_id)

    if archive is not None:
        archive_handled(spark, root, incoming, archive)
    total = lambda df: df.agg(F.coalesce(F.sum("rows_inserted"), F.lit(0))).first()[0]
    result = recorded(spark, root, load_id, "cycle", job, total)
    if archive is not None:
        archive_handled(spark, root, incoming, archive)
    return result


def run_history(spark: SparkSession, root: str, n: int = 100) -> DataFrame:
    """The last n runs, newest first: load_id, kind, started_at, finished_at, success, rows, error."""
    log = read_table(spark, root, "run_log").withColumnRenamed("run", "load_id")
    return log.orderBy(F.desc("finished_at"), F.desc("load_id")).limit(n)
