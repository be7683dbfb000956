"""Table statistics, freshness and load status.

Distinct counts come from one grouping per column instead of several DISTINCT
aggregates in one query, which would multiply every row before the shuffle. Rows
shrink to one per day or per security in the map tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_row(*parts: DataFrame) -> DataFrame:
    """Join single-row frames side by side: stack them, then take the only value of each column."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _days(prices: DataFrame) -> DataFrame:
    return prices.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def profile(prices: DataFrame, by: str = "constituent_id") -> DataFrame:
    """Rows, distinct tickers and days, and the date range of a price table."""
    days = _days(prices).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
    return _one_row(days, prices.select(by).distinct().agg(F.count(F.lit(1)).alias("tickers")))


def db_stats(
    constituents: DataFrame, prices: DataFrame, uploads: DataFrame, holdings: DataFrame
) -> DataFrame:
    n = F.count(F.lit(1))
    return _one_row(
        constituents.agg(
            n.alias("total_constituents"), F.countDistinct("sector").alias("total_sectors")
        ),
        _days(prices).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_price_records"),
            F.min("date").alias("earliest_date"),
            F.max("date").alias("latest_date"),
            n.alias("trading_days"),
        ),
        uploads.agg(n.alias("total_etf_uploads")),
        holdings.agg(n.alias("total_holdings")),
    )


def watermarks(
    prices: DataFrame, constituents: DataFrame, sort: str | None = None, ascending: bool = True
) -> DataFrame:
    """First and last date and row count of every security, in no order unless one is
    asked for; ties then are by ticker."""
    spans = prices.groupBy("constituent_id").agg(
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return named_spans(spans, constituents, sort, ascending)


def named_spans(spans: DataFrame, constituents: DataFrame, sort: str | None, ascending: bool) -> DataFrame:
    dim = constituents.select(F.col("id").alias("constituent_id"), "ticker", "sector")
    rows = spans.join(dim, "constituent_id").select(
        "ticker", "sector", "earliest_date", "latest_date", "record_count"
    )
    return rows if sort is None else rows.orderBy(F.col(sort).asc() if ascending else F.col(sort).desc(), "ticker")


def lagging_tickers(prices: DataFrame, constituents: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Securities whose newest date is before the newest date of the table."""
    newest = (prices if dates is None else dates).agg(F.max("date")).scalar()
    latest = prices.groupBy("constituent_id").agg(F.max("date").alias("latest_date"))
    return behind(latest, newest, constituents)


def behind(latest: DataFrame, newest: Column, constituents: DataFrame) -> DataFrame:
    dim = constituents.select(F.col("id").alias("constituent_id"), "ticker")
    return latest.where(F.col("latest_date") < newest).join(dim, "constituent_id").select("ticker", "latest_date")


def landing_status(files: DataFrame) -> DataFrame:
    """Pending and processed file counts from a list of (file, state)."""
    return files.agg(
        F.count_if(F.col("state") == "pending").alias("pending_files"),
        F.count_if(F.col("state") == "processed").alias("processed_files"),
    )


def ingest_status(prices: DataFrame, files: DataFrame, by: str = "constituent_id") -> DataFrame:
    """One row: freshness, counts, lagging tickers and landing files. Healthy means
    nothing is pending, whatever the lag."""
    return status(prices.groupBy(by).agg(F.max("date").alias("latest")), _days(prices), files)


def status(newest: DataFrame, day_counts: DataFrame, files: DataFrame) -> DataFrame:
    """ingest_status from each security's newest date (`latest`), the rows of each day, and the files."""
    latest = newest.groupBy("latest").agg(F.count(F.lit(1)).alias("tickers"))
    tickers = latest.agg(
        F.coalesce(F.sum("tickers"), F.lit(0)).alias("total_tickers"),
        (F.coalesce(F.sum("tickers"), F.lit(0)) - F.coalesce(F.max_by("tickers", "latest"), F.lit(0))).alias(
            "lagging_tickers"
        ),
    )
    days = day_counts.agg(
        F.max("date").alias("high_watermark"),
        F.min("date").alias("min_date"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("total_trading_days"),
    )
    current = F.concat(F.lit("Data is current through "), F.col("high_watermark").cast("string"), F.lit("."))
    return _one_row(tickers, days, landing_status(files)).select(
        (F.col("pending_files") == 0).alias("pipeline_healthy"),
        "high_watermark", "min_date", "total_records", "total_tickers", "total_trading_days",
        "pending_files", "processed_files", "lagging_tickers",
        F.coalesce(current, F.lit("No data loaded yet.")).alias("freshness_note"),
    )
