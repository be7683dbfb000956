"""Partial aggregates of prices that merge: per security, per day, and per security and month.

A summary of two disjoint sets of price rows comes from the summaries of each, so statistics of
a growing table need one small summary per load and no scan of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.operators import monitor


def by_security(prices: DataFrame) -> DataFrame:
    """constituent_id, earliest_date, latest_date, record_count, and close and volume of the latest date."""
    return prices.groupBy("constituent_id").agg(
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.count(F.lit(1)).alias("record_count"),
        F.max_by("close_price", "date").alias("close_price"),
        F.max_by("volume", "date").alias("volume"),
    )


def merge_securities(parts: DataFrame) -> DataFrame:
    """The summary of all rows from summaries of disjoint ones."""
    return parts.groupBy("constituent_id").agg(
        F.min("earliest_date").alias("earliest_date"),
        F.max("latest_date").alias("latest_date"),
        F.sum("record_count").alias("record_count"),
        F.max_by("close_price", "latest_date").alias("close_price"),
        F.max_by("volume", "latest_date").alias("volume"),
    )


def by_day(prices: DataFrame) -> DataFrame:
    """date and n, its rows."""
    return prices.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def merge_days(parts: DataFrame) -> DataFrame:
    return parts.groupBy("date").agg(F.sum("n").alias("n"))


def by_month(prices: DataFrame) -> DataFrame:
    """constituent_id, month (yyyy-MM) and n, its rows."""
    return prices.groupBy("constituent_id", F.date_format("date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def merge_months(parts: DataFrame) -> DataFrame:
    return parts.groupBy("constituent_id", "month").agg(F.sum("n").alias("n"))


def high_watermark(securities: DataFrame) -> DataFrame:
    """Newest loaded date per security."""
    return securities.select("constituent_id", F.col("latest_date").alias("wm"))


def latest_state(securities: DataFrame) -> DataFrame:
    """Each security's last row: date, close and volume."""
    return securities.select("constituent_id", F.col("latest_date").alias("date"), F.col("close_price").alias("close"), "volume")


def watermarks(securities: DataFrame, constituents: DataFrame, sort: str | None = None, ascending: bool = True) -> DataFrame:
    return monitor.named_spans(securities, constituents, sort, ascending)


def lagging_tickers(securities: DataFrame, constituents: DataFrame) -> DataFrame:
    newest = securities.agg(F.max("latest_date")).scalar()
    return monitor.behind(securities, newest, constituents)


def ingest_status(securities: DataFrame, days: DataFrame, files: DataFrame) -> DataFrame:
    return monitor.status(securities.select(F.col("latest_date").alias("latest")), days, files)


def possibly_stored(rows: DataFrame, securities: DataFrame) -> DataFrame:
    """The rows (constituent_id, date) whose date lies within the stored dates of their security.

    No other row can be stored already, so an append looks for its keys among these only.
    """
    spans = securities.select("constituent_id", "earliest_date", "latest_date")
    inside = (F.col("date") >= F.col("earliest_date")) & (F.col("date") <= F.col("latest_date"))
    return rows.join(spans, "constituent_id").where(inside).drop("earliest_date", "latest_date")
