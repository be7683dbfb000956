"""Price providers: any function (spark, tickers, start, end) -> long OHLCV frame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens import schema

# tickers may be a list or, for a large universe, a frame with a ticker column.
Provider = Callable[[SparkSession, "list[str] | DataFrame", date, date], DataFrame]

FIELDS = ("Open", "High", "Low", "Close", "Volume")


def vendor_slice(bars: DataFrame, tickers: list[str] | DataFrame, start, end, by: str = "ticker") -> DataFrame:
    """Bars of the given tickers with start <= date <= end. Both filters reach the scan
    for a list; a frame of tickers becomes a semi join."""
    inside = bars.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if isinstance(tickers, DataFrame):
        return inside.join(tickers.select(by), by, "left_semi")
    return inside.where(F.col(by).isin(list(tickers)))


def csv_provider(path: str) -> Provider:
    """Long OHLCV files from a vendor drop."""

    def fetch(spark, tickers, start, end):
        bars = spark.read.schema(schema.OHLCV).option("header", True).csv(path)
        return vendor_slice(bars, tickers, start, end)

    return fetch


def frame_provider(bars: DataFrame) -> Provider:
    """Bars that are already a DataFrame, such as another table or a JDBC read."""
    return lambda spark, tickers, start, end: vendor_slice(bars, tickers, start, end)


def vendor_wide_to_long(wide: DataFrame, tickers: list[str], separator: str = "_") -> DataFrame:
    """Columns <ticker><separator><field> to one row per ticker and date.

    Days without a close are dropped, prices have 2 places, the volume is whole. A
    ticker whose columns are missing is skipped.
    """
    present = [t for t in tickers if all(f"{t}{separator}{f}" in wide.columns for f in FIELDS)]
    if not present:
        return wide.sparkSession.createDataFrame([], schema.OHLCV)
    bars = [
        F.struct(
            F.lit(t).alias("ticker"),
            *[
                F.col(f"`{t}{separator}{f}`").cast("bigint" if f == "Volume" else schema.PRICE).alias(f.lower())
                for f in FIELDS
            ],
        )
        for t in present
    ]
    date_column = "date" if "date" in wide.columns else "Date"
    return (
        wide.select(F.col(date_column).cast("date").alias("date"), F.explode(F.array(*bars)).alias("bar"))
        .select("date", "bar.*")
        .where(F.col("close").isNotNull())
    )
