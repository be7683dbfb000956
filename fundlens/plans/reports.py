"""The analytics job: every market report of a price table, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.operators import market


# Ticker pairs of the correlation report (fixed values).
CORRELATION_PAIRS = [
    ("AAPL", "MSFT"),
    ("AAPL", "XOM"),
    ("JPM", "GS"),
    ("JNJ", "PFE"),
    ("AMZN", "WMT"),
    ("TSLA", "F"),
    ("GOOGL", "META"),
    ("CVX", "XOM"),
]


def correlations(prices: DataFrame, constituents: DataFrame, tickers: list[tuple[str, str]]) -> DataFrame:
    """Correlation of the closes of ticker pairs; unknown pairs are left out."""
    pairs = F.broadcast(market.pairs_of(tickers, constituents))
    found = market.price_correlation(prices, pairs)
    return found.join(pairs, ["key_a", "key_b"]).select("ticker_a", "ticker_b", "common_days", "corr")


def market_reports(prices: DataFrame, constituents: DataFrame) -> dict[str, DataFrame]:
    def named(df: DataFrame) -> DataFrame:
        return market.with_names(df, constituents, "ticker").drop(market.KEY)

    return {
        "moving_averages": named(market.moving_averages(prices)),
        "volatility_analysis": named(market.volatility(prices)).orderBy(F.col("volatility").desc(), "ticker"),
        "performance_ranking": named(market.performance_ranking(prices)).orderBy("rank"),
        "volume_leaders": named(market.volume_stats(prices)).orderBy(F.col("avg_volume").desc(), "ticker"),
        "volume_spikes": named(market.volume_spikes(prices)).orderBy(F.col("vol_ratio").desc(), "ticker", "date"),
        "correlations": correlations(prices, constituents, CORRELATION_PAIRS),
        "sector_stats": market.sector_stats(prices, constituents).orderBy(F.col("avg_daily_return").desc(), "sector"),
    }


def write_reports(reports: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    for name, report in reports.items():
        report.write.mode("overwrite").format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(f"{folder}/{name}")
