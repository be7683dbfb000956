"""Every operator as a named query over the whole star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.functions.display import format_percent
from fundlens.operators import load, market, monitor, packed, portfolio, quality, summaries
from fundlens.plans import changes
from fundlens.plans.star_schema import TRADE_ORDER, Market
from fundlens.sources.files import wide_to_long as unpivot_closes
from fundlens.sources.summaries import day_summary, security_summary
from fundlens.sources.tables import read_loads, read_table
from fundlens.sources.vendor import vendor_slice as slice_bars
from fundlens.sources.vendor import vendor_wide_to_long as unpivot_bars

ETF_IDS = [1, 2, 3, 4, 5, 6]
SLICE = ("1998-01-01", "1999-12-31")
FEED_LOADED_BEFORE = "2000-01-01"


def plain(df: DataFrame) -> DataFrame:
    """Report types: DECIMAL as DOUBLE and INT as BIGINT, as other tools read them."""
    def cast(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def _named(m: Market, df: DataFrame) -> DataFrame:
    """Replace the constituent id by the ticker."""
    return market.with_names(df, m.constituents, "ticker").drop("constituent_id")


# -- scans and reshaping -------------------------------------------------------

def scan_prices(m):
    return m.prices


def scan_constituents(m):
    return m.constituents


def scan_weights(m):
    return m.weight_rows.withColumn("weight", F.expr("try_cast(weight_text AS DECIMAL(18,8))"))


def _listed(rows: DataFrame) -> DataFrame:
    """Rows of portfolios in ETF_IDS; one of another portfolio, which a pivot over that list
    would lose, is an error when it is read."""
    known = F.col("etf_upload_id").isin(ETF_IDS)
    return rows.where(F.when(known, True).otherwise(F.raise_error(F.lit("a portfolio is not in ETF_IDS")).cast("boolean")))


def _wide_series(m):
    """The portfolios' series, not the securities': a handful of columns."""
    ids = _listed(m.series).withColumn("ticker", F.concat(F.lit("ETF"), F.col("etf_upload_id").cast("string")))
    return market.pivot_close(ids, "ticker", [f"ETF{i}" for i in ETF_IDS], "price")


def pivot_close(m):
    return _wide_series(m)


def wide_to_long(m):
    return unpivot_closes(_wide_series(m), "date")


def vendor_slice(m):
    """All bars of the securities of one region in two years."""
    tickers = m.constituents.where("industry = 'ASIA'").select(F.col("id").alias("constituent_id"))
    return slice_bars(m.prices, tickers, *SLICE, by="constituent_id")


def _composite_bars(m):
    bars = m.prices.join(_listed(m.holdings).select("etf_upload_id", "constituent_id"), "constituent_id")
    name = F.concat(F.lit("ETF"), F.col("etf_upload_id").cast("string")).alias("ticker")
    return bars.groupBy(name, "date").agg(
        F.min("open_price").alias("Open"), F.max("high_price").alias("High"), F.min("low_price").alias("Low"),
        F.max("close_price").alias("Close"), F.sum("volume").alias("Volume"),
    )


def vendor_wide_to_long(m):
    """Two-level wide frame of the portfolios' composite bars, back to long."""
    tickers = [f"ETF{i}" for i in ETF_IDS]
    fields = [F.first(f).alias(f) for f in ("Open", "High", "Low", "Close", "Volume")]
    return unpivot_bars(_composite_bars(m).groupBy("date").pivot("ticker", tickers).agg(*fields), tickers)


def feed_first_n_days(m):
    loaded = m.trades.where(F.col("date") < F.lit(FEED_LOADED_BEFORE).cast("date"))
    vendor = m.prices_from(F.lit(FEED_LOADED_BEFORE).cast("timestamp_ntz"))  # what is loaded ends before
    return load.feed_first_n_days(vendor, loaded, 5)


# -- portfolios ----------------------------------------------------------------

def etf_series(m):
    return m.series


def etf_series_complete(m):
    return portfolio.portfolio_series(m.prices, m.holdings, require_complete=True)


def holdings(m):
    return portfolio.latest_holdings(m.newest_prices, m.holdings, m.constituents, market.ONLY_NEWEST)


def holdings_total(m):
    return portfolio.holdings_total(m.newest_prices, m.holdings, m.constituents, market.ONLY_NEWEST)


def top_holdings(m):
    return portfolio.top_holdings(m.newest_prices, m.holdings, m.constituents, 5, market.ONLY_NEWEST)


def best_worst_days(m):
    return portfolio.best_worst_days(m.series, 5)


def etf_compare(m):
    return portfolio.etf_compare(m.series, m.uploads)


def sector_exposure(m):
    exposure = portfolio.sector_exposure(m.holdings, m.constituents)
    return exposure.withColumn("weight_label", format_percent(F.col("total_weight")))


def portfolio_list(m):
    return portfolio.portfolio_list(m.uploads).withColumn("uploaded_at", F.col("uploaded_at").cast("string"))


def active_portfolio(m):
    return portfolio.active_portfolio(m.uploads).withColumn("uploaded_at", F.col("uploaded_at").cast("string"))


def trailing_change(m):
    return portfolio.trailing_change(m.series)


# -- market --------------------------------------------------------------------

def price_summary(m):
    return market.price_summary(m.prices, m.constituents)


def moving_average(m):
    return market.moving_average(m.prices, 5)


def moving_averages_5_20(m):
    return market.moving_averages(m.prices.select("constituent_id", "date", "close_price"), (5, 20))


def daily_returns(m):
    return market.daily_returns(m.prices)


def volatility(m):
    return _named(m, market.volatility(m.prices))


def performance_ranking(m):
    return _named(m, market.performance_ranking(m.prices))


def volume_leaders(m):
    return market.volume_leaders(m.prices, m.constituents, 10)


def volume_spikes(m):
    return market.volume_spikes(m.prices)


def sector_stats(m):
    return market.sector_stats(m.prices, m.constituents)


def sector_snapshot(m):
    return market.sector_snapshot(m.newest_prices, m.constituents, market.ONLY_NEWEST)


def paired_prices(m):
    return market.paired_prices(m.prices, m.pairs)


def price_correlation(m):
    return market.price_correlation(m.prices, m.pairs)


def ohlcv_tail(m):
    return market.ohlcv_tail(m.prices, 60)


def latest_state(m):
    return _named(m, market.latest_state(m.prices))


def latest_date_rows(m):
    return market.latest_date_rows(m.newest_prices, market.ONLY_NEWEST)


def format_volume(m):
    return market.volume_labels(m.prices.withColumn("volume", F.col("volume") * 12_345), m.constituents)


# -- quality -------------------------------------------------------------------

def quality_prices(m):
    return quality.quality_prices(m.quotes, ["constituent_id", "date"], TRADE_ORDER)


def dedup_last(m):
    return quality.dedup_last(m.trades, ["constituent_id", "date"], TRADE_ORDER)


def ohlc_report(m):
    return quality.ohlc_report(m.quotes, "low", "high", "close")


def unknown_tickers(m):
    return quality.unknown_tickers(m.weight_rows.withColumnRenamed("name", "ticker"), m.constituents)


def quality_weights(m):
    return quality.quality_weights(m.weight_rows, m.constituents)


def trading_calendar(m):
    return quality.trading_calendar(m.trades)


def gap_report(m):
    return quality.gap_report(m.prices)


# -- load ----------------------------------------------------------------------

def high_watermark(m):
    return load.high_watermark(m.prices)


def admit_new_rows(m):
    return load.admit_new_rows(m.landing, m.tick_watermarks)


def landing_labels(m):
    return m.labelled_landing


def append_new(m):
    fresh = m.labelled_landing.where(F.col("issue").isNull()).drop("issue")
    return load.append_new(m.loaded_ticks, fresh, ["ticker", "date"])


def incremental_summary(m):
    return load.incremental_summary(m.labelled_landing, m.tick_watermarks)


def upsert_constituents(m):
    return load.upsert_constituents(m.constituents, m.incoming_constituents, ["c_custkey"])


def portfolio_headers(m):
    return load.portfolio_headers(m.weight_rows)


def load_portfolios(m):
    return load.load_portfolios(m.weight_rows, m.constituents, m.loaded_weight_files)[1]


# -- monitoring ----------------------------------------------------------------

def db_stats(m):
    return monitor.db_stats(m.constituents, m.prices, m.uploads, m.holdings)


def profile(m):
    return monitor.profile(m.prices)


def watermarks(m):
    return monitor.watermarks(m.prices, m.constituents)


def lagging_tickers(m):
    return monitor.lagging_tickers(m.prices, m.constituents, m.trades)


def landing_status(m):
    return monitor.landing_status(m.landing_files)


def ingest_status(m):
    return monitor.ingest_status(m.prices, m.landing_files)


# -- tables as loads commit them -----------------------------------------------

def rows_by_version(m):
    """What a reader of each version sees; version 2 holds the first run of a load that version 3 replaces."""
    parts = [
        read_table(m.spark, m.price_loads, "prices", version=v).agg(
            F.lit(v).cast("bigint").alias("version"), F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        for v in (1, 2, 3, 4)
    ]
    return reduce(DataFrame.unionByName, parts)


def rows_by_load(m):
    return read_loads(m.spark, m.price_loads, "prices").groupBy("load_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))


def kept_watermarks(m):
    return summaries.watermarks(security_summary(m.spark, m.price_loads), m.constituents)


def kept_lagging_tickers(m):
    return summaries.lagging_tickers(security_summary(m.spark, m.price_loads), m.constituents)


def kept_latest_state(m):
    return _named(m, summaries.latest_state(security_summary(m.spark, m.price_loads)))


def kept_ingest_status(m):
    return summaries.ingest_status(
        security_summary(m.spark, m.price_loads), day_summary(m.spark, m.price_loads), m.landing_files)


def possibly_stored(m):
    """Keys shifted by a week, as far as the summary of an older version cannot rule them out."""
    keys = m.prices.select("constituent_id", F.date_add("date", 7).alias("date"))
    return summaries.possibly_stored(keys, security_summary(m.spark, m.price_loads, version=2))


def newest_candles(m):
    return market.ohlcv_tail(changes.newest_rows(m.spark, m.price_loads, 60), 60)


def maintained_averages(m):
    """A moving average kept over commits: version 2's result, and what changed since."""
    average = lambda prices: market.moving_average(prices, 5)
    first = changes.first_changes(changes.changed_keys(m.spark, m.price_loads, 2))
    new = changes.recomputed_windows(m.spark, m.price_loads, first, 4, average)
    return changes.maintained_windows(average(read_table(m.spark, m.price_loads, "prices", version=2)), new, first)


def maintained_series(m):
    """Portfolio series kept over commits: version 2's result, and what changed since."""
    points = changes.reached(changes.changed_keys(m.spark, m.price_loads, 2), m.holdings)
    new = changes.recomputed_series(m.spark, m.price_loads, points, m.holdings)
    old = portfolio.portfolio_series(read_table(m.spark, m.price_loads, "prices", version=2), m.holdings)
    return changes.maintained_series(old, new, points)


def packed_correlation(m):
    return packed.price_correlation(m.prices, m.pairs, m.constituents.count())


_QUERIES = (
    scan_prices, scan_constituents, scan_weights, pivot_close, wide_to_long, vendor_slice, vendor_wide_to_long,
    feed_first_n_days,
    etf_series, etf_series_complete, holdings, holdings_total, top_holdings, best_worst_days, etf_compare, sector_exposure,
    portfolio_list, active_portfolio, trailing_change,
    price_summary, moving_average, moving_averages_5_20, daily_returns, volatility, performance_ranking,
    volume_leaders, volume_spikes, sector_stats, sector_snapshot, paired_prices, price_correlation, ohlcv_tail,
    latest_state, latest_date_rows, format_volume,
    quality_prices, dedup_last, ohlc_report, unknown_tickers, quality_weights, trading_calendar, gap_report,
    high_watermark, admit_new_rows, landing_labels, append_new, incremental_summary, upsert_constituents,
    portfolio_headers, load_portfolios,
    db_stats, profile, watermarks, lagging_tickers, landing_status, ingest_status,
    rows_by_version, rows_by_load, kept_watermarks, kept_lagging_tickers, kept_latest_state, kept_ingest_status,
    possibly_stored, packed_correlation, newest_candles, maintained_averages, maintained_series,
)


def _bind(build: Callable[[Market], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Market(spark, folder)))

    run.__name__ = build.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: _bind(q) for q in _QUERIES}
