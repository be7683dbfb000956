"""Market operators: every security of the price table in one job.

`prices` has the columns of schema.PRICES. `by` names the series key, so a long
OHLCV frame keyed by ticker works too (see sources.files.as_price_table). Work
runs on the key alone; names and sectors are joined to the small results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.display import format_volume
from fundlens.functions.numeric import mean_of, pct_change, ratio, round_half_away
from fundlens.operators.ranking import global_row_number
from fundlens.operators.series import check_range, last_rows, newest_date, series_window, trailing_rows

KEY = "constituent_id"


def with_names(df: DataFrame, constituents: DataFrame, *columns: str, by: str = KEY) -> DataFrame:
    """Attach dimension columns. A dimension marked by joins.small_side is broadcast."""
    dim = constituents.select(F.col("id").alias(by), *columns)
    return df.join(dim, by)


def only_ticker(df: DataFrame, constituents: DataFrame, ticker: str, by: str = KEY) -> DataFrame:
    """Rows of one security, named in any case; none for an unknown ticker. Tickers are
    unique, so the broadcast side has at most one row."""
    chosen = constituents.where(F.col("ticker") == F.upper(F.trim(F.lit(ticker)))).select(F.col("id").alias(by))
    return df.join(F.broadcast(chosen.limit(1)), by, "left_semi")


def pairs_of(tickers: list[tuple[str, str]], constituents: DataFrame) -> DataFrame:
    """Pair list by key from ticker pairs; a pair with an unknown ticker is left out."""
    named = constituents.sparkSession.createDataFrame(
        [(a.upper(), b.upper()) for a, b in tickers], "ticker_a string, ticker_b string"
    )
    a = constituents.select(F.col("ticker").alias("ticker_a"), F.col("id").alias("key_a"))
    b = constituents.select(F.col("ticker").alias("ticker_b"), F.col("id").alias("key_b"))
    # The list is a driver-side literal and each ticker has one id.
    return F.broadcast(F.broadcast(named).join(a, "ticker_a")).join(b, "ticker_b")


def price_summary(prices: DataFrame, constituents: DataFrame) -> DataFrame:
    close = F.col("close_price")
    stats = prices.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("trading_days"),
        F.min(close).alias("low"),
        F.max(close).alias("high"),
        mean_of(close).alias("mean"),
        F.sum("volume").alias("volume_sum"),
        F.count("volume").alias("volume_n"),
    )
    spread = F.col("high") - F.col("low")
    return with_names(stats, constituents, "ticker", "name", "sector", "industry").select(
        "ticker",
        F.col("name").alias("company_name"),
        "sector",
        "industry",
        "trading_days",
        round_half_away(F.col("low")).alias("min_price"),
        round_half_away(F.col("high")).alias("max_price"),
        round_half_away(F.col("mean")).alias("avg_price"),
        round_half_away(spread).alias("price_range"),
        round_half_away(ratio(spread, F.col("low")) * 100).alias("range_pct"),
        _whole_mean("volume_sum", "volume_n").alias("avg_volume"),
    )


def _whole_mean(total: str, n: str):
    """Mean cut to a whole number, NULL for no values."""
    return F.try_divide(F.col(total), F.col(n)).cast("bigint")


def moving_average(prices: DataFrame, window: int = 5, by: str = KEY) -> DataFrame:
    check_range("window", window, 2, 50)
    close = F.col("close_price")
    previous = F.lag(close).over(series_window(by))
    return prices.select(
        by,
        "date",
        close.alias("price"),
        round_half_away(mean_of(close, trailing_rows(by, window))).alias("moving_avg"),
        round_half_away(close - previous).alias("daily_change"),
        round_half_away(pct_change(close, previous)).alias("daily_return_pct"),
    )


def moving_averages(prices: DataFrame, windows: tuple[int, ...] = (5, 20), by: str = KEY) -> DataFrame:
    """The price rows with one ma_<n> column per window length."""
    for n in windows:
        check_range("window", n, 2, 50)
    averages = [
        round_half_away(mean_of(F.col("close_price"), trailing_rows(by, n))).alias(f"ma_{n}") for n in windows
    ]
    return prices.select("*", *averages)


def _with_previous(prices: DataFrame, by: str) -> DataFrame:
    previous = F.lag("close_price").over(series_window(by))
    return prices.withColumn("prev_close", previous).where(F.col("prev_close").isNotNull())


def daily_returns(prices: DataFrame, by: str = KEY) -> DataFrame:
    change = pct_change(F.col("close_price"), F.col("prev_close"))
    return _with_previous(prices, by).withColumn("daily_return", round_half_away(change))


def volatility(prices: DataFrame, by: str = KEY) -> DataFrame:
    """Per-series statistics of the returns rounded to 2 places."""
    daily = F.col("daily_return")
    returns = daily_returns(prices.select(by, "date", "close_price"), by)
    return returns.groupBy(by).agg(
        round_half_away(F.stddev_samp(daily), 4).alias("volatility"),
        round_half_away(mean_of(daily.cast("decimal(18,2)")), 4).alias("avg_daily_return"),
        F.min(daily).alias("worst_day_pct"),
        F.max(daily).alias("best_day_pct"),
        F.count(daily).alias("trading_days"),
    )


def performance(prices: DataFrame, by: str = KEY) -> DataFrame:
    """First and last price per series and the total return, in one aggregation."""
    ends = prices.groupBy(by).agg(
        F.min_by("close_price", "date").alias("first_price"),
        F.max_by("close_price", "date").alias("last_price"),
    )
    total = pct_change(F.col("last_price"), F.col("first_price"))
    return ends.withColumn("total_return_pct", round_half_away(total))


def performance_ranking(prices: DataFrame, by: str = KEY) -> DataFrame:
    order = [F.col("total_return_pct").desc_nulls_last(), F.col(by).asc()]
    return global_row_number(performance(prices, by), order, "rank")


def volume_stats(prices: DataFrame, by: str = KEY) -> DataFrame:
    stats = prices.where(F.col("volume").isNotNull()).groupBy(by).agg(
        F.sum("volume").alias("_sum"),
        F.count("volume").alias("_n"),
        F.max("volume").alias("max_volume"),
        F.min("volume").alias("min_volume"),
    )
    return stats.select(by, _whole_mean("_sum", "_n").alias("avg_volume"), "max_volume", "min_volume")


def volume_leaders(prices: DataFrame, constituents: DataFrame, n: int = 10) -> DataFrame:
    check_range("n", n, 1, 50)
    named = with_names(volume_stats(prices), constituents, "ticker", "name", "sector")
    return (
        named.select(
            "ticker", F.col("name").alias("company_name"), "sector", "avg_volume", "max_volume", "min_volume"
        )
        .orderBy(F.col("avg_volume").desc(), "ticker")
        .limit(n)
    )


def volume_labels(prices: DataFrame, constituents: DataFrame) -> DataFrame:
    """Mean volume of every security with its short text, such as 1.2M or 340K."""
    named = with_names(volume_stats(prices), constituents, "ticker")
    return named.select("ticker", "avg_volume", format_volume(F.col("avg_volume")).alias("volume_label"))


def volume_spikes(prices: DataFrame, window: int = 20, threshold: float = 2.0, by: str = KEY) -> DataFrame:
    """Days whose volume is over `threshold` times the trailing mean, the day itself
    included. The ratio is rounded to 2 places before it is compared."""
    mean = mean_of(F.col("volume"), trailing_rows(by, window))
    return (
        prices.select("date", by, "volume", F.col("close_price").alias("close"), mean.alias(f"vol_ma_{window}"))
        .withColumn("vol_ratio", round_half_away(ratio(F.col("volume"), F.col(f"vol_ma_{window}"))))
        .where(F.col("vol_ratio") > threshold)
    )


def sector_stats(prices: DataFrame, constituents: DataFrame) -> DataFrame:
    """Pooled statistics of the unrounded returns of all securities of a sector."""
    rows = _with_previous(prices.select(KEY, "date", "close_price", "volume"), KEY)
    rows = rows.withColumn("r", pct_change(F.col("close_price"), F.col("prev_close")))
    # A sector's volume over all days can pass the BIGINT range; DECIMAL sums cannot here.
    volume = F.col("volume").cast("decimal(20,0)")
    return (
        with_names(rows, constituents, "sector")
        .groupBy("sector")
        .agg(
            F.countDistinct(KEY).alias("num_tickers"),
            round_half_away(F.avg("r"), 4).alias("avg_daily_return"),
            round_half_away(F.stddev_samp("r"), 4).alias("avg_volatility"),
            round_half_away(mean_of(volume), 0).alias("avg_daily_volume"),
            F.sum(volume).alias("total_volume"),
        )
    )


# In place of `dates`: the price frame holds no other date than the newest.
ONLY_NEWEST = "only newest"


def latest_date_rows(prices: DataFrame, dates: DataFrame | str | None = None) -> DataFrame:
    """Rows on the newest date of the whole table. `dates` may be any cheaper frame
    with the same MAX(date), such as the raw records the bars come from, or ONLY_NEWEST."""
    if isinstance(dates, str):
        return prices
    return prices.where(F.col("date") == newest_date(prices if dates is None else dates))


def sector_snapshot(prices: DataFrame, constituents: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    rows = with_names(latest_date_rows(prices, dates), constituents, "sector")
    return rows.groupBy("sector").agg(
        F.count(F.lit(1)).alias("ticker_count"),
        round_half_away(mean_of(F.col("close_price"))).alias("avg_price"),
    )


def latest_state(prices: DataFrame, by: str = KEY) -> DataFrame:
    """Each series' own last row: date, close and volume."""
    return prices.groupBy(by).agg(
        F.max("date").alias("date"),
        F.max_by("close_price", "date").alias("close"),
        F.max_by("volume", "date").alias("volume"),
    )


def ohlcv_tail(prices: DataFrame, limit: int = 60, by: str = KEY) -> DataFrame:
    """The last `limit` candles of every series."""
    check_range("limit", limit, 1, 500)
    return last_rows(prices, by, limit).select(
        by,
        "date",
        F.col("open_price").alias("open"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
        "volume",
    )


def paired_prices(prices: DataFrame, pairs: DataFrame, by: str = KEY) -> DataFrame:
    """Closes of both members of each given pair on their common dates.

    `pairs` has key_a and key_b. Each price row goes to the pairs its security is
    in, then the two sides of a (pair, date) meet in one group of two rows. One
    scan of the prices, and output in proportion to the pair list: no self join,
    no pairs that were not asked for.
    """
    pair = F.struct("key_a", "key_b")
    sides = pairs.select(
        "key_a", "key_b",
        F.explode(F.array(
            F.struct(F.col("key_a").alias(by), F.lit(True).alias("is_a")),
            F.struct(F.col("key_b").alias(by), F.lit(False).alias("is_a")),
        )).alias("side"),
    ).select("key_a", "key_b", "side.*")
    close = F.col("close_price")
    return (
        prices.select(by, "date", "close_price")
        .join(sides, by)
        .groupBy("key_a", "key_b", "date")
        .agg(
            F.max(F.when(F.col("is_a"), close)).alias("price_a"),
            F.max(F.when(~F.col("is_a"), close)).alias("price_b"),
        )
        .where(F.col("price_a").isNotNull() & F.col("price_b").isNotNull())
    )


def price_correlation(prices: DataFrame, pairs: DataFrame, by: str = KEY) -> DataFrame:
    """Pearson correlation of price levels for all given pairs in one aggregation.
    Pairs with no common date do not appear; a constant side gives NULL."""
    a, b = F.col("price_a").cast("double"), F.col("price_b").cast("double")
    corr = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return paired_prices(prices, pairs, by).groupBy("key_a", "key_b").agg(
        F.count(F.lit(1)).alias("common_days"), round_half_away(corr, 4).alias("corr")
    )


def pivot_close(rows: DataFrame, key: str, keys: list, value: str = "close_price") -> DataFrame:
    """One row per date, one column per listed key. The list is explicit, so Spark
    needs no pass to find the values and the width is the caller's choice."""
    return rows.groupBy("date").pivot(key, keys).agg(F.first(value))
