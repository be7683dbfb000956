"""Portfolio operators: every portfolio in one job, narrowed by the caller's where().

Holdings and constituents that joins.small_side has marked are broadcast; unmarked
ones are left to Spark's own size estimate and its shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.numeric import pct_change, round_half_away
from fundlens.operators.market import latest_date_rows
from fundlens.operators.series import check_range, series_window

ETF = "etf_upload_id"

# Named chart ranges, in rows of the series; None is the whole series.
RANGES = {"1W": 7, "1M": 30, "3M": 90, "ALL": None}


def portfolio_series(prices: DataFrame, holdings: DataFrame, require_complete: bool = False) -> DataFrame:
    """price(t) = SUM(weight * close) in DECIMAL, rounded to 2 places; weights are not normalised.

    A holding without a price on a date does not contribute. With require_complete
    the series has every date of the price table, NULL where any holding is missing.
    """
    held = prices.select("constituent_id", "date", "close_price").join(
        holdings.select(ETF, "constituent_id", "weight"), "constituent_id"
    )
    series = held.groupBy(ETF, "date").agg(
        F.round(F.sum(F.col("weight") * F.col("close_price")), 2).cast("decimal(18,2)").alias("price"),
        F.count(F.lit(1)).alias("_present"),
    )
    if not require_complete:
        return series.drop("_present")
    # The calendar is one array of distinct dates, so it grows with the days and not with the rows.
    calendar = prices.select("date").distinct().agg(F.collect_set("date")).scalar()
    sizes = holdings.groupBy(ETF).agg(F.count(F.lit(1)).alias("_held"))
    grid = sizes.select(ETF, "_held", F.explode(calendar).alias("date"))
    return grid.join(series, [ETF, "date"], "left").select(
        ETF, "date", F.when(F.col("_present") == F.col("_held"), F.col("price")).alias("price")
    )


def _valued(prices, holdings, constituents, dates, keep_missing=False) -> DataFrame:
    newest = latest_date_rows(prices, dates)
    return (
        holdings.join(constituents.withColumnRenamed("id", "constituent_id"), "constituent_id")
        .join(newest, "constituent_id", "left" if keep_missing else "inner")
        .withColumn("value", F.col("weight") * F.col("close_price"))
    )


def latest_holdings(
    prices: DataFrame,
    holdings: DataFrame,
    constituents: DataFrame,
    dates: DataFrame | None = None,
    keep_missing: bool = False,
    sort: str | None = None,
    ascending: bool = True,
) -> DataFrame:
    """Holdings priced on the newest date of the whole table. Securities that did not
    trade then are left out, or kept with NULL prices under keep_missing. Rows are in no
    order unless one is asked for; ties then are by portfolio and name."""
    rows = _valued(prices, holdings, constituents, dates, keep_missing).select(
        ETF,
        F.col("ticker").alias("name"),
        F.col("name").alias("company_name"),
        "sector",
        "weight",
        F.col("close_price").alias("latest_price"),
        F.round("value", 2).cast("decimal(18,2)").alias("holding_value"),
        "volume",
        F.col("date").alias("price_date"),
    )
    return rows if sort is None else rows.orderBy(F.col(sort).asc() if ascending else F.col(sort).desc(), ETF, "name")


def holdings_total(
    prices: DataFrame, holdings: DataFrame, constituents: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Number and total weight of the rows of each portfolio's holdings view."""
    return _valued(prices, holdings, constituents, dates).groupBy(ETF).agg(
        F.count(F.lit(1)).alias("num_holdings"), F.sum("weight").alias("total_weight"))


def top_holdings(
    prices: DataFrame,
    holdings: DataFrame,
    constituents: DataFrame,
    n: int = 5,
    dates: DataFrame | None = None,
) -> DataFrame:
    """The n largest holdings of each portfolio by unrounded value, ties by name.
    The rank filter lets Spark keep n rows per portfolio before the shuffle."""
    check_range("n", n, 1, 50)
    by_value = Window.partitionBy(ETF).orderBy(F.col("value").desc(), "ticker")
    return (
        _valued(prices, holdings, constituents, dates)
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= n)
        .select(
            ETF,
            F.col("ticker").alias("name"),
            "weight",
            F.col("close_price").alias("latest_price"),
            F.round("value", 2).cast("decimal(18,2)").alias("holding_value"),
            "rank",
        )
    )


def best_worst_days(series: DataFrame, n: int = 5) -> DataFrame:
    """The n best and n worst days of each portfolio series, from its rounded prices.
    A portfolio with fewer than n returns shows all of them on both sides."""
    check_range("n", n, 1, 20)
    previous = F.lag("price").over(series_window(ETF))
    change = round_half_away(pct_change(F.col("price"), F.col("prev_price")))
    returns = (
        series.withColumn("prev_price", previous)
        .withColumn("return_pct", change)
        .where(F.col("return_pct").isNotNull())
    )
    best = Window.partitionBy(ETF).orderBy(F.col("return_pct").desc(), "date")
    worst = Window.partitionBy(ETF).orderBy(F.col("return_pct").asc(), "date")
    ranked = returns.withColumns({"_best": F.row_number().over(best), "_worst": F.row_number().over(worst)})
    places = F.array(
        F.struct(F.lit("best").alias("side"), F.col("_best").alias("place")),
        F.struct(F.lit("worst").alias("side"), F.col("_worst").alias("place")),
    )
    return (
        ranked.where((F.col("_best") <= n) | (F.col("_worst") <= n))
        .withColumn("at", F.explode(F.filter(places, lambda p: p["place"] <= n)))
        .select(ETF, "at.side", "at.place", "date", F.col("price").alias("etf_price"), "prev_price", "return_pct")
    )


def etf_compare(series: DataFrame, uploads: DataFrame) -> DataFrame:
    """First and last value of each portfolio. They are the ends of its series, so
    one aggregation replaces looking the dates up and joining back."""
    ends = series.groupBy(ETF).agg(
        F.min_by("price", "date").alias("start_price"), F.max_by("price", "date").alias("end_price")
    )
    start, end = F.col("start_price"), F.col("end_price")
    return ends.join(uploads.select(F.col("id").alias(ETF), "filename"), ETF).select(
        F.col(ETF).alias("id"),
        "filename",
        "start_price",
        "end_price",
        round_half_away(end - start).alias("absolute_return"),
        round_half_away(pct_change(end, start)).alias("return_pct"),
        F.when(end > start, "POSITIVE").when(end < start, "NEGATIVE").otherwise("FLAT").alias("performance"),
    )


def sector_exposure(holdings: DataFrame, constituents: DataFrame) -> DataFrame:
    weight = F.sum("weight")
    return (
        holdings.join(constituents.select(F.col("id").alias("constituent_id"), "sector"), "constituent_id")
        .groupBy(ETF, "sector")
        .agg(
            F.count(F.lit(1)).alias("num_holdings"),
            F.round(weight, 4).cast("decimal(18,4)").alias("total_weight"),
            F.round(weight * 100, 2).cast("decimal(18,2)").alias("weight_pct"),
        )
    )


def portfolio_list(uploads: DataFrame, sort: str = "uploaded_at", ascending: bool = False) -> DataFrame:
    """All portfolios, newest first unless another column or direction is asked for."""
    return uploads.orderBy(F.col(sort).asc() if ascending else F.col(sort).desc(), F.col("id").desc())


def active_portfolio(uploads: DataFrame) -> DataFrame:
    """The most recently uploaded active portfolio: one row, or none."""
    return uploads.where("is_active").orderBy(F.col("uploaded_at").desc(), F.col("id").desc()).limit(1)


def trailing_change(series: DataFrame, ranges: dict[str, int | None] = RANGES) -> DataFrame:
    """First and last price, change and direction over the last n rows, for each range."""
    back = F.row_number().over(series_window(ETF, descending=True))
    wanted = F.array(*[
        F.struct(F.lit(label).alias("range"), F.lit(n).cast("int").alias("days")) for label, n in ranges.items()
    ])
    inside = F.filter(wanted, lambda r: r["days"].isNull() | (F.col("_back") <= r["days"]))
    ends = (
        series.withColumn("_back", back)
        .select(ETF, "date", "price", F.explode(inside).alias("r"))
        .groupBy(ETF, F.col("r.range").alias("range"))
        .agg(
            F.min_by("price", "date").alias("first_price"),
            F.max_by("price", "date").alias("last_price"),
            F.count(F.lit(1)).alias("days"),
        )
    )
    first, last = F.col("first_price"), F.col("last_price")
    pct = F.when(first > 0, pct_change(last, first)).otherwise(F.lit(0.0))
    return ends.select(
        ETF, "range", "days", "first_price", "last_price",
        round_half_away(last - first).alias("change"),
        round_half_away(pct).alias("pct_change"),
        (last >= first).alias("is_positive"),
    )
