"""Hand-worked small frames: ties, partial frames, gaps, zero prices, missing rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundlens.functions.display import format_percent, format_volume
from fundlens.functions.numeric import pct_change, ratio, round_half_away
from fundlens.functions.trading_days import trading_days
from fundlens.operators import load, market, monitor, portfolio, quality
from fundlens.operators.joins import small_side
from fundlens.operators.ranking import global_row_number

DAYS = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8, 9)]


def prices(spark, closes: dict[int, list], volumes: dict[int, list] | None = None):
    """Price table from closes per id; None leaves the day out."""
    rows = []
    for cid, values in closes.items():
        for i, close in enumerate(values):
            if close is not None:
                c = Decimal(str(close))
                rows.append((cid, DAYS[i], c, c, c, c, (volumes or {}).get(cid, [100] * 6)[i]))
    return spark.createDataFrame(rows, "constituent_id long, date date, open_price decimal(18,2), high_price decimal(18,2), "
                                 "low_price decimal(18,2), close_price decimal(18,2), volume long")


def constituents(spark, *rows):
    return spark.createDataFrame([(i, t, t.lower(), s, "ind") for i, t, s in rows], "id long, ticker string, name string, sector string, industry string")


def holdings(spark, *rows):
    return spark.createDataFrame([(e, c, Decimal(str(w))) for e, c, w in rows], "etf_upload_id long, constituent_id long, weight decimal(18,8)")


def values(df, *columns):
    plain = lambda v: float(v) if isinstance(v, Decimal) else str(v) if isinstance(v, dt.date) else v
    return sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)


def test_rounding_and_ratios(spark):
    df = spark.createDataFrame([(2.5, 0.0), (-2.5, 1.0), (0.125, 4.0), (-0.001, 1.0)], "x double, y double")
    got = [tuple(r) for r in df.select(round_half_away(F.col("x"), 0), round_half_away(F.col("x")), ratio(F.col("x"), F.col("y"))).collect()]
    assert got == [(3.0, 2.5, None), (-3.0, -2.5, -2.5), (0.0, 0.13, 0.03125), (0.0, 0.0, -0.001)]
    assert str(got[3][0]) == "0.0"
    one = spark.range(1).select(pct_change(F.lit(Decimal("110")), F.lit(Decimal("100"))).alias("p")).first()
    assert one.p == 10.0


def test_display(spark):
    df = spark.createDataFrame([(1_250_000,), (340_000,), (1_499,), (1_500,), (999,), (12_000_000,)], "v long")
    assert [r[0] for r in df.select(format_volume(F.col("v"))).collect()] == ["1.3M", "340K", "1K", "2K", "999", "12.0M"]
    assert spark.range(1).select(format_percent(F.lit(Decimal("0.1525")))).first()[0] == "15.25%"


def test_trading_days(spark):
    def days(a, b):
        return [str(d) for d in spark.range(1).select(trading_days(F.lit(a).cast("date"), F.lit(b).cast("date"))).first()[0]]

    assert days("2018-12-31", "2019-01-03") == ["2018-12-31", "2019-01-02", "2019-01-03"]
    assert "2019-01-21" not in days("2019-01-18", "2019-01-22") and "2020-01-20" not in days("2020-01-17", "2020-01-22")
    assert days("2019-11-28", "2019-11-29") == ["2019-11-29"] and days("2020-11-25", "2020-11-27") == ["2020-11-25", "2020-11-27"]
    assert days("2024-01-05", "2024-01-04") == []
    # Length of the reference history by the same rule.
    assert len(days("2019-01-02", "2025-12-31")) == 1801


def test_moving_average_and_returns(spark):
    p = prices(spark, {1: [10, 11, 0, 12], 2: [5]})
    got = values(market.moving_average(p, 3), "constituent_id", "date", "moving_avg", "daily_change", "daily_return_pct")
    assert got == [
        [1, "2024-01-02", 10.0, None, None], [1, "2024-01-03", 10.5, 1.0, 10.0],
        [1, "2024-01-04", 7.0, -11.0, -100.0], [1, "2024-01-05", 7.67, 12.0, None], [2, "2024-01-02", 5.0, None, None],
    ]
    wide = market.moving_averages(p, (2, 3))
    assert wide.columns[-2:] == ["ma_2", "ma_3"]
    for bad in (1, 51):
        with pytest.raises(ValueError, match="window"):
            market.moving_average(p, bad)


def test_volatility_takes_rounded_returns(spark):
    p = prices(spark, {1: [100, 101, 103], 2: [7], 3: [0, 5, 5]})
    got = values(market.volatility(p), "constituent_id", "volatility", "avg_daily_return", "worst_day_pct", "best_day_pct", "trading_days")
    # Returns 1.00 and 1.98; a single row gives nothing; a zero previous close gives no return but a row.
    assert got == [[1, 0.693, 1.49, 1.0, 1.98, 2], [3, None, 0.0, 0.0, 0.0, 1]]


def test_performance_ranking_breaks_ties_by_key(spark):
    p = prices(spark, {1: [10, 12], 2: [20, 24], 3: [1, 3], 4: [0, 1]})
    got = values(market.performance_ranking(p), "rank", "constituent_id", "total_return_pct")
    assert got == [[1, 3, 200.0], [2, 1, 20.0], [3, 2, 20.0], [4, 4, None]]


def test_global_row_number_over_equal_values(spark):
    df = spark.range(10_000).select((F.col("id") % 3 == 0).cast("int").alias("v"), F.col("id"))
    got = global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "n").orderBy("n").collect()
    want = sorted(((int(i % 3 == 0), i) for i in range(10_000)), key=lambda t: (-t[0], t[1]))
    assert [(r.v, r.id, r.n) for r in got] == [(v, i, n) for n, (v, i) in enumerate(want, start=1)]
    assert global_row_number(df.where("v > 5"), [F.col("id").asc()]).count() == 0


def test_volume_spikes_round_before_the_test(spark):
    # 20-row mean includes the day: 2.004 rounds to 2.00 and is no spike.
    p = prices(spark, {1: [10] * 3, 2: [10] * 3}, {1: [100, 100, 100_000], 2: [498, 498, 2004]})
    got = values(market.volume_spikes(p), "constituent_id", "date", "vol_ratio")
    assert got == [[1, "2024-01-04", 2.99]]
    leaders = market.volume_leaders(p, constituents(spark, (1, "A", "s"), (2, "B", "s")), 1).collect()
    assert [(r.ticker, r.avg_volume) for r in leaders] == [("A", 33400)]
    with pytest.raises(ValueError):
        market.volume_leaders(p, p, 51)


def test_sector_stats_pool_returns(spark):
    p = prices(spark, {1: [100, 110], 2: [100, 90], 3: [1, 2]})
    c = constituents(spark, (1, "A", "Tech"), (2, "B", "Tech"), (3, "C", "Oil"))
    got = values(market.sector_stats(p, c), "sector", "num_tickers", "avg_daily_return", "avg_volatility", "avg_daily_volume", "total_volume")
    assert got == [["Oil", 1, 100.0, None, 100.0, 100.0], ["Tech", 2, 0.0, 14.1421, 100.0, 200.0]]


def test_latest_is_global_but_state_is_own(spark):
    p = prices(spark, {1: [1, 2, 3], 2: [4, 5]})
    assert values(market.latest_date_rows(p), "constituent_id", "close_price") == [[1, 3.0]]
    assert values(market.latest_state(p), "constituent_id", "date", "close") == [[1, "2024-01-04", 3.0], [2, "2024-01-03", 5.0]]
    assert values(market.sector_snapshot(p, constituents(spark, (1, "A", "T"), (2, "B", "T"))), "sector", "ticker_count", "avg_price") == [["T", 1, 3.0]]
    assert values(market.ohlcv_tail(p, 1), "constituent_id", "close") == [[1, 3.0], [2, 5.0]]


def test_pairs(spark):
    p = prices(spark, {1: [1, 2, 3, 4], 2: [2, 4, None, 8], 3: [5, 5, 5, 5]})
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 9)], "key_a long, key_b long")
    assert values(market.paired_prices(p, pairs.where("key_b = 2")), "date", "price_a", "price_b") == [
        ["2024-01-02", 1.0, 2.0], ["2024-01-03", 2.0, 4.0], ["2024-01-05", 4.0, 8.0]]
    assert values(market.price_correlation(p, pairs), "key_a", "key_b", "common_days", "corr") == [[1, 2, 3, 1.0], [1, 3, 4, None]]


def test_tickers_by_name(spark):
    p = prices(spark, {1: [1, 2], 2: [3, 4]})
    c = constituents(spark, (1, "AAPL", "T"), (2, "XOM", "T"))
    assert values(market.only_ticker(p, c, " aapl"), "close_price") == [[1.0], [2.0]]
    assert market.only_ticker(p, c, "ZZZ").count() == 0
    found = market.pairs_of([("aapl", "XOM"), ("TSLA", "F")], c)
    assert values(found, "key_a", "key_b", "ticker_a") == [[1, 2, "AAPL"]]
    from fundlens.plans.reports import CORRELATION_PAIRS, correlations

    assert values(correlations(p, c, CORRELATION_PAIRS), "ticker_a", "ticker_b", "common_days", "corr") == [["AAPL", "XOM", 2, 1.0]]


def test_one_full_holding_reproduces_its_close(spark):
    p = prices(spark, {1: [10.05, 11.15, 12.25], 2: [5, None, 7]})
    h = holdings(spark, (1, 1, 1), (2, 1, 0.5), (2, 2, 0.5))
    series = portfolio.portfolio_series(p, h)
    assert values(series.where("etf_upload_id = 1"), "price") == [[10.05], [11.15], [12.25]]
    # Ties go away from zero: 0.5 * 10.05 + 0.5 * 5 = 7.525; a missing holding adds nothing.
    assert values(series.where("etf_upload_id = 2"), "date", "price") == [["2024-01-02", 7.53], ["2024-01-03", 5.58], ["2024-01-04", 9.63]]
    complete = portfolio.portfolio_series(p, h, require_complete=True)
    assert values(complete.where("etf_upload_id = 2"), "price") == [[7.53], [9.63], [None]]
    compare = portfolio.etf_compare(series, spark.createDataFrame([(1, "a"), (2, "b")], "id long, filename string"))
    assert values(compare, "id", "start_price", "end_price", "absolute_return", "return_pct", "performance") == [
        [1, 10.05, 12.25, 2.2, 21.89, "POSITIVE"], [2, 7.53, 9.63, 2.1, 27.89, "POSITIVE"]]


def test_compare_ignores_holdings_missing_at_the_ends(spark):
    p = prices(spark, {1: [10, 10, 10], 2: [None, 50, None]})
    series = portfolio.portfolio_series(p, holdings(spark, (1, 1, 1), (1, 2, 1)))
    row = portfolio.etf_compare(series, spark.createDataFrame([(1, "a")], "id long, filename string")).first()
    assert (float(row.start_price), float(row.end_price), row.performance) == (10.0, 10.0, "FLAT")


def test_best_and_worst_overlap(spark):
    series = portfolio.portfolio_series(prices(spark, {1: [100, 110, 99, 99]}), holdings(spark, (1, 1, 1)))
    got = values(portfolio.best_worst_days(series, 5), "side", "place", "return_pct")
    assert got == [["best", 1, 10.0], ["best", 2, 0.0], ["best", 3, -10.0], ["worst", 1, -10.0], ["worst", 2, 0.0], ["worst", 3, 10.0]]
    assert values(portfolio.best_worst_days(series, 1), "side", "return_pct") == [["best", 10.0], ["worst", -10.0]]
    with pytest.raises(ValueError):
        portfolio.best_worst_days(series, 21)
    change = portfolio.trailing_change(series, {"2D": 2, "ALL": None})
    assert values(change, "range", "days", "first_price", "last_price", "change", "pct_change", "is_positive") == [
        ["2D", 2, 99.0, 99.0, 0.0, 0.0, True], ["ALL", 4, 100.0, 99.0, -1.0, -1.0, False]]


def test_holdings_on_the_newest_date(spark):
    p = prices(spark, {1: [10, 20], 2: [30, 40], 3: [99]})
    c = constituents(spark, (1, "A", "Tech"), (2, "B", "Oil"), (3, "C", "Oil"))
    h = holdings(spark, (7, 1, 0.4), (7, 2, 0.2), (7, 3, 0.4))
    assert values(portfolio.latest_holdings(p, h, c), "name", "latest_price", "holding_value") == [["A", 20.0, 8.0], ["B", 40.0, 8.0]]
    kept = portfolio.latest_holdings(p, h, c, keep_missing=True)
    assert values(kept.where("name = 'C'"), "weight", "latest_price") == [[0.4, None]]
    assert values(portfolio.top_holdings(p, h, c, 1), "name", "rank") == [["A", 1]]  # equal values: by name
    ordered = portfolio.latest_holdings(p, h, c, sort="latest_price", ascending=False)
    assert [r["name"] for r in ordered.collect()] == ["B", "A"]
    spans = monitor.watermarks(p, c, sort="record_count")
    assert [r.ticker for r in spans.collect()] == ["C", "A", "B"]
    assert values(portfolio.holdings_total(p, h, c), "etf_upload_id", "num_holdings", "total_weight") == [[7, 2, 0.6]]
    exposure = portfolio.sector_exposure(h, c)
    assert values(exposure, "sector", "num_holdings", "total_weight", "weight_pct") == [["Oil", 2, 0.6, 60.0], ["Tech", 1, 0.4, 40.0]]
    assert portfolio.latest_holdings(p, h.where("etf_upload_id = 8"), c).count() == 0


def test_active_portfolio(spark):
    uploads = spark.createDataFrame([(1, "2024-01-01", True), (2, "2024-01-03", False), (3, "2024-01-02", True)], "id long, uploaded_at string, is_active boolean")
    assert [r.id for r in portfolio.active_portfolio(uploads).collect()] == [3]
    assert [r.id for r in portfolio.portfolio_list(uploads).collect()] == [2, 3, 1]
    assert [r.id for r in portfolio.portfolio_list(uploads, "id", ascending=True).collect()] == [1, 2, 3]


def test_quality_prices(spark):
    raw = spark.createDataFrame(
        [("A", "d1", 1.0, 2.0, 0.5, 1), ("A", "d1", 3.0, 2.0, 0.5, 2), ("A", "d2", None, 1.0, 1.0, 3), ("A", "d3", 0.0, 1.0, 0.0, 4), ("A", "d4", -1.0, 1.0, 1.0, 5)],
        "ticker string, date string, close double, high double, low double, n int",
    )
    labels = values(quality.quality_prices(raw, ["ticker", "date"], ["n"]), "n", "issue", "ohlc_mismatch")
    assert labels == [[1, "duplicate", False], [2, None, True], [3, "null_close", False], [4, None, False], [5, "negative_close", True]]
    strict = quality.label_price_rows(raw, allow_zero=False)
    assert values(strict.where("n > 3"), "n", "issue") == [[4, "non_positive_close"], [5, "non_positive_close"]]
    assert values(quality.accepted_prices(raw, ["ticker", "date"], ["n"]), "n") == [[2], [4]]
    assert values(quality.ohlc_report(raw, "low", "high", "close"), "n") == [[2], [5]]


def first_rules(spark, rows, known=("AAPL", "MSFT", "GOOGL", "AMZN")):
    df = spark.createDataFrame(rows, "file string, name string, weight_text string")
    universe = spark.createDataFrame([(t,) for t in known], "ticker string")
    found = quality.quality_weights(df, universe).collect()
    return {r.file: r.rule for r in found if r.is_first}, {(r.file, r.rule, r.severity) for r in found}


def test_weight_rules(spark):
    cases = {
        "ok": [("AAPL", ".30"), ("MSFT", ".25"), ("GOOGL", ".25"), ("AMZN", ".20")],
        "warns": [("AAPL", ".50"), ("MSFT", ".20")],
        "negative": [("AAPL", "-0.5")],
        "percent": [("AAPL", "50")],
        "twice": [("AAPL", ".3"), ("AAPL", ".7")],
        "unknown": [("ZZZZZ", "0.5")],
        "zero": [("AAPL", "0"), ("MSFT", "0")],
        "text": [("AAPL", "abc"), ("MSFT", None)],
        "nameless": [(None, "1"), (None, None)],
    }
    first, found = first_rules(spark, [(f, n, w) for f, rows in cases.items() for n, w in rows])
    assert first == {
        "negative": "negative_weight", "percent": "weight_over_one", "twice": "duplicate_name", "unknown": "unknown_ticker",
        "zero": "all_zero", "text": "null_weight", "nameless": "null_name",
    }
    assert {s for f, r, s in found if f == "warns"} == {"warning"} and not [f for f, _, _ in found if f == "ok"]
    assert ("text", "non_numeric_weight", "error") in found
    many = [("many", f"T{i}", "0.0005") for i in range(1001)]
    assert first_rules(spark, many, [f"T{i}" for i in range(1001)])[0] == {"many": "too_many_holdings"}
    empty = quality.quality_weights(
        spark.createDataFrame([], "file string, name string, weight_text string"), spark.createDataFrame([], "ticker string"),
        spark.createDataFrame([("empty",)], "file string"))
    assert [(r.file, r.rule, r.is_first) for r in empty.collect()] == [("empty", "no_rows", True)]


def test_constituent_issues(spark):
    rows = spark.createDataFrame([("A", "x"), (None, "x"), ("ELEVENCHARS", "x" * 300)], "ticker string, name string")
    assert values(quality.constituent_issues(rows), "issues") == [[["ticker_missing"]], [["ticker_too_long", "name_too_long"]]]


def test_gaps(spark):
    p = prices(spark, {1: [1, None, 1, None, None, 1], 2: [1]})
    assert values(quality.gap_report(p), "constituent_id", "date") == [[1, "2024-01-03"], [1, "2024-01-05"], [1, "2024-01-08"]]
    assert quality.trading_calendar(p).count() == 6


def landing(spark, rows):
    data = [(f, t, DAYS[d], None if c is None else Decimal(str(c)), n) for n, (f, t, d, c) in enumerate(rows)]
    return spark.createDataFrame(data, "file string, ticker string, date date, close decimal(18,2), n int")


def one_by_one(rows, watermarks):
    """The file loop, row by row: what admission has to equal."""
    marks, kept = dict(watermarks), []
    for file in sorted({r[0] for r in rows}):
        fresh = [(n, t, d) for n, (f, t, d, c) in enumerate(rows) if f == file and c is not None and c > 0 and (t not in marks or d > marks[t])]
        kept += [n for n, _, _ in fresh]
        for _, t, d in fresh:
            marks[t] = max(d, marks.get(t, -1))
    return sorted(kept), marks


def test_admission_equals_the_file_loop(spark):
    import random

    rng = random.Random(7)
    for _ in range(3):
        rows = [(f"f{rng.randrange(4)}", rng.choice("ABC"), rng.randrange(6), rng.choice([None, 0, -1, 5, 6, 7, 8])) for _ in range(60)]
        marks = {"A": 1, "B": 0}
        wm = spark.createDataFrame([(t, DAYS[d]) for t, d in marks.items()], "ticker string, wm date")
        kept, after = one_by_one(rows, marks)
        df = landing(spark, rows)
        assert sorted(r.n for r in load.admit_new_rows(df, wm).collect()) == kept
        labelled = load.classify_landing(df, wm, spark.createDataFrame([("A",), ("B",)], "ticker string"), arrival=["n"])
        assert labelled.count() == 60  # admitted plus dropped is the input
        s = load.incremental_summary(labelled, wm).first()
        assert s.rows_inserted + s.rows_dropped == 60 and s.new_watermark == DAYS[max(after.values())]
        inserted = labelled.where("issue IS NULL")
        assert inserted.select("ticker", "date").distinct().count() == inserted.count() == s.rows_inserted
        assert load.append_new(inserted, inserted, ["ticker", "date"]).count() == 0


def test_feed_days(spark):
    p = prices(spark, {1: [1, 2, 3, 4], 2: [1, None, 3, 4]})
    loaded = p.where("date <= '2024-01-02'")
    assert values(load.feed_first_n_days(p, loaded, 2), "constituent_id", "date") == [[1, "2024-01-03"], [1, "2024-01-04"], [2, "2024-01-04"]]
    late = loaded.withColumn("date", F.date_sub("date", 60))  # a gap longer than any day count
    assert values(load.feed_first_n_days(p, late, 1), "constituent_id", "date") == values(
        p.where(F.col("date") == p.agg(F.min("date")).scalar()), "constituent_id", "date")
    with pytest.raises(ValueError):
        load.feed_first_n_days(p, loaded, 0)


def test_upsert_last_write_wins(spark):
    old = constituents(spark, (1, "A", "Tech"), (2, "B", "Oil"))
    new = spark.createDataFrame([("A", "x", None, 1), ("A", "y", None, 2), ("D", "d", "S", 3), ("C", "c", "S", 4), (None, "n", "S", 5)],
                                "ticker string, name string, sector string, n int")
    assert values(load.upsert_constituents(old, new, ["n"]), "id", "ticker", "name", "sector") == [
        [1, "A", "y", None], [2, "B", "b", "Oil"], [3, "C", "c", "S"], [4, "D", "d", "S"]]


def test_load_portfolios(spark):
    rows = spark.createDataFrame(
        [("seen", "A", "1"), ("good", "A", "0.6"), ("good", "ZZ", "0.4"), ("twice", "A", "0.5"), ("twice", "A", "0.5"), ("text", "A", "x"), ("empty", "A", None), ("zz", "ZZ", "1")],
        "file string, name string, weight_text string")
    uploads = spark.createDataFrame([(4, "seen")], "id long, filename string")
    headers, held = load.load_portfolios(rows, constituents(spark, (1, "A", "s")), uploads)
    assert values(headers, "id", "filename", "total_weight", "num_constituents") == [[5, "good", 1.0, 2], [6, "zz", 1.0, 1]]
    assert values(held, "etf_upload_id", "constituent_id", "weight") == [[5, 1, 0.6]]


def test_monitoring(spark):
    p = prices(spark, {1: [1, 2, 3], 2: [4, 5]})
    c = constituents(spark, (1, "A", "T"), (2, "B", "T"))
    files = spark.createDataFrame([("f", "pending"), ("g", "processed")], "file string, state string")
    s = monitor.ingest_status(p, files).first()
    assert (s.pipeline_healthy, s.total_records, s.total_tickers, s.total_trading_days, s.lagging_tickers) == (False, 5, 2, 3, 1)
    assert values(monitor.lagging_tickers(p, c), "ticker", "latest_date") == [["B", "2024-01-03"]]
    assert values(monitor.watermarks(p, c), "ticker", "record_count") == [["A", 3], ["B", 2]]
    empty = monitor.ingest_status(p.where("false"), files.where("false")).first()
    assert (empty.pipeline_healthy, empty.total_records, empty.freshness_note) == (True, 0, "No data loaded yet.")
    stats = monitor.db_stats(c, p, files.where("false"), holdings(spark, (1, 1, 1))).first()
    assert (stats.total_constituents, stats.total_sectors, stats.total_price_records, stats.total_etf_uploads, stats.total_holdings, stats.trading_days) == (2, 1, 5, 0, 1, 3)


def test_small_side(spark):
    big = spark.range(100)
    hinted = big.join(small_side(spark.range(5), 10), "id")._jdf.queryExecution().optimizedPlan().toString()
    free = big.join(small_side(spark.range(11), 10), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in hinted or "broadcast" in hinted
    assert "broadcast" not in free
