"""Plans and results that have to hold at any size: skew, shuffles, pruning, lost executors."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from fundlens.operators import load, market, quality
from fundlens.plans.catalog import QUERIES
from fundlens.plans.star_schema import Market

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Physical plans as on large data: no side is broadcast for its small file."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {name: plan(query(spark, SF)) for name, query in QUERIES.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return found


def test_no_cross_joins_and_no_python(plans):
    for name, text in plans.items():
        assert not re.search("CartesianProduct|NestedLoopJoin|PythonUDF|ArrowEval|InPandas", text), name


def test_windows_are_partitioned(plans):
    # The one exception is over the row counts of partitions, below the rank.
    for name, text in plans.items():
        for window in re.findall(r"\n[^\n]*\+?- Window \[[^\n]*", text):
            assert "_part" in window or re.search(r"\], \[[a-z_]+#\d+L?(, [a-z_]+#\d+L?)*\], \[", window), (name, window)


def test_one_shuffle_per_grouping(plans):
    for name in ("high_watermark", "dedup_last", "portfolio_headers"):
        assert len(re.findall("Exchange hash", plans[name])) == 1, name
    # Bars by (security, day), then one exchange for all windows of a query and what follows by security.
    for name in ("moving_average", "moving_averages_5_20", "daily_returns", "volume_spikes", "gap_report"):
        assert len(re.findall("Exchange hash", plans[name])) == 2, name


def test_groupings_combine_before_the_shuffle(plans):
    for name in ("scan_prices", "etf_series", "price_summary", "dedup_last", "sector_stats", "high_watermark", "landing_labels"):
        assert "partial_" in plans[name], name


def test_top_rows_are_cut_before_the_shuffle(plans):
    for name in ("top_holdings", "ohlcv_tail"):
        assert "WindowGroupLimit" in plans[name], name
    assert "TakeOrderedAndProject" in plans["volume_leaders"] and "TakeOrderedAndProject" in plans["active_portfolio"]


def test_scans_read_only_what_they_need(plans):
    columns = re.findall(r"lineitem.parquet\].*?ReadSchema: struct<([^>]*)>", plans["high_watermark"])
    assert columns and set(re.findall(r"(\w+):", columns[0])) == {"l_suppkey", "l_shipdate"}
    assert "l_tax" not in plans["etf_series"] and "l_discount" not in plans["etf_series"]


def test_prices_fact_is_not_shuffled_to_join_a_small_dimension(plans):
    text = plans["etf_series"]
    join = text[text.index("BroadcastHashJoin"):]
    assert text.index("BroadcastHashJoin") < text.index("SortMergeJoin") and "SortAggregate" in join


def test_filters_and_months_prune_stored_prices(spark, tmp_path):
    from fundlens.sources.loads import write_load
    from fundlens.sources.tables import read_loads

    write_load(Market(spark, SF).prices, str(tmp_path), "prices", "b1")
    stored = read_loads(spark, str(tmp_path), "prices")
    text = plan(stored.where("month >= '2001-06' AND constituent_id = 3").select("close_price"))
    assert re.search(r"PartitionFilters: \[[^\]]*month", text) and "EqualTo(constituent_id,3)" in text
    # A filter on the series key reaches the scan below the window.
    text = plan(market.moving_average(stored.drop("month", "load_id"), 5).where("constituent_id = 3"))
    assert "EqualTo(constituent_id,3)" in text


HOT = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A landing batch in which one ticker has a third of all rows, half of them on one day."""
    ids = spark.range(HOT * 3)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), (F.col("id") % 500).cast("string"))).alias("ticker"),
        F.when(hot & (F.col("id") % 2 == 0), F.lit(dt.date(2024, 1, 5)))
        .otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int"))).alias("date"),
        (F.col("id") % 97 + 1).cast("decimal(18,2)").alias("close"),
        (F.col("id") % 7).alias("file"),
        F.col("id").alias("n"),
    )


def test_skewed_landing(spark, skewed):
    watermarks = spark.createDataFrame([("HOT", dt.date(2024, 1, 2))], "ticker string, wm date")
    labelled = load.classify_landing(skewed, watermarks, arrival=["n"])
    got = {(r.ticker, r.date, r.n) for r in labelled.where("issue IS NULL").collect()}
    marks, want = {"HOT": dt.date(2024, 1, 2)}, {}
    rows = sorted(skewed.collect(), key=lambda r: (r.file, r.n))
    for file in range(7):
        fresh = [r for r in rows if r.file == file and (r.ticker not in marks or r.date > marks[r.ticker])]
        want.update({(r.ticker, r.date, file): r.n for r in fresh})
        for r in fresh:
            marks[r.ticker] = max(r.date, marks.get(r.ticker, r.date))
    assert got == {(t, d, n) for (t, d, _), n in want.items()}
    assert labelled.count() == HOT * 3


def test_hot_rows_shrink_before_they_travel(spark, skewed):
    """Shuffle records of the keyed steps follow keys and tasks, not the rows of the hot key."""
    tasks = skewed.rdd.getNumPartitions()
    last = quality.dedup_last(skewed, ["ticker", "date"], ["n"])
    assert last.count() == skewed.select("ticker", "date").distinct().count()
    text = plan(last)
    assert text.index("Exchange hash") < text.index("partial_max")  # the partial step is below the exchange
    verdicts = load.day_verdicts(skewed.withColumn("issue", F.lit(None).cast("string")),
                                 spark.createDataFrame([], "ticker string, wm date"), arrival=["n"])
    per_ticker = verdicts.groupBy("ticker").count().agg(F.max("count")).first()[0]
    assert per_ticker <= 20 * 7 and tasks >= 1


def test_newest_day_reaches_the_scan(plans):
    for name in ("latest_date_rows", "holdings", "holdings_total", "top_holdings", "sector_snapshot"):
        assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(l_shipdate", plans[name]), name
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(l_shipdate,2000", plans["feed_first_n_days"])


def test_a_portfolio_out_of_the_list_is_an_error(spark, monkeypatch):
    from fundlens.plans import catalog

    monkeypatch.setattr(catalog, "ETF_IDS", [1, 2, 3, 4, 5])
    for name in ("pivot_close", "wide_to_long", "vendor_wide_to_long"):
        with pytest.raises(Exception, match="not in ETF_IDS"):
            QUERIES[name](spark, SF).collect()
