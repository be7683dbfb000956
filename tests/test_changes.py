"""Backward reads and maintained results equal the full ones, and read only what they need."""

import random
import re
from decimal import Decimal

import pytest

from fundlens.operators import market, portfolio
from fundlens.plans import changes
from fundlens.sources.commits import snapshot
from fundlens.sources.loads import drop_all, write_load
from fundlens.sources.tables import read_table
from test_commits import prices, rows_of


@pytest.fixture(scope="module")
def holdings(spark):
    rows = [(1, 1, Decimal("0.5")), (1, 2, Decimal("0.25")), (2, 3, Decimal("1.0")), (3, 99, Decimal("1.0"))]
    return spark.createDataFrame(rows, "etf_upload_id long, constituent_id long, weight decimal(18,8)")


def months_read(df):
    """Months in the partition filters of the price scans."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"\d{4}-\d{2}(?!-\d)", " ".join(re.findall(r"PartitionFilters: \[[^\]]*\]", text))))


def test_newest_rows_are_read_backward(spark, tmp_path):
    root = str(tmp_path)
    rng = random.Random(1)
    days = {1: range(400), 2: [d for d in range(400) if rng.random() < 0.2], 3: range(100, 130), 4: [399]}
    rows = [(i, d, 5 + d % 7) for i, ds in days.items() for d in ds]
    rng.shuffle(rows)
    for k in range(3):
        write_load(prices(spark, rows[k::3]), root, "prices", f"l{k}")
    full = read_table(spark, root, "prices")
    for n in (1, 5, 60, 1000):
        assert rows_of(changes.newest_rows(spark, root, n)) == rows_of(market.last_rows(full, "constituent_id", n))
    few = changes.newest_rows(spark, root, 5)
    # February 2027 holds the newest rows of three securities; the third stopped in May 2026
    assert len(months_read(few)) <= 4 and "2026-05" in months_read(few)
    assert rows_of(changes.newest_rows(spark, root, 5, version=1)) == rows_of(
        market.last_rows(read_table(spark, root, "prices", version=1), "constituent_id", 5))
    drop_all(spark, root)
    assert changes.newest_rows(spark, root, 5).count() == 0


STEPS = [
    ("append", "l2", [(i, d, 9 + i) for i in (1, 2) for d in range(100, 103)]),
    ("late rows in the middle", "l3", [(1, 47, 77), (3, 10, 78)]),
    ("a new security", "l4", [(8, d, 3) for d in range(95, 99)]),
    ("a load repeated with other rows", "l2", [(1, 100, 50), (2, 104, 51)]),
    ("a load repeated with none", "l3", []),
]


def test_maintained_results_equal_full_ones(spark, tmp_path, holdings):
    """After each step from the version before, and at the end from every version."""
    root = str(tmp_path)
    write_load(prices(spark, [(i, d, 5 + (i * d) % 11) for i in (1, 2, 3, 4) for d in range(0, 100, 1 + i % 2)]), root, "prices", "l1")
    average = lambda df: market.moving_average(df, 5)
    returns = lambda df: market.daily_returns(df).select("constituent_id", "date", "daily_return")

    def check(since):
        keys = changes.changed_keys(spark, root, since)
        first = changes.first_changes(keys)
        was, now = read_table(spark, root, "prices", version=since), read_table(spark, root, "prices")
        for operator, back in ((average, 4), (returns, 1)):
            new = changes.recomputed_windows(spark, root, first, back, operator)
            assert rows_of(changes.maintained_windows(operator(was), new, first)) == rows_of(operator(now))
        points = changes.reached(keys, holdings)
        new = changes.recomputed_series(spark, root, points, holdings)
        old = portfolio.portfolio_series(was, holdings)
        assert rows_of(changes.maintained_series(old, new, points)) == rows_of(portfolio.portfolio_series(now, holdings))

    for _, load_id, rows in STEPS:
        since = snapshot(spark, root).version
        write_load(prices(spark, rows), root, "prices", load_id)
        check(since)
    for since in (1, 3, snapshot(spark, root).version):
        check(since)


def test_an_append_reads_the_newest_segments(spark, tmp_path, holdings):
    root = str(tmp_path)
    write_load(prices(spark, [(i, d, 5) for i in (1, 2) for d in range(395)]), root, "prices", "l1")
    write_load(prices(spark, [(1, 396, 6)]), root, "prices", "l2")
    keys = changes.changed_keys(spark, root, 1)
    new = changes.recomputed_windows(spark, root, changes.first_changes(keys), 19, lambda df: market.moving_averages(df, (5, 20)))
    assert months_read(new) <= {"2027-01", "2027-02"}
    assert [(r.constituent_id, r.date.isoformat()) for r in new.collect()] == [(1, "2027-02-01")]
    series = changes.recomputed_series(spark, root, changes.reached(keys, holdings), holdings)
    assert months_read(series) == {"2027-02"}
    assert [(r.etf_upload_id, float(r.price)) for r in series.collect()] == [(1, 3.0)]
