"""Correlation on packed series equals the aggregation over price rows."""

import datetime as dt
import re

import numpy as np
import pytest

from fundlens.operators import market, packed


@pytest.fixture(scope="module")
def prices(spark):
    rng = np.random.default_rng(2)
    rows = []
    for key in range(40):
        for day in range(120):
            if rng.random() < 0.7:
                close = 5.0 if key == 3 else None if rng.random() < 0.05 else round(float(rng.normal(50, 9)), 2)
                rows.append((key, dt.date(2024, 1, 1) + dt.timedelta(day + (400 if key == 39 else 0)), close))
    return spark.createDataFrame(rows, "constituent_id long, date date, close_price double")


@pytest.mark.parametrize("securities", [40, 2000])
def test_equals_the_plain_correlation(spark, prices, securities):
    pairs = spark.createDataFrame([(a, b) for a in range(40) for b in range(40) if (a * 7 + b) % 3 == 0] + [(1, 999), (None, 2)],
                                  "key_a long, key_b long")
    want = sorted(map(tuple, market.price_correlation(prices, pairs).collect()))
    got = sorted(map(tuple, packed.price_correlation(prices, pairs, securities).collect()))
    assert len(got) > 400 and got == want
    assert any(r[3] is None for r in got)
    assert packed.price_correlation(prices, pairs.limit(0), 40).count() == 0
    assert packed.price_correlation(prices.limit(0), pairs, 40).count() == 0


def test_price_rows_meet_their_security_only(spark, prices):
    pairs = spark.createDataFrame([(a, b) for a in range(40) for b in range(a)], "key_a long, key_b long")
    plan = packed.price_correlation(prices, pairs, 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectList") + plan.count("collect_list") >= 2
    # the price rows' only exchange is the one of the packing; dates are no key of any other
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert keys and all("date" not in k and "day" not in k for k in keys)
