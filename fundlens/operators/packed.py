"""Pairs of series, from one packed row per security.

A price row is sent once, to its security's packed row; packed rows then go to the blocks of
pairs they are in. Securities hash into blocks of bounded size, and a task gets the pairs of two
blocks with the series of both, so the shuffle grows with securities and pairs, not with price
rows times pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.numeric import round_half_away
from fundlens.operators.market import KEY

SECURITIES_PER_BLOCK = 256


def packed_closes(prices: DataFrame, by: str = KEY) -> DataFrame:
    """by, days (ascending day numbers) and closes of each series. A series has one row per
    day, so a packed row is bounded by the number of days; null closes are left out."""
    points = prices.where(F.col("close_price").isNotNull() & F.col("date").isNotNull()).select(
        by, F.unix_date("date").alias("day"), F.col("close_price").cast("double").alias("close"))
    rows = points.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("day", "close"))).alias("points"))
    return rows.select(by, F.col("points.day").alias("days"), F.col("points.close").alias("closes"))


def _correlation(x: np.ndarray, y: np.ndarray) -> float | None:
    if x.min() == x.max() or y.min() == y.max():
        return None
    dx, dy = x - x.mean(), y - y.mean()
    return float(dx @ dy) / (math.sqrt(float(dx @ dx)) * math.sqrt(float(dy @ dy)))


def _correlate(pairs: pa.Table, series: pa.Table) -> pa.Table:
    closes = {key: (np.asarray(days.values), np.asarray(values.values))
              for key, days, values in zip(series["key"].to_pylist(), series["days"], series["closes"])}
    out = []
    for a, b in zip(pairs["key_a"].to_pylist(), pairs["key_b"].to_pylist()):
        if a in closes and b in closes:
            (days_a, x), (days_b, y) = closes[a], closes[b]
            _, i, j = np.intersect1d(days_a, days_b, assume_unique=True, return_indices=True)
            if len(i):
                out.append((a, b, len(i), _correlation(x[i], y[j])))
    columns = list(zip(*out)) or [(), (), (), ()]
    kinds = [pairs.schema.field("key_a").type, pairs.schema.field("key_b").type, pa.int64(), pa.float64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["key_a", "key_b", "common_days", "raw"])


def price_correlation(prices: DataFrame, pairs: DataFrame, securities: int, by: str = KEY) -> DataFrame:
    """key_a, key_b, common_days, corr of all given pairs (key_a, key_b; each once), as
    market.price_correlation.

    `securities`: about how many there are; it decides the number of blocks, not the result.
    Pairs with no common day do not appear; a constant side gives NULL. Pairs with a null member
    do not appear either.
    """
    blocks = max(1, -(-securities // SECURITIES_PER_BLOCK))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    asked = pairs.where("key_a IS NOT NULL AND key_b IS NOT NULL").select(
        "key_a", "key_b", block("key_a").alias("block_a"), block("key_b").alias("block_b"))
    members = asked.select("block_a", "block_b", F.explode(F.array("key_a", "key_b")).alias("key")).distinct()
    series = packed_closes(prices, by).withColumnRenamed(by, "key").join(members, "key").select(
        F.col("block_a").alias("in_a"), F.col("block_b").alias("in_b"), "key", "days", "closes")
    kind = asked.schema["key_a"].dataType.simpleString()
    found = asked.groupBy("block_a", "block_b").cogroup(series.groupBy("in_a", "in_b")).applyInArrow(
        _correlate, f"key_a {kind}, key_b {kind}, common_days long, raw double")
    return found.select("key_a", "key_b", "common_days", round_half_away(F.col("raw"), 4).alias("corr"))
