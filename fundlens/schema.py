"""Declared schemas of the four domain tables and of the files that feed them."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 2)
WEIGHT = T.DecimalType(18, 8)

CONSTITUENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("market_cap", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

PRICES = T.StructType([
    T.StructField("constituent_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("open_price", PRICE),
    T.StructField("high_price", PRICE),
    T.StructField("low_price", PRICE),
    T.StructField("close_price", PRICE),
    T.StructField("volume", T.LongType()),
])

ETF_UPLOADS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("uploaded_at", T.TimestampType()),
    T.StructField("total_weight", T.DecimalType(18, 8)),
    T.StructField("num_constituents", T.LongType()),
    T.StructField("is_active", T.BooleanType()),
])

ETF_HOLDINGS = T.StructType([
    T.StructField("etf_upload_id", T.LongType()),
    T.StructField("constituent_id", T.LongType()),
    T.StructField("weight", WEIGHT),
])

# The long OHLCV file: date,ticker,open,high,low,close,volume
OHLCV = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("open", PRICE),
    T.StructField("high", PRICE),
    T.StructField("low", PRICE),
    T.StructField("close", PRICE),
    T.StructField("volume", T.LongType()),
])

# Longest text each dimension column may hold.
CONSTITUENT_LENGTHS = {"ticker": 10, "name": 255, "sector": 100, "industry": 100, "market_cap": 20}
