"""Windows over one security's or portfolio's daily series.

A price table holds one row per (key, date); the load operators enforce it, and
bars built from trades get it from an aggregation with map-side combine. So the
rows of one window group are bounded by the number of trading days, some 25,000
for a century, however large the table is and however many raw records one
security has. Nothing here may run over raw landing rows, which have no such bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(by: str, descending: bool = False) -> WindowSpec:
    return Window.partitionBy(by).orderBy(F.col("date").desc() if descending else F.col("date"))


def trailing_rows(by: str, n: int) -> WindowSpec:
    """The current row and the n - 1 rows before it; shorter at the start of a series."""
    return series_window(by).rowsBetween(-(n - 1), 0)


def last_rows(df: DataFrame, by: str, n: int) -> DataFrame:
    """The last n rows of every series. Spark trims each input partition to n rows
    per key before the shuffle (WindowGroupLimit)."""
    position = F.row_number().over(series_window(by, descending=True))
    return df.withColumn("_back", position).where(F.col("_back") <= n).drop("_back")


def newest_date(df: DataFrame) -> Column:
    """MAX(date) of a table as a scalar subquery, usable in any filter."""
    return df.agg(F.max("date")).scalar()


def check_range(name: str, value: int, low: int, high: int) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
