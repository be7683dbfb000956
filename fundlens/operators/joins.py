"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few numeric or short text columns; some 25 MB at the limit.
MAX_BROADCAST_ROWS = 250_000


def few_rows(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a frame has at most max_rows rows; counting stops at the limit."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a join side for broadcast if it has at most max_rows rows, else leave it
    to a shuffle join with Spark's runtime skew handling.

    For sides that are themselves joins: Spark estimates their size as the product
    of the inputs, plans to shuffle the large side, and finds out too late. A job
    marks its dimensions once and passes them to all of its operators.
    """
    return F.broadcast(df) if few_rows(df, max_rows) else df
