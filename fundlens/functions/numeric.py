"""Rounding and ratios with one fixed rule: half away from zero, NULL on zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int = 2) -> Column:
    """Round a number as DOUBLE, ties away from zero. The trailing + 0.0 turns -0.0 into 0.0."""
    scale = F.lit(float(10**digits))
    x = x.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale + F.lit(0.0)


def ratio(top: Column, bottom: Column) -> Column:
    """DOUBLE quotient, NULL where the denominator is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def pct_change(current: Column, previous: Column) -> Column:
    """Unrounded change in percent; the difference is taken in the input type, so exact for DECIMAL."""
    return ratio(current - previous, previous) * F.lit(100.0)


def mean_of(x: Column, over=None) -> Column:
    """Mean as exact SUM over COUNT, optionally over a window frame."""
    total, n = F.sum(x), F.count(x)
    if over is not None:
        total, n = total.over(over), n.over(over)
    return ratio(total, n)
