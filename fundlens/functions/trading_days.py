"""The trading calendar: weekdays without a short list of month-day holidays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the calendar rule: (month, day) holidays of every year, and the
# two that move: the January one is on the 21st before 2020 and on the 20th from
# then on; the November one is on the 28th in 2019 and on the 26th otherwise.
FIXED_HOLIDAYS = ("01-01", "07-04", "12-25")
JANUARY_BEFORE_2020, JANUARY_FROM_2020 = "01-21", "01-20"
NOVEMBER_IN_2019, NOVEMBER_OTHERWISE = "11-28", "11-26"


def is_trading_day(day: Column) -> Column:
    month_day = F.date_format(day, "MM-dd")
    january = F.when(F.year(day) >= 2020, F.lit(JANUARY_FROM_2020)).otherwise(F.lit(JANUARY_BEFORE_2020))
    november = F.when(F.year(day) == 2019, F.lit(NOVEMBER_IN_2019)).otherwise(F.lit(NOVEMBER_OTHERWISE))
    holiday = month_day.isin(*FIXED_HOLIDAYS) | (month_day == january) | (month_day == november)
    return (F.weekday(day) < 5) & ~holiday


def trading_days(start: Column, end: Column) -> Column:
    """Array of trading days from start to end, both included; empty when end is before start."""
    days = F.filter(F.sequence(start, F.greatest(start, end)), is_trading_day)
    return F.when(end >= start, days).otherwise(F.array().cast("array<date>"))
