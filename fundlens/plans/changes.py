"""Results that follow the commits of a price table instead of reading all of it again.

The months that hold a security's newest rows are known from the month summary, so the newest n
rows are read backward. What changed since a version is known from the log: rows of the attempts
that came, and of those that went. Windows are recomputed from each security's first change on,
with as many rows before it as a window looks back; portfolio series on the dates that changed.
Late rows and repeated loads are changes like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlens.operators.market import KEY
from fundlens.operators.portfolio import ETF, portfolio_series
from fundlens.operators.series import last_rows
from fundlens.session import stored
from fundlens.sources.commits import Snapshot, snapshot
from fundlens.sources.summaries import month_summary
from fundlens.sources.tables import SCHEMAS, read_attempts, read_loads

_COLUMNS = SCHEMAS["prices"].names


def month_of(date: str) -> Column:
    return F.date_format(date, "yyyy-MM")


def _rows_of_months(spark: SparkSession, root: str, at: Snapshot, wanted: DataFrame) -> DataFrame:
    """Stored prices of the wanted (constituent_id, month); no file of another month is read."""
    wanted = stored(wanted.select(KEY, "month"), "wanted")  # read for its months, and for the rows
    months = [r.month for r in wanted.select("month").distinct().collect()]  # as many as the table's months at most
    rows = read_loads(spark, root, "prices", at=at).where(F.col("month").isin(months))
    return rows.join(wanted, [KEY, "month"], "left_semi").select(*_COLUMNS)


def _months_back(months: DataFrame, n: int) -> DataFrame:
    """For each security, its newest months of (constituent_id, month, n), until they hold n rows."""
    newer = Window.partitionBy(KEY).orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1)
    return months.withColumn("_newer", F.coalesce(F.sum("n").over(newer), F.lit(0))).where(F.col("_newer") < n).drop("_newer")


def newest_rows(spark: SparkSession, root: str, n: int, version: int | None = None) -> DataFrame:
    """The last n price rows of every security, reading its newest months only."""
    at = snapshot(spark, root, version)
    return last_rows(_rows_of_months(spark, root, at, _months_back(month_summary(spark, root, at=at), n)), KEY, n)


def changed_keys(spark: SparkSession, root: str, since: int) -> DataFrame:
    """constituent_id and date of the rows that came or went since a version; keys may repeat."""
    old, now = snapshot(spark, root, since), snapshot(spark, root)
    before, after = ({a.attempt: a for a in at.holding("prices")} for at in (old, now))
    differ = [a for key, a in {**before, **after}.items() if (key in before) != (key in after)]
    return read_attempts(spark, root, "prices", differ).select(KEY, "date")


def first_changes(keys: DataFrame) -> DataFrame:
    """constituent_id and first, the first date that changed; stored, as it is read for old and for new rows."""
    return stored(keys.groupBy(KEY).agg(F.min("date").alias("first")), "first")


def recomputed_windows(spark: SparkSession, root: str, first: DataFrame, back: int, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """operator(prices) from each security's first change on.

    `operator` may look at `back` rows before a row of its security, and gives rows with the
    security and the date. Securities that did not change are not read.
    """
    at = snapshot(spark, root)
    months = month_summary(spark, root, at=at).join(first, KEY)
    from_change = months.where(F.col("month") >= month_of("first"))
    before = _months_back(months.where(F.col("month") < month_of("first")), back)
    rows = _rows_of_months(spark, root, at, from_change.unionByName(before))
    return operator(rows).join(first, KEY).where(F.col("date") >= F.col("first")).drop("first")


def maintained_windows(old: DataFrame, new: DataFrame, first: DataFrame) -> DataFrame:
    """A window result as it is now, from what it was and what was recomputed."""
    kept = old.join(first, KEY, "left").where(F.col("first").isNull() | (F.col("date") < F.col("first"))).drop("first")
    return kept.unionByName(new.select(*kept.columns))


def reached(keys: DataFrame, holdings: DataFrame) -> DataFrame:
    """etf_upload_id and date of the portfolio prices that changed rows go into; stored, as `first_changes`."""
    return stored(keys.distinct().join(holdings.select(ETF, KEY), KEY).select(ETF, "date").distinct(), "points")


def recomputed_series(spark: SparkSession, root: str, points: DataFrame, holdings: DataFrame) -> DataFrame:
    """portfolio_series on the given (etf_upload_id, date) only."""
    at = snapshot(spark, root)
    months = [r.month for r in points.select(month_of("date").alias("month")).distinct().collect()]
    rows = read_loads(spark, root, "prices", at=at).where(F.col("month").isin(months))
    rows = rows.join(points.select("date").distinct(), "date", "left_semi")
    return portfolio_series(rows, holdings).join(points, [ETF, "date"], "left_semi")


def maintained_series(old: DataFrame, new: DataFrame, points: DataFrame) -> DataFrame:
    """A portfolio series as it is now, from what it was and what was recomputed."""
    return old.join(points, [ETF, "date"], "left_anti").unionByName(new.select(*old.columns))

