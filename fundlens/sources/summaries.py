"""Summaries of the stored prices, kept beside them and merged in levels.

Each commit of prices adds a run: the summary of the rows of its load. FANOUT runs of one level
become one run of the next, so there are few runs at any time, and a row of a summary is written
again once per level. A run names the attempts it covers, and is in force as long as all of them
are; rows of attempts that no run covers (an older load was repeated) are summed up when they
are read, and the next commit of prices stores that.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from fundlens.operators.summaries import by_day, by_month, by_security, merge_days, merge_months, merge_securities
from fundlens.sources.commits import Attempt, Snapshot, snapshot
from fundlens.sources.tables import DAY_SUMMARIES, MONTH_SUMMARIES, SECURITY_SUMMARIES, read_attempts, write_folder

FANOUT = 8
KINDS = {
    SECURITY_SUMMARIES: (by_security, merge_securities),
    DAY_SUMMARIES: (by_day, merge_days),
    MONTH_SUMMARIES: (by_month, merge_months),
}


def _uncovered(at: Snapshot) -> list[Attempt]:
    covered = {c for run in at.attempts for c in run.covers}
    return [a for a in at.holding("prices") if a.attempt not in covered]


def _summary(spark: SparkSession, root: str, kind: str, runs: list[Attempt], rows: list[Attempt]) -> DataFrame:
    summarise, merge = KINDS[kind]
    parts = [read_attempts(spark, root, kind, runs).drop("load_id")] if runs or not rows else []
    if rows:
        parts.append(summarise(read_attempts(spark, root, "prices", rows)))
    return merge(reduce(DataFrame.unionByName, parts))


def _read(spark: SparkSession, root: str, kind: str, version: int | None, at: Snapshot | None) -> DataFrame:
    at = at or snapshot(spark, root, version)
    return _summary(spark, root, kind, [a for a in at.attempts if a.covers], _uncovered(at))


def security_summary(spark: SparkSession, root: str, version: int | None = None, at: Snapshot | None = None) -> DataFrame:
    """One row per security, as `operators.summaries.by_security` of all prices."""
    return _read(spark, root, SECURITY_SUMMARIES, version, at)


def day_summary(spark: SparkSession, root: str, version: int | None = None, at: Snapshot | None = None) -> DataFrame:
    """One row per day, as `operators.summaries.by_day` of all prices."""
    return _read(spark, root, DAY_SUMMARIES, version, at)


def month_summary(spark: SparkSession, root: str, version: int | None = None, at: Snapshot | None = None) -> DataFrame:
    """One row per security and month, as `operators.summaries.by_month` of all prices."""
    return _read(spark, root, MONTH_SUMMARIES, version, at)


def write_runs(spark: SparkSession, root: str, load_id: str, after: Snapshot) -> tuple[list[dict], list[str]]:
    """Store the run that a commit leading to `after` adds: the entry's runs, and those they replace."""
    fresh = _uncovered(after)
    if not fresh:
        return [], []
    of_level = lambda level: [a for a in after.attempts if a.covers and a.level == level]
    merged, level = [], 0
    while len(of_level(level)) + 1 >= FANOUT:
        merged += of_level(level)
        level += 1
    run = Attempt(load_id, uuid4().hex, tuple(KINDS), after.version, level,
                  tuple(a.attempt for a in fresh) + tuple(c for a in merged for c in a.covers))
    for kind in KINDS:
        write_folder(_summary(spark, root, kind, merged, fresh), root, kind, run)
    entry = {"load_id": load_id, "attempt": run.attempt, "level": level, "covers": list(run.covers), "tables": list(run.tables)}
    return [entry], [a.attempt for a in merged]


def without(at: Snapshot, load_id: str) -> Snapshot:
    """A snapshot without one load, and so without the runs that cover it."""
    kept = [a for a in at.attempts if a.covers or a.load_id != load_id]
    rows = {a.attempt for a in kept if not a.covers}
    return Snapshot(at.version, tuple(a for a in kept if set(a.covers) <= rows))
