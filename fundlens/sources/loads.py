"""Loads: rows of many tables that become visible together, or not at all."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from fundlens.sources import summaries
from fundlens.sources.commits import Attempt, Snapshot, commit, snapshot
from fundlens.sources.tables import SCHEMAS, read_attempts, read_table, write_folder


class Load:
    """One attempt of a load: reads the version it began on and its own rows, writes folders of
    its own, and commits all its tables in one step.

    A load that is not committed, because it failed or because another one committed first,
    changes nothing for any reader. `empties`: the commit also drops all loads before it.
    """

    def __init__(self, spark: SparkSession, root: str, load_id: str, empties: bool = False):
        self.spark, self.root, self.load_id, self.empties = spark, root, load_id, empties
        self.before = snapshot(spark, root)
        self.base = Snapshot(self.before.version) if empties else self.before
        self.attempt = uuid4().hex
        self.tables: list[str] = []

    def require_last(self) -> None:
        """Refuse a load id that does not sort last: snapshots are read at their greatest id."""
        newest = max((a.load_id for a in self.base.holding("constituents")), default=None)
        if newest is not None and newest > self.load_id:
            raise ValueError(f"load id {self.load_id!r} sorts before {newest!r}, which is stored already")

    def _mine(self) -> Attempt:
        return Attempt(self.load_id, self.attempt, tuple(self.tables), self.before.version + 1)

    def _others(self) -> Snapshot:
        return summaries.without(self.base, self.load_id)

    def _after(self) -> Snapshot:
        return Snapshot(self.base.version, (*self._others().attempts, self._mine()))

    def others(self, table: str) -> DataFrame:
        """The other loads of a table, with load_id (and month)."""
        return read_attempts(self.spark, self.root, table, self.base.holding(table, self.load_id))

    def read(self, table: str) -> DataFrame:
        """The table without this load, as its first run saw it."""
        return read_table(self.spark, self.root, table, self.load_id, at=self.base)

    def now(self, table: str) -> DataFrame:
        """The table as it will stand once this load is committed."""
        return read_table(self.spark, self.root, table, at=self._after())

    def securities(self) -> DataFrame:
        """The summary of the other loads' prices, one row per security."""
        return summaries.security_summary(self.spark, self.root, at=self._others())

    def own(self, table: str) -> DataFrame:
        """The rows this attempt has written."""
        return read_attempts(self.spark, self.root, table, [self._mine()]).select(*SCHEMAS[table].names)

    def write(self, df: DataFrame, table: str) -> None:
        write_folder(df, self.root, table, self._mine())
        self.tables.append(table)

    def write_and_read(self, df: DataFrame, table: str) -> DataFrame:
        """Write, and go on from the written rows: short lineage, columnar reads, and row numbers
        that no longer change."""
        self.write(df, table)
        return self.own(table)

    def commit(self) -> int:
        """Make all tables of the load visible; returns the new version."""
        runs, replaced = summaries.write_runs(self.spark, self.root, self.load_id, self._after())
        return commit(self.spark, self.root, self.before, self.load_id, self.attempt, self.tables, self.empties, runs, replaced)


def write_load(df: DataFrame, root: str, table: str, load_id: str) -> None:
    """A load of one table, committed at once."""
    load = Load(df.sparkSession, root, load_id)
    load.write(df, table)
    load.commit()


def drop_all(spark: SparkSession, root: str) -> None:
    """Empty every table, as a fresh load starts; earlier versions stay readable."""
    Load(spark, root, "", empties=True).commit()
