"""Loads are whole or absent, versions stay readable, and summaries equal full scans."""

import datetime as dt
import os
import shutil
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundlens.operators import market, monitor
from fundlens.plans import incremental_load as inc
from fundlens.sources import commits, summaries, tables
from fundlens.sources.commits import ConcurrentLoad, history, remove_abandoned, snapshot
from fundlens.sources.landing import landing_files, list_files
from fundlens.sources.loads import Load, drop_all, write_load
from fundlens.sources.tables import read_loads, read_table
from test_load_jobs import FIRST, LOADED, land, loaded_once, root, run_batch_load, source, stored  # noqa: F401


def prices(spark, rows):
    """Price rows from (security, day of 2026, close)."""
    one = [(i, dt.date(2026, 1, 1) + dt.timedelta(d), *([Decimal(c)] * 4), 100 * i + d) for i, d, c in rows]
    return spark.createDataFrame(one, "constituent_id long, date date, open_price decimal(18,2), high_price decimal(18,2), "
                                 "low_price decimal(18,2), close_price decimal(18,2), volume long")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def everything(spark, root, version=None):
    return {t: rows_of(read_table(spark, root, t, version=version)) for t in tables.SCHEMAS if t not in summaries.KINDS}


class Killed(Exception):
    pass


@pytest.mark.parametrize("job", ["batch", "incremental"])
def test_a_load_killed_after_any_write_is_unseen(spark, source, root, tmp_path, monkeypatch, job):  # noqa: F811
    incoming = tmp_path / "incoming"
    land(incoming)
    run = {"batch": lambda: run_batch_load(spark, source, root, "b2", fresh=True),
           "incremental": lambda: inc.run_incremental(spark, root, str(incoming), "i1")}[job]
    before, version = everything(spark, root), snapshot(spark, root).version
    write, kills = Load.write, 0

    def dying(self, df, table):
        write(self, df, table)
        if len(self.tables) > kills:
            raise Killed

    monkeypatch.setattr(Load, "write", dying)
    while True:
        try:
            run()
            break
        except Killed:
            kills += 1
            if kills in (1, 3, 6):
                assert everything(spark, root) == before
            assert snapshot(spark, root).version == version
    assert kills == {"batch": 7, "incremental": 6}[job]
    monkeypatch.setattr(Load, "write", write)
    monkeypatch.setattr("fundlens.sources.loads.commit", lambda *a: (_ for _ in ()).throw(Killed))
    with pytest.raises(Killed):  # all written, nothing committed
        inc.run_incremental(spark, root, str(incoming), "i1")
    assert snapshot(spark, root).version == version + 1
    assert stored(spark, root) == (LOADED if job == "incremental" else FIRST)
    assert everything(spark, root, version) == before


def test_a_second_writer_is_refused(spark, tmp_path):
    root = str(tmp_path)  # noqa: F811
    write_load(prices(spark, [(1, 0, 5)]), root, "prices", "a")
    one, two = Load(spark, root, "b"), Load(spark, root, "c")
    for load, day in ((one, 1), (two, 2)):
        load.write(prices(spark, [(1, day, 6)]), "prices")
    one.commit()
    with pytest.raises(ConcurrentLoad):
        two.commit()
    assert [r.date.day for r in read_table(spark, root, "prices").orderBy("date").collect()] == [1, 2]
    # the refused rows are found and removed once they are old enough, and only they
    assert remove_abandoned(spark, root, hours=1) == 0
    for path, _, _ in os.walk(tmp_path):
        os.utime(path, (time.time() - 7200,) * 2)
    assert remove_abandoned(spark, root, hours=1) >= 1
    assert read_table(spark, root, "prices").count() == 2
    again = Load(spark, root, "c")
    again.write(prices(spark, [(1, 2, 6)]), "prices")
    assert again.commit() == 3


def test_versions_stay_readable(spark, tmp_path, monkeypatch):
    """Also across stored states, repeated loads and emptied tables."""
    monkeypatch.setattr(commits, "STATE_EVERY", 3)
    root, want = str(tmp_path), {0: []}  # noqa: F811
    now: dict = {}
    for version, (load_id, days) in enumerate([("a", [0]), ("b", [1, 2]), ("a", [5]), (None, []), ("c", [7]), ("d", [8]), ("c", [9]), ("e", [10])], 1):
        if load_id is None:
            drop_all(spark, root)
            now = {}
        else:
            write_load(prices(spark, [(1, d, 5) for d in days]), root, "prices", load_id)
            now[load_id] = days
        want[version] = sorted(d for days in now.values() for d in days)
    first = dt.date(2026, 1, 1)
    for version, days in want.items():
        got = read_table(spark, root, "prices", version=version).select("date").collect()
        assert sorted((r.date - first).days for r in got) == days
        summed = summaries.day_summary(spark, root, version=version).select("date").collect()
        assert sorted((r.date - first).days for r in summed) == days
    assert sum(n.endswith(".state") for n in os.listdir(tmp_path / "_log")) == 2
    with pytest.raises(ValueError, match="no version 9"):
        read_table(spark, root, "prices", version=9)
    log = history(spark, root).collect()
    assert [r.version for r in log] == [8, 7, 6, 5, 4, 3, 2, 1] and [r.version for r in log if r.empties] == [4]
    assert {r.load_id for r in read_loads(spark, root, "prices", version=3).collect()} == {"a", "b"}


def test_summaries_equal_full_scans(spark, tmp_path, monkeypatch):
    """After every load, whatever is merged, repeated or emptied; the runs stay few."""
    monkeypatch.setattr(summaries, "FANOUT", 3)
    root = str(tmp_path)  # noqa: F811
    names = spark.createDataFrame([(i, f"T{i}", "S") for i in range(1, 6)], "id long, ticker string, sector string")
    days = {f"l{k:02d}": [(1 + (k + j) % 5, 10 * k + j, k + j) for j in range(4)] for k in range(11)}
    steps = [*days.items(), ("l03", [(2, 400, 7)]), ("l11", [(3, 500, 8)]), ("l12", []), ("l13", [(1, 501, 8)])]
    for n, (load_id, rows) in enumerate(steps, 1):
        write_load(prices(spark, rows), root, "prices", load_id)
        runs = [a for a in snapshot(spark, root).attempts if a.covers]
        assert len(runs) <= 2 * (n.bit_length() + 1)
        if n in (1, 5, 11, 12, 13, 14, 15):
            full = read_table(spark, root, "prices").cache()
            by_security = summaries.security_summary(spark, root).cache()
            from fundlens.operators import summaries as ops

            assert rows_of(ops.watermarks(by_security, names)) == rows_of(monitor.watermarks(full, names))
            assert rows_of(ops.lagging_tickers(by_security, names)) == rows_of(monitor.lagging_tickers(full, names))
            assert rows_of(ops.latest_state(by_security)) == rows_of(market.latest_state(full))
            files = spark.createDataFrame([("f", "pending")], "file string, state string")
            status = ops.ingest_status(by_security, summaries.day_summary(spark, root), files)
            assert rows_of(status) == rows_of(monitor.ingest_status(full, files))
    assert max(a.level for a in snapshot(spark, root).attempts if a.covers) >= 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_reads_no_price_row(spark, root, tmp_path):  # noqa: F811
    incoming = tmp_path / "incoming"
    land(incoming)
    inc.run_incremental(spark, root, str(incoming), "i1")
    for df in (inc.ingest_status(spark, root, str(incoming)), inc.ticker_spans(spark, root), inc.lagging_tickers(spark, root)):
        scans = [line for line in plan(df).splitlines() if "Location" in line]
        assert scans and all("/prices/" not in line for line in scans)
    full, names = read_table(spark, root, "prices"), read_table(spark, root, "constituents")
    assert rows_of(inc.ticker_spans(spark, root)) == rows_of(monitor.watermarks(full, names))
    assert [r.ticker for r in inc.lagging_tickers(spark, root).collect()] == ["XOM"]
    files = landing_files(list_files(spark, str(incoming)), read_table(spark, root, "files"))
    assert rows_of(inc.ingest_status(spark, root, str(incoming))) == rows_of(monitor.ingest_status(full, files))
    assert [r.ticker for r in inc.ticker_spans(spark, root, "latest_date", ascending=False).collect()] == ["AAPL", "XOM"]


def test_appends_look_only_where_keys_may_be(spark, tmp_path):
    root = str(tmp_path)  # noqa: F811
    write_load(prices(spark, [(i, d, 5) for i in (1, 2) for d in range(120)]), root, "prices", "a")
    load = Load(spark, root, "b")
    newer = prices(spark, [(1, 120, 6), (2, 300, 6), (3, 4, 6)])
    found = inc.stored_among(load, newer)
    assert found.count() == 0 and "Scan parquet" not in plan(found)
    mixed = newer.unionByName(prices(spark, [(2, 40, 6), (1, 70, 6)]))
    found = inc.stored_among(load, mixed)
    assert {r.month for r in found.select("month").distinct().collect()} == {"2026-02", "2026-03"}
    fresh = inc._not_loaded(load, mixed)
    assert sorted((r.constituent_id, r.date.timetuple().tm_yday - 1) for r in fresh.collect()) == [(1, 120), (2, 300), (3, 4)]
