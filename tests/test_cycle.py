"""Records of runs, the archive, and the whole cycle."""

import datetime as dt

import pytest

from fundlens.plans import cycle
from fundlens.plans import incremental_load as inc
from fundlens.sources import archive as archiving
from fundlens.sources.commits import snapshot
from fundlens.sources.loads import Load
from fundlens.sources.tables import read_table
from fundlens.sources.vendor import frame_provider
from test_load_jobs import FIRST, HEADER, LOADED, land, line, loaded_once, put, root, source, stored  # noqa: F401

D = dt.date


def history(spark, root):  # noqa: F811
    return [(r.load_id, r.kind, r.success, r.rows, (r.error or "").split(":")[0]) for r in cycle.run_history(spark, root).collect()]


def test_every_run_leaves_a_record(spark, root, tmp_path, monkeypatch):  # noqa: F811
    incoming = str(tmp_path / "incoming")
    land(tmp_path / "incoming")
    assert cycle.run_recorded(spark, root, incoming, "i1", dry_run=True).count() == 4
    write = Load.write

    def failing(self, df, table):
        if table == "files":
            raise OSError("disk full")
        write(self, df, table)

    monkeypatch.setattr(Load, "write", failing)
    with pytest.raises(OSError, match="disk full"):
        cycle.run_recorded(spark, root, incoming, "i1")
    monkeypatch.setattr(Load, "write", write)
    assert stored(spark, root) == FIRST
    assert cycle.run_recorded(spark, root, incoming, "i1").first().rows_inserted == 3
    assert cycle.run_recorded(spark, root, incoming, "i2").count() == 0  # nothing pending
    assert history(spark, root) == [
        ("i2", "incremental", True, 0, ""), ("i1", "incremental", True, 3, ""),
        ("i1", "incremental", False, 0, "OSError"), ("i1", "dry_run", True, 10, "")]
    assert [r[0] for r in history(spark, root)[:2]] == ["i2", "i1"] and cycle.run_history(spark, root, 1).count() == 1


def test_handled_files_are_archived_with_a_time(spark, root, tmp_path):  # noqa: F811
    folder, archive = tmp_path / "incoming", tmp_path / "archive"
    land(folder)
    put(folder / "zz 6", "more.csv", HEADER + line("2026-01-06", "AAPL", 1))  # all skipped
    cycle.run_recorded(spark, root, str(folder), "i1", archive=str(archive))
    assert stored(spark, root) == LOADED
    assert not list(folder.rglob("*.csv"))
    names = sorted(p.relative_to(archive).as_posix() for p in archive.rglob("*.csv"))
    stamp = inc.recent_runs(spark, root).first().finished_at.strftime("%Y%m%d_%H%M%S")
    assert names == sorted([f"prices_2026-01-0{d}__processed_{stamp}.csv" for d in (5, 6, 7, 8)] + [f"zz 6/more__processed_{stamp}.csv"])
    status = inc.ingest_status(spark, root, str(folder)).first()
    assert (status.pending_files, status.processed_files) == (0, 5)
    # a new file under an old name is another file
    put(folder, "prices_2026-01-05.csv", HEADER + line("2026-01-09", "AAPL", 16))
    assert inc.ingest_status(spark, root, str(folder)).first().pending_files == 1
    assert cycle.run_recorded(spark, root, str(folder), "i2", archive=str(archive)).first().rows_inserted == 1
    assert len(list(archive.rglob("prices_2026-01-05__*.csv"))) == 2 and not list(folder.rglob("*.csv"))


def test_an_interrupted_archive_is_finished(spark, root, tmp_path, monkeypatch):  # noqa: F811
    folder, archive = tmp_path / "incoming", tmp_path / "archive"
    land(folder)
    move, moved = archiving.move, []

    def dying(spark, file, target):
        if len(moved) == 2:
            raise KeyboardInterrupt
        moved.append(file)
        return move(spark, file, target)

    monkeypatch.setattr(archiving, "move", dying)
    with pytest.raises(KeyboardInterrupt):
        cycle.run_recorded(spark, root, str(folder), "i1", archive=str(archive))
    monkeypatch.setattr(archiving, "move", move)
    assert stored(spark, root) == LOADED and len(list(folder.rglob("*.csv"))) == 2
    assert read_table(spark, root, "archived").count() == 0
    (folder / "prices_2026-01-08.csv").unlink()  # someone else took one
    assert cycle.run_recorded(spark, root, str(folder), "i2", archive=str(archive)).count() == 0
    assert not list(folder.rglob("*.csv")) and len(list(archive.rglob("*.csv"))) == 3
    gone = {r.file.rsplit("/", 1)[1]: r.target is None for r in read_table(spark, root, "archived").collect()}
    assert gone == {f"prices_2026-01-0{d}.csv": d == 8 for d in (5, 6, 7, 8)}
    version = snapshot(spark, root).version
    assert archiving.archive_handled(spark, root, str(folder), str(archive)) == 0
    assert snapshot(spark, root).version == version


def test_a_cycle_fetches_lands_loads_and_archives(spark, root, tmp_path):  # noqa: F811
    days = [D(2026, 1, 2), D(2026, 1, 5), D(2026, 3, 20), D(2026, 3, 23)]
    bars = spark.createDataFrame(
        [(d, t, 1.0, 1.0, 1.0, 30.0 + i, 7) for i, d in enumerate(days) for t in ("AAPL", "XOM", "OTHER")],
        "date date, ticker string, open double, high double, low double, close double, volume long")
    asked = []

    def provider(spark, tickers, start, end):
        asked.append((start, end))
        return frame_provider(bars)(spark, tickers, start, end)

    args = (spark, root, str(tmp_path / "incoming"))
    archive = str(tmp_path / "archive")
    one = cycle.run_cycle(*args, "c1", provider, archive=archive, until=D(2026, 12, 31)).first()
    assert one.rows_inserted == 2 and asked == [(D(2026, 1, 3), D(2026, 1, 9))]
    asked.clear()
    two = cycle.run_cycle(*args, "c2", provider, n=2, archive=archive, until=D(2026, 12, 31)).first()
    assert two.rows_inserted == 4 and two.new_watermark == D(2026, 3, 23)
    spans = [(end - start).days for start, end in asked]
    assert len(asked) > 2 and spans[-1] < 2 * (D(2026, 3, 23) - D(2026, 1, 5)).days  # never asked for all history
    assert [r[:4] for r in history(spark, root)] == [("c2", "cycle", True, 4), ("c1", "cycle", True, 2)]
    assert len(list((tmp_path / "archive").rglob("*.csv"))) >= 3 and not list((tmp_path / "incoming").rglob("*.csv"))

    def broken(spark, tickers, start, end):
        raise ConnectionError("vendor down")

    with pytest.raises(ConnectionError):
        cycle.run_cycle(*args, "c3", broken)
    assert history(spark, root)[0] == ("c3", "cycle", False, 0, "ConnectionError")
    assert cycle.run_cycle(*args, "c4", provider, until=D(2026, 12, 31)).count() == 0  # no later day: nothing lands
