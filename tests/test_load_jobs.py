"""Batch load, incremental load and the stream, end to end on CSV files."""

import datetime as dt
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundlens.plans import incremental_load as inc
from fundlens.plans.batch_load import run_batch_load
from fundlens.plans.reports import market_reports, write_reports
from fundlens.sources.loads import Load, drop_all, write_load
from fundlens.sources.tables import read_loads, read_table
from fundlens.streaming.landing_stream import start_landing_stream

HEADER = "date,ticker,open,high,low,close,volume\n"


def put(folder: Path, name: str, text: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def line(day: str, ticker: str, close) -> str:
    return f"{day},{ticker},{close},{close},{close},{close},100\n"


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    put(folder, "constituents.csv", "ticker,name,sector,industry,market_cap\nAAPL,Apple,Tech,Phones,Large\nXOM,Exxon,Energy,Oil,Large\n")
    put(folder, "prices.csv", HEADER + line("2026-01-01", "AAPL", 10) + line("2026-01-01", "XOM", 20)
        + line("2026-01-02", "AAPL", 11) + line("2026-01-02", "AAPL", 12)  # the later copy wins
        + line("2026-01-02", "XOM", 0)  # zero is kept by the first load
        + line("2026-01-02", "ZZZ", 5)  # unknown
        + line("2026-01-01", "XOM", -1) + "2026-01-03,XOM,,,,,\n")
    put(folder, "tech_etf.csv", "ticker,weight\nAAPL,0.5\nZZZ,0.5\n")
    put(folder, "energy_etf.csv", "Name,Weight\nXOM,1.0\n")
    put(folder, "broken_etf.csv", "ticker,weight\nXOM,abc\n")
    put(folder, "headless_etf.csv", "foo,pct\nXOM,1\n")
    return str(folder)


@pytest.fixture(scope="module")
def loaded_once(spark, source, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("loaded") / "tables")
    return root, run_batch_load(spark, source, root, "b1").first()


@pytest.fixture
def root(loaded_once, tmp_path):
    """Tables after the first load, a copy for each test."""
    shutil.copytree(loaded_once[0], tmp_path / "tables")
    return str(tmp_path / "tables")


def stored(spark, root):
    ids = read_table(spark, root, "constituents").select(F.col("id").alias("constituent_id"), "ticker")
    rows = read_table(spark, root, "prices").join(ids, "constituent_id").collect()
    return sorted((r.ticker, str(r.date), float(r.close_price)) for r in rows)


FIRST = [("AAPL", "2026-01-01", 10.0), ("AAPL", "2026-01-02", 12.0), ("XOM", "2026-01-01", 20.0), ("XOM", "2026-01-02", 0.0)]


def test_batch_load(spark, source, loaded_once, root):
    stats = loaded_once[1]
    assert (stats.total_constituents, stats.total_price_records, stats.total_etf_uploads, stats.total_holdings) == (2, 4, 2, 2)
    assert stored(spark, root) == FIRST
    rejects = {(r.ticker, r.issue) for r in inc.rejected_rows(spark, root).collect()}
    assert rejects == {("AAPL", "duplicate"), ("XOM", "negative_close"), ("XOM", "null_close"), ("ZZZ", "unknown_ticker")}
    assert read_table(spark, root, "staged").count() == 4 + inc.rejected_rows(spark, root).count()
    issues = {(r.file, r.rule, r.rows) for r in read_table(spark, root, "file_issues").collect()}
    assert issues == {("broken_etf.csv", "broken_row", 1), ("headless_etf.csv", "missing_columns", 0)}
    uploads = {r.filename: (r.id, float(r.total_weight), r.num_constituents) for r in read_table(spark, root, "etf_uploads").collect()}
    assert uploads == {"energy_etf.csv": (1, 1.0, 1), "tech_etf.csv": (2, 1.0, 2)}
    assert {(r.etf_upload_id, float(r.weight)) for r in read_table(spark, root, "etf_holdings").collect()} == {(1, 1.0), (2, 0.5)}

    again = run_batch_load(spark, source, root, "b2").first()
    assert again == stats
    second = inc.rejected_rows(spark, root).where("load_id = 'b2'")
    assert second.count() == 8 and second.where("issue = 'already_loaded'").count() == 4
    with pytest.raises(ValueError, match="sorts before"):
        run_batch_load(spark, source, root, "b10")
    fresh = run_batch_load(spark, source, root, "b3", load_prices=False, etf_name="tech", fresh=True).first()
    assert (fresh.total_price_records, fresh.total_etf_uploads, fresh.total_holdings, fresh.latest_date) == (0, 1, 1, None)


def test_every_weight_file_is_accounted_for(spark, source, root, tmp_path):
    folder = tmp_path / "more"
    put(folder, "constituents.csv", "ticker,name\nAAPL,Apple\n")
    put(folder, "tech_etf.csv", "ticker,weight\nAAPL,0.5\n")  # loaded before
    put(folder, "new_etf.csv", "ticker,weight\nAAPL,0.5\n")
    put(folder, "big_etf.csv", "note,ticker,weight\n" + f"{'x' * 100},ZZZ,0.001\n" * 13_000 + ",AAPL,0.25\n")
    put(folder, "headless_etf.csv", "foo,pct\nAAPL,0.5\n")
    put(folder, "empty_etf.csv", "")
    put(folder, "header_etf.csv", "ticker,weight\n")
    put(folder, "twice_etf.csv", "ticker,weight\nAAPL,0.5\nAAPL,0.5\n")
    (folder / "latin_etf.csv").write_bytes("ticker,weight\nÄ,1\n".encode("latin-1"))
    run_batch_load(spark, str(folder), root, "b2", load_prices=False)
    uploads = {r.filename: r.num_constituents for r in read_table(spark, root, "etf_uploads").collect()}
    assert uploads == {"energy_etf.csv": 1, "tech_etf.csv": 1 + 1, "new_etf.csv": 1, "big_etf.csv": 13_001}
    issues = {r.file: r.rule for r in read_loads(spark, root, "file_issues").where("load_id = 'b2'").collect()}
    assert issues == {"tech_etf.csv": "already_loaded", "headless_etf.csv": "missing_columns", "empty_etf.csv": "empty_file",
                      "header_etf.csv": "no_rows", "twice_etf.csv": "broken_row", "latin_etf.csv": "not_utf8"}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_writes_replace_whatever_the_overwrite_mode(spark, root, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        days = spark.createDataFrame([(1, dt.date(2026, m, 1)) for m in (3, 4)], "constituent_id long, date date")
        for part in (days, days.where("month(date) = 4")):
            full = part.select("constituent_id", "date", *[F.lit(1).alias(c) for c in ("open_price", "high_price", "low_price", "close_price", "volume")])
            write_load(full, root, "prices", "r1")
        assert [str(r.date) for r in read_loads(spark, root, "prices").where("load_id = 'r1'").collect()] == ["2026-04-01"]
        drop_all(spark, root)
        assert read_table(spark, root, "prices").count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_batch_load_without_dimension(spark, source, tmp_path):
    shutil.copytree(source, tmp_path / "source")
    os.remove(tmp_path / "source" / "constituents.csv")
    stats = run_batch_load(spark, str(tmp_path / "source"), str(tmp_path / "t"), "b1").first()
    assert stats.total_constituents == 3  # tickers of the price file


LANDING = {
    # name: lines. The second file is partly older than the first, the fourth has no close column.
    "prices_2026-01-05.csv": HEADER + line("2026-01-05", "AAPL", 13) + line("2026-01-02", "AAPL", 99) + line("2026-01-05", "XOM", 21) + line("2026-01-05", "NEW", 1),
    "prices_2026-01-06.csv": HEADER + line("2026-01-04", "AAPL", 50) + line("2026-01-06", "AAPL", 14) + line("2026-01-06", "AAPL", 15) + line("2026-01-06", "XOM", 0),
    "prices_2026-01-07.csv": HEADER + line("2026-01-05", "AAPL", 13),
    "prices_2026-01-08.csv": "date,ticker,price\n2026-01-08,AAPL,1\n",
}
LOADED = sorted(FIRST + [("AAPL", "2026-01-05", 13.0), ("AAPL", "2026-01-06", 15.0), ("XOM", "2026-01-05", 21.0)])
ISSUES = {
    ("AAPL", "2026-01-02", "at_or_below_watermark"), ("AAPL", "2026-01-04", "at_or_below_watermark"),
    ("AAPL", "2026-01-05", "at_or_below_watermark"), ("AAPL", "2026-01-06", "duplicate"),
    ("XOM", "2026-01-06", "non_positive_close"), ("NEW", "2026-01-05", "unknown_ticker"), (None, "None", "missing_columns"),
}


def land(folder: Path, names=None):
    for i, (name, text) in enumerate(LANDING.items()):
        if names is None or name in names:
            put(folder, name, text)
            os.utime(folder / name, (1_800_000_000 + i, 1_800_000_000 + i))  # the stream reads in time order


def rejected(spark, root):
    loads = inc.rejected_rows(spark, root).where("load_id <> 'b1'")
    return {(r.ticker, str(r.date), r.issue) for r in loads.collect()}


def test_incremental_load(spark, root, tmp_path):
    incoming = tmp_path / "incoming"
    with pytest.raises(ValueError, match="full load first"):
        inc.run_incremental(spark, str(tmp_path / "nothing"), str(incoming), "i1")
    assert inc.run_incremental(spark, root, str(incoming), "i1").count() == 0
    land(incoming)
    preview = inc.run_incremental(spark, root, str(incoming), "i1", dry_run=True)
    assert sorted(r.rows for r in preview.collect()) == [1, 1, 4, 4]  # the first line of a file without a known header is its header
    assert stored(spark, root) == FIRST
    assert inc.ingest_status(spark, root, str(incoming)).first().pending_files == 4

    summary = inc.run_incremental(spark, root, str(incoming), "i1").first()
    assert (summary.files_processed, summary.files_skipped, summary.rows_inserted, summary.rows_dropped) == (2, 2, 3, 7)
    assert summary.new_watermark == dt.date(2026, 1, 6)
    assert stored(spark, root) == LOADED
    assert rejected(spark, root) == ISSUES
    # The same load again rewrites its own folders; another load finds nothing pending.
    inc.run_incremental(spark, root, str(incoming), "i1")
    assert stored(spark, root) == LOADED
    assert inc.run_incremental(spark, root, str(incoming), "i2").count() == 0
    status = inc.ingest_status(spark, root, str(incoming)).first()
    assert (status.pipeline_healthy, status.pending_files, status.processed_files, status.lagging_tickers) == (True, 0, 4, 1)
    assert inc.recent_runs(spark, root).count() == 1


def run_stream(spark, root, incoming, checkpoint, **options):
    query = start_landing_stream(spark, root, str(incoming), str(checkpoint), "feed", **options)
    assert query.awaitTermination(300)
    assert query.exception() is None


def test_stream_equals_batch_twin(spark, root, tmp_path):
    incoming, checkpoint = tmp_path / "incoming", tmp_path / "checkpoint"
    first = ["prices_2026-01-05.csv", "prices_2026-01-06.csv"]
    land(incoming, first)
    run_stream(spark, root, incoming, checkpoint)
    land(incoming)  # restart from the checkpoint sees the two new files only
    archive = tmp_path / "archive"
    run_stream(spark, root, incoming, checkpoint, archive=str(archive))
    assert list(archive.rglob("*.csv"))  # Spark moves a file when a later batch commits
    assert stored(spark, root) == LOADED
    assert rejected(spark, root) == ISSUES
    assert [r.load_id for r in inc.recent_runs(spark, root).collect()] == [f"feed-{i:012d}" for i in (3, 2, 1, 0)]
    run_stream(spark, root, incoming, checkpoint)
    assert inc.recent_runs(spark, root).count() == 4
    with pytest.raises(ValueError, match="another checkpoint"):
        start_landing_stream(spark, root, str(incoming), str(tmp_path / "other"), "feed")


def test_replayed_batch_changes_nothing(spark, root, tmp_path):
    from fundlens.sources.landing import parse_price_lines, price_lines
    from fundlens.streaming.landing_stream import batch_load_id, watermarks_before

    incoming = tmp_path / "incoming"
    land(incoming)
    for number in (0, 0, 1, 1):
        path = str(incoming / list(LANDING)[number])
        rows = parse_price_lines(price_lines(spark, path))
        load = Load(spark, root, batch_load_id("s", number))
        inc.load_rows(load, rows, watermarks_before(load, "s", number))
    assert stored(spark, root) == LOADED


def test_reports(spark, root, tmp_path):
    reports = market_reports(read_table(spark, root, "prices"), read_table(spark, root, "constituents"))
    write_reports(reports, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "performance_ranking"))
    assert [(r.ticker, r.total_return_pct, r["rank"]) for r in back.collect()] == [("AAPL", "20.0", "1"), ("XOM", "-100.0", "2")]
