"""Price, dimension, weight and landing files."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundlens.sources import files, landing, vendor

D = dt.date


def put(folder: Path, name: str, text: str | bytes) -> str:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_long_prices(spark, tmp_path):
    path = put(tmp_path, "prices.csv", "date,ticker,open,high,low,close,volume\n2026-01-01,AAPL,45.26,45.5,44.29,44.44,31164430\n")
    row = files.read_prices(spark, path).collect()[0]
    assert (row.date, row.ticker, float(row.close), row.volume) == (D(2026, 1, 1), "AAPL", 44.44, 31164430)


def test_wide_prices_become_long(spark, tmp_path):
    path = put(tmp_path, "prices.csv", "DATE,A,BRK.B\n2020-01-02,1.5,\n2020-01-03,1.6,2.25\n")
    rows = {(str(r.date), r.ticker, float(r.close)) for r in files.read_prices(spark, path).collect()}
    assert rows == {("2020-01-02", "A", 1.5), ("2020-01-03", "A", 1.6), ("2020-01-03", "BRK.B", 2.25)}


def test_absent_constituents(spark, tmp_path):
    assert files.read_constituents(spark, str(tmp_path / "constituents.csv")) is None
    path = put(tmp_path, "p.csv", "date,ticker,close\n2020-01-02,A,1\n2020-01-03,A,2\n2020-01-03,B,2\n")
    assert {r.ticker for r in files.tickers_of(files.read_prices(spark, path)).collect()} == {"A", "B"}


def weights(spark, folder, part=""):
    rows, headers = files.parse_weight_files(files.weight_files(spark, str(folder), part))
    return (
        {(r.file, r["name"], r.weight_text) for r in rows.collect()},
        {r.file: r.missing for r in headers.collect()},
    )


def test_weight_files_of_any_header(spark, tmp_path):
    put(tmp_path, "tech_etf.csv", "Ticker , WEIGHT\nAAPL,0.5\n\n\"MSFT\",0.5\n")
    put(tmp_path, "other_etf.csv", "weight,note,name\r\n0.25,\"a, b\",XOM\r\n,,\r\n")
    put(tmp_path, "bad_etf.csv", "foo,pct\nAAPL,0.5\n")
    put(tmp_path, "prices_etf.csv", "ticker,weight\nNO,1\n")
    put(tmp_path, "constituents.csv", "ticker,weight\nNO,1\n")
    rows, headers = weights(spark, tmp_path)
    assert rows == {
        ("tech_etf.csv", "AAPL", "0.5"), ("tech_etf.csv", "MSFT", "0.5"),
        ("other_etf.csv", "XOM", "0.25"), ("other_etf.csv", None, None),
    }
    assert headers == {"tech_etf.csv": [], "other_etf.csv": [], "bad_etf.csv": ["name", "weight"]}
    assert {f for f, _, _ in weights(spark, tmp_path, "tech")[0]} == {"tech_etf.csv"}


def test_file_level_rules(spark, tmp_path):
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "notes.txt", "ticker,weight\nA,1\n")
    put(tmp_path, "big.csv", b"x" * (1024 * 1024 + 1))
    put(tmp_path, "latin.csv", "ticker,weight\nÄ,1\n".encode("latin-1"))
    put(tmp_path, "good.csv", "ticker,weight\nA,1\n")
    named = files.uploaded_files(spark, str(tmp_path))
    found = {(r.file, r.rule) for r in files.file_issues(named).collect()}
    assert found == {
        ("empty.csv", "empty_file"), ("notes.txt", "not_csv"), ("big.csv", "file_too_large"), ("latin.csv", "not_utf8"),
    }
    typed = named.withColumn("content_type", F.when(F.col("file") == "good.csv", "image/png").otherwise("text/csv"))
    assert ("good.csv", "bad_content_type") in {(r.file, r.rule) for r in files.file_issues(typed).collect()}


def test_upload_rules_in_order(spark, tmp_path):
    from fundlens.plans.weight_check import check_weight_folder

    texts = {
        "ok.csv": "ticker,weight\nAAPL,0.30\nMSFT,0.25\nGOOGL,0.25\nAMZN,0.20\n",
        "case.csv": "Ticker,Weight\nAAPL,0.5\nMSFT,0.5\n",
        "warn.csv": "ticker,weight\nAAPL,0.50\nMSFT,0.20\n",
        "empty.csv": "",
        "columns.csv": "foo,pct\nAAPL,0.5\n",
        "header_only.csv": "ticker,weight\n",
        "negative.csv": "ticker,weight\nAAPL,-0.5\n",
        "percent.csv": "ticker,weight\nAAPL,50\n",
        "twice.csv": "ticker,weight\nAAPL,0.3\nAAPL,0.7\n",
        "unknown.csv": "ticker,weight\nZZZZZ,0.5\n",
        "zero.csv": "ticker,weight\nAAPL,0\nMSFT,0\n",
        "weights.txt": "ticker,weight\nAAPL,1\n",
    }
    for name, text in texts.items():
        put(tmp_path, name, text)
    universe = spark.createDataFrame([(t,) for t in ("AAPL", "MSFT", "GOOGL", "AMZN")], "ticker string")
    found = check_weight_folder(spark, str(tmp_path), universe).collect()
    assert {r.file: r.rule for r in found if r.is_first} == {
        "empty.csv": "empty_file", "columns.csv": "missing_columns", "header_only.csv": "no_rows", "negative.csv": "negative_weight",
        "percent.csv": "weight_over_one", "twice.csv": "duplicate_name", "unknown.csv": "unknown_ticker", "zero.csv": "all_zero",
        "weights.txt": "not_csv",
    }
    assert {(r.file, r.rule) for r in found if r.severity == "warning"} == {
        ("warn.csv", "sum_not_one"), ("unknown.csv", "sum_not_one"), ("percent.csv", "sum_not_one")}


def test_landing_files_are_read_by_header(spark, tmp_path):
    put(tmp_path, "a.csv", "date,ticker,open,high,low,close,volume\n2026-01-01,A,1,2,0.5,1.5,100.0\n2026-13-01,A,1,2,1,1,1\n")
    put(tmp_path, "b.csv", "close,ticker,date\n2.005,B,2026-01-02\nNaN,B,2026-01-03\n")
    put(tmp_path, "c.csv", "date,ticker,price\n2026-01-01,C,1\n")
    rows = landing.parse_price_lines(landing.price_lines(spark, str(tmp_path))).collect()
    got = {
        (r.file[-5:], str(r.date), r.ticker, None if r.close is None else str(r.close), r.volume, r.issue) for r in rows
    }
    assert got == {
        ("a.csv", "2026-01-01", "A", "1.50", 100, None),
        ("a.csv", "None", "A", "1.00", 1, "bad_date"),
        ("b.csv", "2026-01-02", "B", "2.01", None, None),
        ("b.csv", "2026-01-03", "B", None, None, None),
        ("c.csv", "None", None, None, None, "missing_columns"),
        ("c.csv", "None", None, None, None, "missing_columns"),
    }


def test_history_by_name(spark, tmp_path):
    put(tmp_path, "long.csv", "Ticker,date,close\nA,2020-01-02,1.005\nA,never,2\n")
    put(tmp_path, "wide.csv", "DATE,A,BRK.B\n2020-01-02,1.5,\n2020-01-03,1.6,2.25\n")
    put(tmp_path, "bad.csv", "ticker,price\nA,1\n")
    long = landing.price_file_rows(spark, str(tmp_path / "long.csv")).orderBy("row").collect()
    assert [(r.ticker, str(r.date), str(r.close), r.volume, r.issue) for r in long] == [
        ("A", "2020-01-02", "1.01", None, None), ("A", "None", "2.00", None, "bad_date")]
    wide = landing.price_file_rows(spark, str(tmp_path / "wide.csv")).collect()
    assert {(r.ticker, str(r.date), str(r.close)) for r in wide} == {
        ("A", "2020-01-02", "1.50"), ("A", "2020-01-03", "1.60"), ("BRK.B", "2020-01-03", "2.25")}
    with pytest.raises(ValueError, match="lacks"):
        landing.price_file_rows(spark, str(tmp_path / "bad.csv"))


def test_feed_round_trip(spark, tmp_path):
    path = put(tmp_path, "vendor.csv", "date,ticker,open,high,low,close,volume\n" + "".join(
        f"2026-01-0{d},{t},1,1,1,{d},{d}\n" for d in (1, 2, 5) for t in "ABC"
    ))
    bars = vendor.csv_provider(path)(spark, ["A", "B"], D(2026, 1, 2), D(2026, 1, 5))
    assert bars.count() == 4
    same = vendor.frame_provider(bars)(spark, spark.createDataFrame([("A",)], "ticker string"), D(2026, 1, 2), D(2026, 1, 2))
    assert [(r.ticker, str(r.date)) for r in same.collect()] == [("A", "2026-01-02")]
    folder = str(tmp_path / "incoming")
    landing.write_feed(bars, folder)
    back = landing.parse_price_lines(landing.price_lines(spark, folder))
    # The day is the folder of a feed file; the column stays in the file as well.
    assert {(str(r.date), r.ticker, r.issue) for r in back.collect()} == {
        ("2026-01-02", "A", None), ("2026-01-02", "B", None), ("2026-01-05", "A", None), ("2026-01-05", "B", None),
    }


def test_vendor_wide_to_long(spark):
    wide = spark.createDataFrame(
        [(D(2026, 1, 1), 1.0, 2.0, 0.5, 1.234, 10.0), (D(2026, 1, 2), 1.0, 2.0, 0.5, None, 10.0)],
        "Date date, A_Open double, A_High double, A_Low double, A_Close double, A_Volume double",
    )
    rows = vendor.vendor_wide_to_long(wide, ["A", "MISSING"]).collect()
    assert [(r.ticker, str(r.date), float(r.close), r.volume) for r in rows] == [("A", "2026-01-01", 1.23, 10)]


@pytest.mark.parametrize("n", [1, 2])
def test_listing(spark, tmp_path, n):
    for i in range(n):
        put(tmp_path, f"in/p{i}.csv", "x")
    listed = landing.list_files(spark, str(tmp_path / "in"))
    done = listed.limit(1)
    states = sorted(r.state for r in landing.landing_files(listed, done).collect())
    assert states == sorted(["processed"] + ["pending"] * (n - 1))
    assert landing.list_files(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("width", [18, 200])
def test_files_of_many_columns(spark, tmp_path, width):
    spare = [f"x{i}" for i in range(width - 3)]
    put(tmp_path, "in/p.csv", ",".join(["open", *spare, "volume", "close"]) + ",date,ticker\n"
        + ",".join(["1", *spare, "7", "2.5"]) + ",2026-01-01,A\n" + ",".join(["1", *spare, "7", "2.5"]) + ",2026-01-02,A,more\n"
        + ",".join(["1", *spare, "7", "2.5"]) + ",2026-01-03,A,,\n")
    rows = landing.parse_price_lines(landing.price_lines(spark, str(tmp_path / "in"))).orderBy("date").collect()
    assert [(str(r.date), str(r.close), r.volume, r.issue) for r in rows] == [
        ("2026-01-01", "2.50", 7, None), ("2026-01-02", "2.50", 7, "too_many_fields"), ("2026-01-03", "2.50", 7, None)]
    put(tmp_path, "w/wide_etf.csv", ",".join([*spare, "Ticker", "weight"]) + "\n" + ",".join([*spare, '"A, ""B"""', "0.5"]) + "\n")
    assert weights(spark, tmp_path / "w")[0] == {("wide_etf.csv", 'A, "B"', "0.5")}
    lines = files.weight_rows(files.weight_lines(spark, str(tmp_path / "w")))[0].collect()
    assert [(r["name"], r.weight_text) for r in lines] == [('A, "B"', "0.5")]
