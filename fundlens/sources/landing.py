"""Landing files: daily price CSVs whose header may differ from file to file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.operators.joins import MAX_BROADCAST_ROWS
from fundlens.schema import OHLCV, PRICE
from fundlens.sources.files import cells, null_if_missing, text_lines

REQUIRED = ("date", "ticker", "close")


def price_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as text, header line included, because the columns are known per file only."""
    return text_lines(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv"), paths)


def _typed(texts: DataFrame, fault: Column) -> DataFrame:
    """Typed rows from the text columns _date, _ticker, _open, ...; a fault in the file or
    in the date becomes the row's `issue`."""
    def number(name: str, data_type: str) -> Column:
        return F.expr(f"try_cast(`_{name}` AS {data_type})").alias(name)

    date = F.expr("try_cast(_date AS DATE)")
    return texts.select(
        "file", "block", "row", date.alias("date"),
        F.col("_ticker").alias("ticker"),
        *[number(c, PRICE.simpleString()) for c in ("open", "high", "low", "close")],
        F.expr("CAST(try_cast(_volume AS DECIMAL(20,2)) AS BIGINT)").alias("volume"),
        fault.when(date.isNull(), "bad_date").alias("issue"),
    )


def parse_price_lines(lines: DataFrame, files: int | None = None) -> DataFrame:
    """Typed rows of price lines: file, block, row, date, ticker, OHLCV and `issue`.

    A header line is one that names all required columns. In a file without one the first
    line counts as header, and its rows are `missing_columns`; a date that is none is
    `bad_date`; a row with more fields than the header, other than empty ones, is
    `too_many_fields`. Optional columns may be absent and give NULL. `files` is an upper bound of the number of files, if
    known; up to MAX_BROADCAST_ROWS of them the headers are broadcast to the rows.
    """
    lines = lines.withColumns({"cells": cells(F.col("value")), "row": F.monotonically_increasing_id()})
    names = F.transform("cells", lambda c: F.lower(F.trim(c)))
    wanted = F.array(*[F.lit(c) for c in REQUIRED])
    is_header = F.size(F.array_intersect(names, wanted)) == len(REQUIRED)
    headers = lines.groupBy("file").agg(
        F.max(F.when(is_header, names)).alias("names"), F.min(F.struct("block", "row")).alias("first"))
    if files is not None and files <= MAX_BROADCAST_ROWS:
        headers = F.broadcast(headers)
    headless_header = F.col("names").isNull() & (F.struct("block", "row") == F.col("first"))
    body = lines.where(~is_header).join(headers, "file").where(~headless_header)

    def field(name: str) -> Column:
        at = F.array_position("names", F.lit(name)).cast("int")
        return null_if_missing(F.trim(F.try_element_at("cells", F.when(at > 0, at)))).alias(f"_{name}")

    spare = F.slice("cells", F.size("names") + 1, F.greatest(F.size("cells") - F.size("names"), F.lit(0)))
    long = F.exists(spare, lambda c: F.length(F.trim(c)) > 0)
    fault = F.when(F.col("names").isNull(), "missing_columns").when(long, "too_many_fields")
    texts = body.select("file", "block", "row", fault.alias("_fault"), *map(field, OHLCV.names))
    return _typed(texts, F.when(F.col("_fault").isNotNull(), F.col("_fault")))


def price_file_rows(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from price files that share one header, long or wide: columns by
    name in one scan, which is what a whole history wants."""
    raw = spark.read.option("header", True).csv(path)
    by_name = {c.strip().lower(): c for c in raw.columns}
    placed = raw.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    if "ticker" not in by_name:
        closes = [F.col(f"`{c}`") for c in raw.columns if c != by_name["date"]]
        placed = placed.unpivot(["file", "block", "row", by_name["date"]], closes, "ticker", "close").where("close IS NOT NULL")
        by_name = {"date": by_name["date"], "ticker": "ticker", "close": "close"}
    missing = [c for c in REQUIRED if c not in by_name]
    if missing:
        raise ValueError(f"price file lacks the columns {missing}")
    texts = [
        (null_if_missing(F.trim(F.col(f"`{by_name[c]}`"))) if c in by_name else F.lit(None).cast("string")).alias(f"_{c}")
        for c in OHLCV.names
    ]
    return _typed(placed.select("file", "block", "row", *texts), F.when(F.lit(False), ""))


# Order of two rows of one file, and of two rows of a set of files.
ARRIVAL = ["block", "row"]
ARRIVAL_OVER_FILES = ["file", *ARRIVAL]


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files below a folder, without reading them; empty if there is no folder. `file` names
    a file as rows read from it do, `path` is what a reader takes."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    try:
        return reader.load(folder).select(F.col("_metadata.file_path").alias("file"), "path", "length")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return spark.createDataFrame([], "file string, path string, length bigint")
        raise


def landing_files(listed: DataFrame, handled: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(file, state) of the files in the landing folder and of those a load has handled.

    `present`: those of the handled ones that have not been archived since.
    """
    done = handled.select("file").distinct()
    known = done if present is None else present.select("file").distinct()
    pending = listed.select("file").join(known, "file", "left_anti").withColumn("state", F.lit("pending"))
    return pending.unionByName(done.withColumn("state", F.lit("processed")))


def write_feed(days: DataFrame, folder: str) -> None:
    """Write long OHLCV rows as CSV, one sub-folder per day. Path order is date order."""
    named = days.withColumn("prices", F.col("date").cast("string"))
    named.repartitionByRange("prices", "ticker").write.mode("append").partitionBy("prices").option("header", True).csv(folder)
