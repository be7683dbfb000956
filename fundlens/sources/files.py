"""Readers of price, dimension and weight files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens import schema

# Texts that stand for a missing value in the CSV files (fixed values).
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Upload limits of a weight file (fixed values).
MAX_WEIGHT_FILE_BYTES = 1024 * 1024
WEIGHT_CONTENT_TYPES = ("text/csv", "application/csv", "application/vnd.ms-excel", "text/plain")

# A comma and the field after it; a quoted field may hold commas and doubled quotes.
_FIELD = r',("(?:[^"]++|"")*+"|[^,]*)'


def cells(line: Column) -> Column:
    """The fields of a CSV line, any number of them. An empty line is one empty field."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    inner = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(fields, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), inner(c)).otherwise(c))


def text_lines(reader, paths) -> DataFrame:
    """Non-empty lines of text files: value, valid (the bytes are UTF-8), file (its path), and
    block, the offset of the part of the file that was read together. `reader` is a batch or
    streaming reader with its options set.
    """
    lines = reader.format("text").load(paths)
    return lines.where(F.length(F.trim("value")) > 0).select(
        F.regexp_replace("value", "^\\x{FEFF}", "").alias("value"), F.is_valid_utf8("value").alias("valid"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def null_if_missing(text: Column) -> Column:
    return F.when(~F.trim(text).isin(*MISSING_TEXTS), text)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Long or wide price CSV, always returned long.

    A header with `ticker` is the long form. Otherwise the file is DATE plus one
    column of closes per ticker, and is unpivoted without its empty cells.
    """
    raw = spark.read.option("header", True).csv(path)
    if "ticker" in raw.columns:
        typed = [
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in raw.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.OHLCV
        ]
        return raw.select(*typed)
    return wide_to_long(raw)


def wide_to_long(wide: DataFrame, date_column: str = "DATE") -> DataFrame:
    tickers = [c for c in wide.columns if c != date_column]
    closes = wide.select(
        F.col(date_column).cast("date").alias("date"), *[F.col(f"`{t}`").cast(schema.PRICE).alias(t) for t in tickers]
    )
    return closes.unpivot(["date"], [F.col(f"`{t}`") for t in tickers], "ticker", "close").where(F.col("close").isNotNull())


def as_price_table(long: DataFrame, constituents: DataFrame | None = None) -> DataFrame:
    """Long OHLCV frame to price-table columns, keyed by ticker or, with a dimension,
    by constituent id (rows of unknown tickers drop out of that join)."""
    renamed = {c: f"{c}_price" for c in ("open", "high", "low", "close") if c in long.columns}
    table = long.withColumnsRenamed(renamed)
    if constituents is None:
        return table
    ids = constituents.select("ticker", F.col("id").alias("constituent_id"))
    return table.join(ids, "ticker").select(*[f.name for f in schema.PRICES if f.name in table.columns + ["constituent_id"]])


def read_constituents(spark: SparkSession, path: str) -> DataFrame | None:
    """Dimension CSV with the file and block of each row, or None where there is none; the
    caller then uses tickers_of(prices)."""
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise
    columns = ["ticker", "name", "sector", "industry", "market_cap"]
    return raw.select(
        *[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns],
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def tickers_of(prices: DataFrame) -> DataFrame:
    empty = [F.lit(None).cast("string").alias(c) for c in ("name", "sector", "industry", "market_cap")]
    return prices.select("ticker").distinct().select("ticker", *empty)


def weight_files(spark: SparkSession, path: str, name_part: str = "") -> DataFrame:
    """Weight files below a folder, found by name: *<part>*etf*.csv without price and
    constituent files. Only files within the size limit have their content read."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{name_part}*etf*.csv")
        .load(path)
        .withColumn("file", F.element_at(F.split("path", "/"), -1))
    )
    lower = F.lower("file")
    return listed.where(~lower.contains("prices") & ~lower.contains("constituents"))


def uploaded_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """All files of an upload folder as binaryFile rows. Spark leaves empty files out of
    a scan but not out of its file list, from which they are added with length 0."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    names = spark.createDataFrame([(f,) for f in listed.inputFiles()], "url string")
    last = F.replace(F.element_at(F.split("url", "/"), -1), F.lit("+"), F.lit("%2B"))
    every = names.select(F.url_decode(last).alias("file"))
    found = listed.withColumn("file", F.element_at(F.split("path", "/"), -1))
    return every.join(found, "file", "left").withColumn("length", F.coalesce("length", F.lit(0)))


def file_issues(files: DataFrame) -> DataFrame:
    """Files that break a file-level rule, one row per rule. `files` is a binaryFile
    listing with a file name, and may have a content_type."""
    size = F.col("length")
    rules = [
        F.when(~F.lower("file").endswith(".csv"), F.lit("not_csv")),
        F.when(size == 0, F.lit("empty_file")),
        F.when(size > MAX_WEIGHT_FILE_BYTES, F.lit("file_too_large")),
        F.when((size <= MAX_WEIGHT_FILE_BYTES) & ~F.is_valid_utf8(F.col("content")), F.lit("not_utf8")),
    ]
    if "content_type" in files.columns:
        known = F.col("content_type").isin(*WEIGHT_CONTENT_TYPES)
        rules.append(F.when(F.col("content_type").isNotNull() & ~known, F.lit("bad_content_type")))
    return files.select("file", F.explode(F.array_compact(F.array(*rules))).alias("rule"))


def parse_weight_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`weight_rows` of an upload folder's binaryFile listing; uploads have at most 1 MB,
    so a file is one record here."""
    usable = files.where((F.col("length") > 0) & (F.col("length") <= MAX_WEIGHT_FILE_BYTES))
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^\\x{FEFF}", "")
    opened = usable.where(F.is_valid_utf8(F.col("content"))).select(
        "file", F.lit(0).cast("long").alias("block"), F.posexplode(F.split(text, "\r\n|\n|\r")).alias("row", "value"))
    # a file of empty lines only still has a header, an empty one
    return weight_rows(opened.where((F.length(F.trim("value")) > 0) | (F.col("row") == 0)))


_holds_weights = "NOT contains(lower(file), 'prices') AND NOT contains(lower(file), 'constituents')"


def weight_lines(spark: SparkSession, path: str, name_part: str = "") -> DataFrame:
    """Lines of the weight files below a folder, whatever their size; `file` is the name."""
    reader = spark.read.option("pathGlobFilter", f"*{name_part}*etf*.csv")
    lines = text_lines(reader, path).withColumn("row", F.monotonically_increasing_id())
    named = lines.withColumn("file", F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B"))))
    return named.where(_holds_weights)


def weight_file_names(spark: SparkSession, path: str, name_part: str = "") -> DataFrame:
    """file and length of the same files, empty ones too."""
    return uploaded_files(spark, path, f"*{name_part}*etf*.csv").select("file", "length").where(_holds_weights)


def weight_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, headers) of weight files in one job, whatever the column order of each.

    lines: file, block, row, value. rows: file, row, name, weight_text. headers: file, missing
    (required columns the header lacks). The first line of a file is its header; its names are
    trimmed and lower-cased, and `ticker` stands in for `name`. Lines may be spread over
    tasks; only one line per file is gathered to find the headers.
    """
    place = F.struct("block", "row")
    headed = lines.groupBy("file").agg(F.min(F.struct("block", "row", "value")).alias("first"))
    head = F.transform(cells(F.col("first.value")), lambda c: F.lower(F.trim(c)))
    at = lambda name: F.nullif(F.array_position("head", F.lit(name)), F.lit(0).cast("long")).cast("int")
    placed = headed.withColumn("head", head).select(
        "file", F.struct("first.block", "first.row").alias("first"), F.coalesce(at("name"), at("ticker")).alias("name_at"),
        at("weight").alias("weight_at"))
    missing = F.array_compact(F.array(
        F.when(F.col("name_at").isNull(), F.lit("name")), F.when(F.col("weight_at").isNull(), F.lit("weight"))
    ))
    headers = placed.select("file", missing.alias("missing"))
    body = lines.join(placed.where(F.size(missing) == 0), "file").where(place > F.col("first"))
    values = body.withColumn("cells", cells(F.col("value")))
    rows = values.select(
        "file", "row",
        null_if_missing(F.try_element_at("cells", F.col("name_at"))).alias("name"),
        null_if_missing(F.trim(F.try_element_at("cells", F.col("weight_at")))).alias("weight_text"),
    )
    return rows, headers
