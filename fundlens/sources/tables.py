"""The domain tables as parquet folders, one sub-folder per load.

A load writes <root>/<table>/load_id=<id>/attempt=<attempt>/ and is seen once it is in the log
of commits (see `commits`), all of its tables together. The same load again is a new attempt
that takes the place of its first. Snapshot tables (dimension, watermarks) hold everything in
each load and are read at their newest; the others are the union of their loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens import schema
from fundlens.sources.commits import Attempt, Snapshot, snapshot

WATERMARKS = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("wm", T.DateType())])
# Every row a load has read, with its place of origin; as parsed, and with the load's verdict in `issue`.
STAGED = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("row", T.LongType())]
    + schema.OHLCV.fields
    + [T.StructField("issue", T.StringType())]
)
LABELLED = T.StructType(STAGED.fields + [T.StructField("ohlc_mismatch", T.BooleanType())])
FILES = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("passed", T.LongType()),
    T.StructField("inserted", T.LongType()),
])
RUNS = T.StructType([
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("files_processed", T.LongType()),
    T.StructField("files_skipped", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_dropped", T.LongType()),
    T.StructField("new_watermark", T.DateType()),
])

# Weight files of a load that are not among its uploads, with the reason.
FILE_ISSUES = T.StructType([T.StructField("file", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("rows", T.LongType())])

# One line per run, failed ones too, and where handled files have gone.
RUN_LOG = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])
ARCHIVED = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("handled_by", T.StringType()),
    T.StructField("target", T.StringType()),
])

# Summaries of the prices of one or more loads (see `summaries`).
SECURITY_SUMMARIES, DAY_SUMMARIES, MONTH_SUMMARIES = "security_summaries", "day_summaries", "month_summaries"
BY_SECURITY = T.StructType([
    T.StructField("constituent_id", T.LongType()),
    T.StructField("earliest_date", T.DateType()),
    T.StructField("latest_date", T.DateType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("close_price", schema.PRICE),
    T.StructField("volume", T.LongType()),
])
BY_MONTH = T.StructType([
    T.StructField("constituent_id", T.LongType()),
    T.StructField("month", T.StringType()),
    T.StructField("n", T.LongType()),
])
BY_DAY = T.StructType([T.StructField("date", T.DateType()), T.StructField("n", T.LongType())])

SCHEMAS = {
    "constituents": schema.CONSTITUENTS,
    "prices": schema.PRICES,
    "etf_uploads": schema.ETF_UPLOADS,
    "etf_holdings": schema.ETF_HOLDINGS,
    "watermarks": WATERMARKS,
    "watermark_changes": WATERMARKS,
    "staged": STAGED,
    "labelled": LABELLED,
    "files": FILES,
    "file_issues": FILE_ISSUES,
    "runs": RUNS,
    "run_log": RUN_LOG,
    "archived": ARCHIVED,
    SECURITY_SUMMARIES: BY_SECURITY,
    DAY_SUMMARIES: BY_DAY,
    MONTH_SUMMARIES: BY_MONTH,
}
SNAPSHOTS = ("constituents", "watermarks")


def folder(root: str, table: str, attempt: Attempt) -> str:
    return f"{root}/{table}/load_id={attempt.load_id}/attempt={attempt.attempt}"


def _full(table: str) -> T.StructType:
    full = T.StructType(SCHEMAS[table].fields + [T.StructField("load_id", T.StringType())])
    return full.add("month", T.StringType()) if table == "prices" else full


def read_attempts(spark: SparkSession, root: str, table: str, attempts: list[Attempt]) -> DataFrame:
    full = _full(table)
    if not attempts:
        return spark.createDataFrame([], full)
    names = list(full.names)
    reader = spark.read.schema(full.add("attempt", T.StringType())).option("basePath", f"{root}/{table}")
    return reader.parquet(*[folder(root, table, a) for a in attempts]).select(*names)


def read_loads(
    spark: SparkSession, root: str, table: str, version: int | None = None, at: Snapshot | None = None
) -> DataFrame:
    """All committed loads of a table with their load_id; prices also have their month, the
    partition to filter on. A table that does not exist yet is empty. `version`: as it was."""
    at = at or snapshot(spark, root, version)
    return read_attempts(spark, root, table, at.holding(table))


def read_table(
    spark: SparkSession, root: str, table: str, without: str | None = None, version: int | None = None, at: Snapshot | None = None
) -> DataFrame:
    """A table as it stands, or as it stood; `without` leaves one load out, so that a load that
    is repeated sees what its first run saw."""
    at = at or snapshot(spark, root, version)
    attempts = at.holding(table, without)
    if table in SNAPSHOTS:
        attempts = sorted(attempts, key=lambda a: a.load_id)[-1:]
    return read_attempts(spark, root, table, attempts).select(*SCHEMAS[table].names)


def write_folder(df: DataFrame, root: str, table: str, attempt: Attempt) -> None:
    """Write an attempt's rows of a table. Prices go into months, sorted by security and range-partitioned over (month, security):
    even files, and a narrow id range in each for scans to skip."""
    path = folder(root, table, attempt)
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])
    if table != "prices":
        out.write.parquet(path)
        return
    monthly = out.withColumn("month", F.date_format("date", "yyyy-MM"))
    order = ["month", "constituent_id", "date"]
    placed = monthly.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.write.partitionBy("month").parquet(path)
