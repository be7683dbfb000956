"""The first load: dimension, then prices, then portfolios, from a folder of CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.operators import load, monitor, quality
from fundlens.sources import files
from fundlens.sources.landing import ARRIVAL_OVER_FILES, price_file_rows
from fundlens.plans.incremental_load import stored_among
from fundlens.sources.loads import Load
from fundlens.session import use_checkpoint_folder


def run_batch_load(
    spark: SparkSession,
    source: str,
    root: str,
    load_id: str,
    load_prices: bool = True,
    etf_name: str = "",
    fresh: bool = False,
) -> DataFrame:
    """Load constituents.csv, prices.csv and the *etf*.csv files of `source` into the
    tables below `root`; returns the table statistics afterwards.

    load_prices=False leaves prices alone, etf_name restricts the weight files by a
    part of their name, fresh empties the tables in the same step. Nothing is seen before all
    of it is. Running it again adds
    nothing: rows, tickers and files already there are recognised. Every row read is
    stored or in `rejected_rows`, and every weight file is in etf_uploads or file_issues.
    A load id that does not sort after those stored is refused.
    """
    use_checkpoint_folder(spark)
    to = Load(spark, root, load_id, empties=fresh)
    to.require_last()
    raw = None
    if load_prices:
        raw = to.write_and_read(price_file_rows(spark, f"{source}/prices.csv"), "staged")
    load_dimension(to, source, raw)
    if raw is not None:
        load_price_rows(to, raw)
    load_weights(to, source, etf_name)
    to.commit()
    return monitor.db_stats(*[to.now(t) for t in ("constituents", "prices", "etf_uploads", "etf_holdings")])


def load_dimension(to: Load, source: str, raw: DataFrame | None) -> None:
    listed = files.read_constituents(to.spark, f"{source}/constituents.csv")
    if listed is None:
        if raw is None:
            return
        listed = files.tickers_of(raw.where(F.col("ticker").isNotNull()))
    numbered = listed.withColumn("row", F.monotonically_increasing_id())
    arrival = [c for c in ARRIVAL_OVER_FILES if c in numbered.columns]
    to.write(load.upsert_constituents(to.read("constituents"), numbered, arrival), "constituents")


def load_price_rows(to: Load, raw: DataFrame) -> None:
    constituents = to.now("constituents")
    keys = raw.join(constituents.select("ticker", F.col("id").alias("constituent_id")), "ticker").select("constituent_id", "date")
    labelled = to.write_and_read(label_known(label_batch(raw), constituents, stored_among(to, keys)), "labelled")
    to.write(files.as_price_table(labelled.where(F.col("issue").isNull()), constituents), "prices")


def label_known(labelled: DataFrame, constituents: DataFrame, present: DataFrame) -> DataFrame:
    """Label rows of unknown tickers, and rows whose key another load has stored."""
    ids = constituents.select("ticker", F.col("id").alias("_id"))
    stored = present.select(F.col("constituent_id").alias("_id"), "date", F.lit(True).alias("_stored"))
    issue = F.coalesce(
        "issue", F.when(F.col("_id").isNull(), "unknown_ticker"), F.when(F.col("_stored"), "already_loaded"))
    joined = labelled.join(ids, "ticker", "left").join(stored, ["_id", "date"], "left")
    return joined.withColumn("issue", issue).drop("_id", "_stored")


def label_batch(raw: DataFrame) -> DataFrame:
    """Batch rules on parsed rows; faults found in parsing come first."""
    parsed_well = raw.where(F.col("issue").isNull()).drop("issue")
    checked = quality.quality_prices(parsed_well, ["ticker", "date"], ARRIVAL_OVER_FILES)
    return checked.unionByName(raw.where(F.col("issue").isNotNull()), allowMissingColumns=True)


def load_weights(to: Load, source: str, etf_name: str) -> None:
    spark = to.spark
    names = files.weight_file_names(spark, source, etf_name)
    lines = files.weight_lines(spark, source, etf_name)
    broken = lines.where(~F.col("valid")).select("file").distinct()
    rows, headers = files.weight_rows(lines.join(broken, "file", "left_anti"))
    uploads = to.read("etf_uploads")
    loaded, holdings = load.load_portfolios(rows, to.now("constituents"), uploads)
    to.write(loaded.withColumn("uploaded_at", F.current_timestamp()), "etf_uploads")
    to.write(holdings, "etf_holdings")
    mark = lambda df, name: df.select("file", F.lit(True).alias(name)).distinct()
    stored = to.now("etf_uploads").join(uploads.select("filename"), "filename", "left_anti")
    seen = (
        names.join(mark(uploads.withColumnRenamed("filename", "file"), "_already"), "file", "left")
        .join(mark(stored.withColumnRenamed("filename", "file"), "_stored"), "file", "left")
        .join(mark(broken, "_broken"), "file", "left")
        .join(headers, "file", "left")
        .join(rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows")), "file", "left")
    )
    rule = (
        F.when(F.col("_already"), "already_loaded").when(F.col("length") == 0, "empty_file").when(F.col("_broken"), "not_utf8")
        .when(F.size("missing") > 0, "missing_columns").when(F.col("missing").isNull(), "empty_file")
        .when(F.col("rows").isNull(), "no_rows").otherwise("broken_row")
    )
    issues = seen.where(F.col("_stored").isNull()).select("file", rule.alias("rule"), F.coalesce("rows", F.lit(0)).alias("rows"))
    to.write(issues, "file_issues")
