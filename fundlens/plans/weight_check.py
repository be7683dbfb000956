"""All rules over a folder of uploaded weight files: file, header and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlens.operators.quality import WEIGHT_RULES, quality_weights
from fundlens.sources.files import file_issues, parse_weight_files, uploaded_files

# In the order a strict loader checks them; the row rules follow.
FILE_RULES = ("not_csv", "bad_content_type", "empty_file", "file_too_large", "not_utf8", "missing_columns")
RULES = FILE_RULES + WEIGHT_RULES


def _order(rule: Column) -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in RULES]), rule).cast("int")


def check_weight_folder(spark: SparkSession, path: str, universe: DataFrame) -> DataFrame:
    """One row per broken rule of each file, with the one a strict loader stops at marked.

    The window is over the rules of one file, 18 at most.
    """
    uploads = uploaded_files(spark, path)
    rows, headers = parse_weight_files(uploads.where(F.lower("file").endswith(".csv")))
    headless = headers.where(F.size("missing") > 0).select("file", F.lit("missing_columns").alias("rule"))
    by_row = quality_weights(rows, universe, headers.where(F.size("missing") == 0)).select("file", "rule", "severity")
    by_file = file_issues(uploads).unionByName(headless).withColumn("severity", F.lit("error"))
    found = by_file.unionByName(by_row).withColumn("rule_order", _order(F.col("rule")))
    first = F.min(F.when(F.col("severity") == "error", F.col("rule_order"))).over(Window.partitionBy("file"))
    return found.withColumn("is_first", F.coalesce(F.col("rule_order") == first, F.lit(False)))
