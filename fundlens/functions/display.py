"""Short texts for volumes and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_volume(volume: Column) -> Column:
    """1250000 -> '1.3M', 340000 -> '340K', 999 -> '999'; ties go up, in whole-number arithmetic."""
    tenths = F.floor((volume + F.lit(50_000)) / F.lit(100_000)).cast("bigint")
    millions = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("M"))
    thousands = F.concat(F.floor((volume + F.lit(500)) / F.lit(1_000)).cast("string"), F.lit("K"))
    return (
        F.when(volume >= 1_000_000, millions)
        .when(volume >= 1_000, thousands)
        .otherwise(volume.cast("string"))
    )


def format_percent(fraction: Column, digits: int = 2) -> Column:
    """0.15 -> '15.00%'."""
    return F.concat(F.round(fraction.cast("decimal(28,8)") * 100, digits).cast(f"decimal(28,{digits})").cast("string"), F.lit("%"))
