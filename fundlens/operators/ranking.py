"""A global ROW_NUMBER that no single task has to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.session import materialize

# monotonically_increasing_id keeps the partition number above this many bits.
_ROW_BITS = 33


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Number all rows 1..N in the given total order.

    A distributed sort places the rows in ordered partitions; its result is
    checkpointed, so that the counts and the rows see the same partitions. The
    numbers then need only the row's position in its partition plus the rows in
    the partitions before it. The count table has one row per partition, which is
    what bounds its window and its broadcast. The order must be unique (add a
    key as tie-break), which also keeps equal leading values spread over partitions.
    """
    placed = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_part = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + in_part + F.lit(1))
        .drop("_part", "_at", "_before")
    )
