"""Sharding over fixed virtual slots.

Records hash into a fixed number of virtual slots, for good. A versioned map says which shard
holds which slot. Rebalancing aggregates bytes per slot and edits the map: slots leave shards
that hold too much, largest first, for those that hold least; adding a shard moves slots only
into it. The maps have one row per slot, so the driver edits them; records never pass it.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlens.llm.common import pick
from fundlens.session import materialize

SLOTS = 8192
SHARDS = 40
OVERHEAD = 16
# A stored map is edited if a shard holds more above the mean.
TOLERANCE = 0.005
# Equal records numbered in one task.
EQUAL_AT_ONCE = 100_000


def _slotted(rows: DataFrame, slots: int) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of each record.

    Id, text and the number among equal records decide the slot, so copies of a text, rows of
    one id and repeated rows all spread. Records are counted first and numbered after: records of
    equal id, size and checksum look alike in all that follows.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    key = ["doc_id", "size", "text_crc32"]
    counted = rows.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    ).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    # two steps, so that no task numbers all records of a very common kind
    first = counted.select(*key, "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(EQUAL_AT_ONCE))).alias("first"))
    last = F.least(F.col("first") + EQUAL_AT_ONCE, "n") - 1
    numbered = first.repartition(*key, "first").select(*key, F.explode(F.sequence("first", last)).alias("number"))
    return numbered.select(*key, F.pmod(F.xxhash64(*key, "number"), F.lit(slots)).cast("int").alias("vslot"))


def first_map(slots: int, shards: int) -> list[int]:
    """The shard of each slot before anything is known of their sizes."""
    return [slot % shards for slot in range(slots)]


def rebalanced(old: list[int], sizes: list[int], shards: int) -> list[int]:
    """Edit a map until shards are near equal, moving slots only out of shards above the mean.

    Slots of an overfull shard are released, largest first, as long as it stays above the
    mean or they alone make it so; released slots go, largest first, to the emptiest shard.
    """
    held = [0] * shards
    for slot, shard in enumerate(old):
        held[shard] += sizes[slot]
    mean = sum(sizes) / shards
    released = []
    new = list(old)
    for slot in sorted(range(len(old)), key=lambda s: (-sizes[s], s)):
        shard = old[slot]
        if sizes[slot] and held[shard] > mean:
            held[shard] -= sizes[slot]
            released.append(slot)
    emptiest = [(h, shard) for shard, h in enumerate(held)]
    heapq.heapify(emptiest)
    for slot in released:
        h, shard = heapq.heappop(emptiest)
        new[slot] = shard
        heapq.heappush(emptiest, (h + sizes[slot], shard))
    return new


def near_equal(shard_of: list[int], sizes: list[int], shards: int) -> bool:
    """Whether no shard holds more than TOLERANCE above the mean."""
    held = [0] * shards
    for slot, shard in enumerate(shard_of):
        held[shard] += sizes[slot]
    return max(held) <= (1 + TOLERANCE) * sum(sizes) / shards


def grown(old: list[int], sizes: list[int], shards: int) -> list[int]:
    """The map with one more shard: slots move only into it, from the fullest shards."""
    held = [0] * shards
    for slot, shard in enumerate(old):
        held[shard] += sizes[slot]
    new, room = list(old), sum(sizes) / (shards + 1)
    for slot in sorted(range(len(old)), key=lambda s: (-sizes[s], s)):
        if 0 < sizes[slot] <= room and held[old[slot]] - sizes[slot] >= sum(sizes) / (shards + 1) * 0.98:
            new[slot], room = shards, room - sizes[slot]
            held[old[slot]] -= sizes[slot]
    return new


def slot_sizes(slotted: DataFrame, slots: int) -> list[int]:
    """Bytes per slot; the result has one number per slot, whatever the table holds."""
    sizes = [0] * slots
    for slot, size in slotted.groupBy("vslot").agg(F.sum("size")).collect():
        sizes[slot] = size
    return sizes


def write_map(spark: SparkSession, folder: str, version: int, shard_of: list[int]) -> None:
    """Store one version of the map under folder; versions written before stay."""
    rows = spark.createDataFrame(list(enumerate(shard_of)), "vslot int, shard int")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> list[int]:
    rows = spark.read.parquet(f"{folder}/version={version}").orderBy("vslot")
    return [shard for _, shard in rows.select("vslot", "shard").collect()]


def newest_version(spark: SparkSession, folder: str) -> int | None:
    """The newest stored version of the map, or None if there is none."""
    try:
        return spark.read.parquet(folder).agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def assign(df: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_folder: str | None = None,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ("bytes"), shard, slot, vslot, grown_shard (null).

    size is the text's UTF-8 bytes plus 16; a null or empty text has 16. slot counts the rows
    of a shard from 0 without gaps: virtual slots in order, inside one by id, CRC and size.
    Null ids and repeated rows are records like others, and spread. An empty table gives no rows;
    other columns are dropped. With map_folder, the newest map stored there is edited (the first
    one, if there is none, is stored as version 1), and what comes of it is stored as the next
    version and read back. A map under which no shard holds TOLERANCE above the mean stays.

    Only ids, sizes and checksums are shuffled, by virtual slot.
    """
    spark = df.sparkSession
    slotted = materialize(_slotted(pick(df, doc_id=id_column, text=text_column), slots))
    version = None
    if map_folder is not None:
        version = newest_version(spark, map_folder)
        if version is None:
            version = 1
            write_map(spark, map_folder, version, first_map(slots, shards))
    before = first_map(slots, shards) if version is None else read_map(spark, map_folder, version)
    if len(before) != slots or max(before) >= shards:
        raise ValueError("the stored map is for other slots or shards")
    sizes = slot_sizes(slotted, slots)
    balanced = before if near_equal(before, sizes, shards) else rebalanced(before, sizes, shards)
    if version is not None and balanced != before:
        write_map(spark, map_folder, version + 1, balanced)
        balanced = read_map(spark, map_folder, version + 1)
    where = spark.createDataFrame(list(enumerate(balanced)), "vslot int, shard int")  # one row per slot
    counts = slotted.groupBy("vslot").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = where.join(F.broadcast(counts), "vslot").select(
        "vslot", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return slotted.join(F.broadcast(offsets), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.row_number().over(inside) - 1).alias("slot"), "vslot",
        F.lit(None).cast("int").alias("grown_shard"))
