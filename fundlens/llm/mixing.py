"""Mixing sources to target weights by capped water-filling.

Targets: every source asks for its weight's part of the budget. Sources that would exceed
their maximum number of epochs are clamped there and what they leave is shared again by
weight, until no source is above. A source's target then is a number of repetitions of its
documents: the whole ones go to every document, the fractional one to documents in the order
of a seeded hash until the target is met as nearly as whole documents can.

Plan: documents are read for sizes (no text is shuffled), summed per source and per
(source, hash bucket) with map-side combining. Only the one bucket per source that holds the
cut is ordered, so a source with a third of all rows is never gathered. The decision is one
row per source, joined back by broadcast while their number is checked to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import WORD, pick, tagged, untagged
from fundlens.operators.joins import small_side
from fundlens.operators.ranking import global_row_number
from fundlens.session import materialize

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix"
# Hex digits of the hash that name a bucket: 4,096 buckets per source.
BUCKET_DIGITS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


SOURCE = ["no_source", "named"]


def _sized(rows: DataFrame, seed: str) -> DataFrame:
    """Rows with their source, size in words, and place in the seeded order.

    Rows with the same id share a place; among those, smaller ones come first, and those of
    equal size are taken together.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rows.select(
        "*", n_words(F.col("text")).alias("size"), F.md5(key.cast("binary")).alias("place"),
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("named"))


def targets(sources: DataFrame, weights: tuple[int, ...], budget: float, max_epochs: int) -> DataFrame:
    """Sources (no_source, named, source_size) with their target in words.

    Each round is one aggregation over the sources and shows the driver two sums: what the
    clamped sources take, and the weight of the others. The level (words per weight) can only
    rise, so rounds end.
    """
    ranked = global_row_number(sources, [F.col("no_source"), F.col("named")], "rank")
    turn = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    rows = materialize(ranked.withColumn("weight", turn.cast("double"))
                       .withColumn("cap", F.col("source_size").cast("double") * max_epochs))
    wanted = budget * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) > F.col("cap")
        sums = rows.agg(F.sum(F.when(above, F.col("cap"))).alias("fixed"),
                        F.sum(F.when(~above, F.col("weight"))).alias("free")).first()
        left = wanted - (sums.fixed or 0.0)
        if not sums.free or left / sums.free <= level:
            break
        level = left / sums.free
    share = F.col("weight") * F.lit(left) / F.lit(sums.free or 1.0)
    return rows.select(*SOURCE, "source_size", F.when(above, F.col("cap")).otherwise(share).alias("target"))


def decisions(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
              max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: source_size, target, whole repetitions, and where the fractional one ends.

    Documents in buckets before cut_bucket get one more repetition, and in that bucket those
    up to (cut_place, cut_size).
    """
    kept = materialize(sized.select(*SOURCE, "place", "size", F.substring("place", 1, BUCKET_DIGITS).alias("bucket")))
    buckets = kept.groupBy(*SOURCE, "bucket").agg(F.sum("size").alias("words"))
    sources = buckets.groupBy(*SOURCE).agg(F.sum("words").alias("source_size"))
    goals = targets(sources, weights, budget, max_epochs)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    goals = goals.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    in_order = Window.partitionBy(*SOURCE).orderBy("bucket")  # at most 16 ** BUCKET_DIGITS rows
    summed = buckets.join(small_side(goals), SOURCE).withColumn("upto", F.sum("words").over(in_order))
    cut = (
        summed.where("upto >= part").groupBy(*SOURCE, *goals.columns[2:])
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("at"))
        .select(*SOURCE, *goals.columns[2:], "at.*").withColumnRenamed("bucket", "cut_bucket")
    )
    cut = materialize(cut)
    # the documents of one bucket per source, those of equal place and size as one
    inside = (
        kept.join(small_side(cut.select(*SOURCE, F.col("cut_bucket").alias("bucket"), "part", "before")), [*SOURCE, "bucket"])
        .groupBy(*SOURCE, "place", "size", "part", "before").agg(F.sum("size").alias("words"))
    )
    earlier = F.coalesce(F.sum("words").over(
        Window.partitionBy(*SOURCE).orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (
        inside.withColumn("middle", F.col("before") + earlier + F.col("words") / 2)
        .where("middle <= part").groupBy(*SOURCE).agg(F.max(F.struct("place", "size")).alias("cut"))
    )
    return materialize(cut.drop("before", "part").join(last, SOURCE, "left"))


def _decided(sized: DataFrame, decided: DataFrame) -> DataFrame:
    bucket = F.substring("place", 1, BUCKET_DIGITS)
    more = (bucket < F.col("cut_bucket")) | (
        (bucket == F.col("cut_bucket")) & F.coalesce(F.struct("place", "size") <= F.col("cut"), F.lit(False)))
    return sized.join(small_side(decided), SOURCE).withColumn("copies", F.col("whole") + more.cast("long"))


def mix(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source") -> DataFrame:
    """doc_id, size, source_size, target (the source's), copies, taken (size * copies).

    Sizes are words; null and empty texts have none and nothing is taken of them. A null
    source is a source, last in order. Repeated rows and null ids are rows like others (see
    `_sized` for their order). An empty table gives no rows. Other columns are dropped.
    A source's taken words differ from its target by at most half of the largest document
    (or group of rows of one id and size); no document is taken more than max_epochs times.
    """
    rows = pick(df, doc_id=id_column, text=text_column, source=source_column)
    sized = materialize(_sized(rows, seed).drop("text", "source"))
    return _decided(sized, decisions(sized, weights, budget, max_epochs)).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def sample(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
           seed: str = SEED, id_column: str = "doc_id", text_column: str = "text",
           source_column: str = "source") -> DataFrame:
    """The mixture itself: df's rows and columns, each row as often as `mix` decides.

    Null texts have size 0 and null sources are one source, as in `mix`; repeated rows and ids
    are taken together. An empty table gives no rows.
    """
    sized = _sized(tagged(df, doc_id=id_column, text=text_column, source=source_column), seed)
    rows = _decided(sized, decisions(sized, weights, budget, max_epochs)).where("copies > 0")
    return untagged(rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), df)
