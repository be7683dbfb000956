"""Load operators: watermarks, admission of landing rows, appends and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.operators.joins import small_side
from fundlens.operators.quality import dedup_last, label_price_rows
from fundlens.operators.ranking import global_row_number


def high_watermark(prices: DataFrame, by: str = "constituent_id") -> DataFrame:
    """Newest loaded date per key."""
    return prices.groupBy(by).agg(F.max("date").alias("wm"))


def day_verdicts(
    rows: DataFrame,
    watermarks: DataFrame,
    universe: DataFrame | None = None,
    file: str = "file",
    arrival: list[str] | None = None,
) -> DataFrame:
    """What decides about the rows of each (ticker, date, file): `floor`, `last`, `known`.

    Handling files one by one moves a ticker's watermark to the newest valid date
    seen so far. Rows dropped on the way never raise it, so the floor of a file is
    the larger of the loaded watermark and the newest valid date of the earlier
    files. `last` is the arrival of the row that wins among copies. Valid rows first
    shrink to one per (ticker, date, file) in the map tasks, so a ticker's window
    group is bounded by days times files and not by its rows.
    """
    winner = F.max(F.struct(*arrival)) if arrival else F.lit(None)
    days = rows.where(F.col("issue").isNull()).groupBy("ticker", "date", file).agg(winner.alias("last"))
    place = Window.partitionBy("ticker").orderBy(file)
    earlier = Window.partitionBy("ticker").orderBy("_place").rangeBetween(Window.unboundedPreceding, -1)
    placed = days.withColumn("_place", F.dense_rank().over(place)).withColumn("_newest", F.max("date").over(earlier))
    out = placed.join(watermarks.select("ticker", "wm"), "ticker", "left")
    known = F.lit(True)
    if universe is not None:
        out = out.join(universe.select("ticker", F.lit(True).alias("_in")), "ticker", "left")
        known = F.col("_in").isNotNull()
    return out.select("ticker", "date", file, F.greatest("_newest", "wm").alias("floor"), "last", known.alias("known"))


def classify_landing(
    rows: DataFrame,
    watermarks: DataFrame,
    universe: DataFrame | None = None,
    file: str = "file",
    arrival: list[str] | None = None,
) -> DataFrame:
    """Every landing row with `issue`; NULL means it is to be inserted.

    `rows` has ticker, date, close and the file it came in, in an order that sorts
    like the arrival of the files. It may bring an `issue` of its own from parsing.
    With `arrival`, rows of one (ticker, date) in one file keep the last and label
    the others; with `universe`, rows of tickers it lacks are labelled too. Rows meet
    their verdict on (ticker, date, file), which spreads a ticker with very many rows.
    """
    parsed = F.col("issue") if "issue" in rows.columns else F.lit(None).cast("string")
    labelled = label_price_rows(rows.withColumn("_parsed", parsed), allow_zero=False)
    labelled = labelled.withColumn("issue", F.coalesce("_parsed", "issue")).drop("_parsed")
    verdicts = day_verdicts(labelled, watermarks, universe, file, arrival)
    issue = F.coalesce(
        "issue",
        F.when(F.col("date") <= F.col("floor"), "at_or_below_watermark"),
        *([F.when(F.struct(*arrival) != F.col("last"), "duplicate")] if arrival else []),
        F.when(~F.coalesce("known", F.lit(False)), "unknown_ticker"),
    )
    joined = labelled.join(verdicts, ["ticker", "date", file], "left")
    return joined.withColumn("issue", issue).drop("floor", "last", "known")


def admit_new_rows(rows: DataFrame, watermarks: DataFrame, file: str = "file") -> DataFrame:
    """Valid rows past the watermark that moves from file to file; also the dry run of a load."""
    return classify_landing(rows, watermarks, file=file).where(F.col("issue").isNull()).drop("issue")


# Labels of rows that passed validation, whether or not they end up inserted.
_PASSED = ("duplicate", "unknown_ticker")


def incremental_summary(labelled: DataFrame, watermarks: DataFrame, file: str = "file") -> DataFrame:
    """One row about a run: files processed and skipped, rows inserted and dropped, new watermark."""
    passed = F.col("issue").isNull() | F.col("issue").isin(*_PASSED)
    files = labelled.groupBy(file).agg(
        F.count_if(passed).alias("passed"),
        F.count_if(F.col("issue").isNull()).alias("inserted"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(passed, F.col("date"))).alias("newest"),
    )
    loaded = watermarks.agg(F.max("wm")).scalar()
    return files.agg(
        F.count_if(F.col("passed") > 0).alias("files_processed"),
        F.count_if(F.col("passed") == 0).alias("files_skipped"),
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum(F.col("n") - F.col("inserted")), F.lit(0)).alias("rows_dropped"),
        F.max("newest").alias("_newest"),
    ).select(
        "files_processed", "files_skipped", "rows_inserted", "rows_dropped",
        F.greatest("_newest", loaded).alias("new_watermark"),
    )


def append_new(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The incoming rows whose key the target does not have."""
    return incoming.join(target.select(*keys), keys, "left_anti")


_ATTRIBUTES = ("name", "sector", "industry", "market_cap")


def upsert_constituents(existing: DataFrame, incoming: DataFrame, arrival: list[str]) -> DataFrame:
    """The dimension after an upsert by ticker, the last incoming row winning.

    Incoming attributes replace the old ones, also by NULL. New tickers get ids
    above the current maximum, in ticker order. Rows without a ticker are left out.
    """
    incoming = incoming.where(F.col("ticker").isNotNull())
    kept = [a for a in _ATTRIBUTES if a in existing.columns]
    for a in kept:
        if a not in incoming.columns:
            incoming = incoming.withColumn(a, F.lit(None).cast("string"))
    last = dedup_last(incoming.select("ticker", *kept, *arrival), ["ticker"], arrival).drop(*arrival)
    fresh = last.withColumn("_incoming", F.lit(True))
    dated = ["created_at"] if "created_at" in existing.columns else []
    old = existing.select("ticker", "id", *[F.col(a).alias(f"_old_{a}") for a in kept], *dated)
    attributes = [F.when(F.col("_incoming"), F.col(a)).otherwise(F.col(f"_old_{a}")).alias(a) for a in kept]
    attributes += [F.coalesce(c, F.current_timestamp()).alias(c) for c in dated]
    merged = old.join(fresh, "ticker", "full_outer").select("id", "ticker", *attributes)
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    added = global_row_number(merged.where(F.col("id").isNull()).drop("id"), [F.col("ticker").asc()], "_n")
    numbered = added.select((F.col("_n") + top).alias("id"), "ticker", *kept, *dated)
    return merged.where(F.col("id").isNotNull()).unionByName(numbered)


def portfolio_headers(rows: DataFrame) -> DataFrame:
    """Total weight and holding count per weight file; tickers outside the universe count too."""
    weight = F.expr("try_cast(weight_text AS DECIMAL(18,8))")
    return rows.groupBy("file").agg(
        F.coalesce(F.sum(weight), F.lit(0).cast("decimal(38,8)")).cast("decimal(28,8)").alias("total_weight"),
        F.count(F.lit(1)).alias("num_constituents"),
    )


def load_portfolios(
    rows: DataFrame, constituents: DataFrame, uploads: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New portfolio headers and holdings from weight-file rows (file, name, weight_text).

    Files already loaded are left out. So is a file that cannot be stored whole: a
    weight that is not a number, or a known ticker without a weight or listed twice.
    Unknown tickers count in the header and have no holding.
    """
    weight = F.expr("try_cast(weight_text AS DECIMAL(18,8))")
    new_rows = rows.join(uploads.select(F.col("filename").alias("file")).distinct(), "file", "left_anti")
    dim = constituents.select(F.col("ticker").alias("name"), F.col("id").alias("constituent_id"))
    matched = (
        new_rows.withColumn("weight", weight)
        .groupBy("file", "name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("weight_text").isNotNull() & F.col("weight").isNull()).alias("bad"),
            F.count_if(F.col("weight_text").isNull()).alias("empty"),
            F.sum("weight").alias("weight"),
        )
        .join(dim, "name", "left")
    )
    known = F.col("constituent_id").isNotNull()
    broken = (F.col("bad") > 0) | (known & ((F.col("empty") > 0) | (F.col("n") > 1)))
    files = matched.groupBy("file").agg(
        F.coalesce(F.sum("weight"), F.lit(0).cast("decimal(38,8)")).cast("decimal(28,8)").alias("total_weight"),
        F.sum("n").alias("num_constituents"),
        F.max(broken).alias("broken"),
    )
    top = uploads.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    good = global_row_number(files.where(~F.col("broken")).drop("broken"), [F.col("file").asc()], "_n")
    headers = good.select(
        (F.col("_n") + top).alias("id"), F.col("file").alias("filename"), "total_weight", "num_constituents",
        F.lit(True).alias("is_active"),
    )
    holdings = (
        matched.where(known)
        .join(small_side(headers.select(F.col("filename").alias("file"), F.col("id").alias("etf_upload_id"))), "file")
        .select("etf_upload_id", "constituent_id", F.col("weight").cast("decimal(18,8)").alias("weight"))
    )
    return headers, holdings


def feed_first_n_days(vendor: DataFrame, loaded: DataFrame, n: int = 1) -> DataFrame:
    """Vendor rows of the first n distinct days after the last loaded date, however far off.

    The day list has n rows, so it may be broadcast.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    last = loaded.agg(F.max("date")).scalar()
    ahead = vendor.where(F.col("date") > last)
    days = ahead.select("date").distinct().orderBy("date").limit(n)
    return ahead.join(F.broadcast(days), "date", "left_semi")
