"""Quality rules. Bad rows are kept and labelled, never dropped silently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens import schema
from fundlens.functions.trading_days import trading_days
from fundlens.operators.series import series_window


def label_price_rows(raw: DataFrame, allow_zero: bool = True, close: str = "close") -> DataFrame:
    """Add `issue` (NULL for a good row). A first load keeps a zero close, an incremental one does not."""
    price = F.col(close)
    bad = F.when(price.isNull(), "null_close")
    bad = bad.when(price < 0, "negative_close") if allow_zero else bad.when(price <= 0, "non_positive_close")
    return raw.withColumn("issue", bad)


def dedup_last(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """One row per key, the last by arrival order. An aggregation, so copies of a hot
    key shrink in every map task before the shuffle; a window would gather them all.
    Arrival columns are distinct per key; where not, the other columns break the tie."""
    rest = [c for c in df.columns if c not in keys]
    placed = F.struct(*arrival, *[c for c in rest if c not in arrival])
    last = df.groupBy(*keys).agg(F.max(placed).alias("_last"))
    return last.select(*keys, "_last.*").select(*df.columns)


def quality_prices(
    raw: DataFrame, keys: list[str], arrival: list[str], allow_zero: bool = True
) -> DataFrame:
    """Every input row with `issue` and, where high and low exist, `ohlc_mismatch`.

    Good rows that lose against a later row of the same key are `duplicate`. Whether
    a row is its key's last is looked up by key and arrival together, which are
    unique, so one key's copies spread over all tasks of that join.
    """
    labelled = label_price_rows(raw, allow_zero)
    good = labelled.where(F.col("issue").isNull()).select(*keys, *arrival)
    last = dedup_last(good, keys, arrival).withColumn("_last", F.lit(True))
    out = labelled.join(last, [*keys, *arrival], "left").withColumn(
        "issue", F.coalesce("issue", F.when(F.col("_last").isNull(), "duplicate"))
    )
    if {"low", "high"} <= set(raw.columns):
        mismatch = (F.col("low") > F.col("close")) | (F.col("high") < F.col("close"))
        out = out.withColumn("ohlc_mismatch", F.coalesce(mismatch, F.lit(False)))
    return out.drop("_last")


def accepted_prices(raw: DataFrame, keys: list[str], arrival: list[str], allow_zero: bool = True) -> DataFrame:
    """The good rows only, last of each key: what a load writes."""
    good = label_price_rows(raw, allow_zero).where(F.col("issue").isNull()).drop("issue")
    return dedup_last(good, keys, arrival)


def ohlc_report(prices: DataFrame, low="low_price", high="high_price", close="close_price") -> DataFrame:
    """Rows whose close lies outside low..high."""
    return prices.where((F.col(low) > F.col(close)) | (F.col(high) < F.col(close)))


def unknown_tickers(rows: DataFrame, universe: DataFrame, column: str = "ticker") -> DataFrame:
    """Tickers used in `rows` but absent from the universe, with their row counts."""
    used = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("ticker")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return used.join(universe.select("ticker"), "ticker", "left_anti")


def trading_calendar(prices: DataFrame) -> DataFrame:
    """Expected trading days from the first to the last date of the table."""
    ends = prices.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return ends.select(F.explode(trading_days(F.col("a"), F.col("b"))).alias("date"))


def gap_report(prices: DataFrame, by: str = "constituent_id") -> DataFrame:
    """Trading days without a row between a series' own first and last date.

    Each row opens the gap up to the next one, so only missing days are made: no
    calendar times securities, no anti-join.
    """
    following = F.lead("date").over(series_window(by))
    missing = trading_days(F.date_add("date", 1), F.date_sub("_next", 1))
    return (
        prices.select(by, "date", following.alias("_next"))
        .where(F.datediff("_next", "date") > 1)
        .select(by, F.explode(missing).alias("date"))
    )


# The ordered rules of a weight file; the first one broken is the error a strict
# loader stops at. The sum rule only warns.
WEIGHT_RULES = (
    "no_rows",
    "null_name",
    "duplicate_name",
    "null_weight",
    "non_numeric_weight",
    "negative_weight",
    "weight_over_one",
    "all_zero",
    "total_not_positive",
    "sum_not_one",
    "unknown_ticker",
    "too_many_holdings",
)
MAX_HOLDINGS = 1000
SUM_TOLERANCE = 0.01


def quality_weights(rows: DataFrame, universe: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row per broken rule of each weight file.

    `rows` has file, name and weight_text; `files` may list files that have no rows
    at all. Rows first collapse to (file, name), which finds duplicates and needs
    the universe only once per name, then to one row per file.
    """
    weight = F.expr("try_cast(weight_text AS DECIMAL(18,8))")
    filled = rows.where(F.col("name").isNotNull() | F.col("weight_text").isNotNull())
    names = filled.withColumn("w", weight).groupBy("file", "name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("weight_text").isNull()).alias("null_w"),
        F.count_if(F.col("weight_text").isNotNull() & F.col("w").isNull()).alias("text_w"),
        F.count_if(F.col("w") < 0).alias("neg_w"),
        F.count_if(F.col("w") > 1).alias("over_w"),
        F.count_if(F.col("w") == 0).alias("zero_w"),
        F.sum("w").alias("sum_w"),
    )
    known = universe.select(F.col("ticker").alias("name"), F.lit(True).alias("known"))
    named = F.col("name").isNotNull()
    stats = names.join(known, "name", "left").groupBy("file").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("null_name"),
        F.sum(F.when(named, F.col("n") - 1).otherwise(0)).alias("duplicate_name"),
        F.sum("null_w").alias("null_weight"),
        F.sum("text_w").alias("non_numeric_weight"),
        F.sum("neg_w").alias("negative_weight"),
        F.sum("over_w").alias("weight_over_one"),
        F.sum("zero_w").alias("zero_w"),
        F.coalesce(F.sum("sum_w"), F.lit(0).cast("decimal(38,8)")).alias("total"),
        F.count_if(named & F.col("known").isNull()).alias("unknown_ticker"),
    )
    if files is not None:
        stats = files.select("file").distinct().join(stats, "file", "left")
    stats = stats.withColumn("n", F.coalesce("n", F.lit(0)))
    has_rows, total = F.col("n") > 0, F.col("total")
    broken = {
        "no_rows": F.when(~has_rows, F.lit(1)),
        "all_zero": F.when(has_rows & (F.col("zero_w") == F.col("n")), F.col("n")),
        "total_not_positive": F.when(has_rows & (total <= 0), F.col("n")),
        "sum_not_one": F.when(has_rows & (total > 0) & (F.abs(total - 1) > SUM_TOLERANCE), F.col("n")),
        "too_many_holdings": F.when(F.col("n") > MAX_HOLDINGS, F.col("n")),
    }
    found = F.array(*[
        F.struct(
            F.lit(i).alias("rule_order"),
            F.lit(rule).alias("rule"),
            F.lit("warning" if rule == "sum_not_one" else "error").alias("severity"),
            F.coalesce(broken[rule] if rule in broken else F.col(rule), F.lit(0)).cast("bigint").alias("rows"),
        )
        for i, rule in enumerate(WEIGHT_RULES, start=1)
    ])
    violated = F.filter(found, lambda r: r["rows"] > 0)
    first = F.try_element_at(F.filter(violated, lambda r: r["severity"] == "error"), F.lit(1))["rule"]
    return stats.select("file", first.alias("first_rule"), F.explode(violated).alias("v")).select(
        "file", "v.rule_order", "v.rule", "v.severity", "v.rows",
        F.coalesce(F.col("v.rule") == F.col("first_rule"), F.lit(False)).alias("is_first"),
    )


def constituent_issues(rows: DataFrame) -> DataFrame:
    """Dimension rows that break a column rule, with the names of the rules broken."""
    rules = [F.when(F.col("ticker").isNull(), F.lit("ticker_missing"))]
    for column, limit in schema.CONSTITUENT_LENGTHS.items():
        if column in rows.columns:
            rules.append(F.when(F.length(column) > limit, F.lit(f"{column}_too_long")))
    return rows.withColumn("issues", F.array_compact(F.array(*rules))).where(F.size("issues") > 0)
