"""The domain tables, derived from the star-schema test tables.

A supplier is a security, its line items are trades, regions are portfolios, and
the event stream is the landing folder. Everything is lazy; reading fewer columns
of a result reads fewer columns of the files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens import schema
from fundlens.operators import load, portfolio
from fundlens.operators.joins import MAX_BROADCAST_ROWS, few_rows
from fundlens.session import fresh_folder
from fundlens.sources.loads import write_load

# Landing rules: events from FIRST_LANDING on arrive as files, those before LOADED_BEFORE are in the table.
LOADED_BEFORE = "2024-01-06"
FIRST_LANDING = "2024-01-04"

# Order of the trades of one security and day; no shorter key is unique.
TRADE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "px", "qty"]

# Roots of loaded prices by application and folder.
_price_loads: dict[tuple[str, str], str] = {}


class Market:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table; its footer is read once per Market."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def _few_suppliers(self) -> bool:
        return few_rows(self.table("supplier"), MAX_BROADCAST_ROWS // 2)

    def _dimension(self, df: DataFrame) -> DataFrame:
        """Mark a frame of at most two rows per supplier for broadcast, if those are few."""
        return F.broadcast(df) if self._few_suppliers else df

    @staticmethod
    def _trades(lines: DataFrame) -> DataFrame:
        return lines.select(
            F.col("l_suppkey").alias("constituent_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("px"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            "l_orderkey", "l_linenumber", "l_partkey",
        )

    @staticmethod
    def _bars(trades: DataFrame) -> DataFrame:
        """One bar per security and day. The aggregation combines in the map tasks, so a
        security with very many trades reaches the shuffle as few rows per task and day."""
        order = F.struct(*TRADE_ORDER)
        return trades.groupBy("constituent_id", "date").agg(
            F.min(order)["px"].alias("open_price"),
            F.max("px").alias("high_price"),
            F.min("px").alias("low_price"),
            F.max(order)["px"].alias("close_price"),
            F.sum("qty").alias("volume"),
        )

    @cached_property
    def trades(self) -> DataFrame:
        return self._trades(self.table("lineitem"))

    @cached_property
    def prices(self) -> DataFrame:
        return self._bars(self.trades)

    def prices_from(self, start: Column) -> DataFrame:
        """Bars from the start of a day (a timestamp without zone) on. The stored timestamp is compared, not its date,
        so the scan skips older row groups."""
        return self._bars(self._trades(self.table("lineitem").where(F.col("l_shipdate") >= start)))

    @cached_property
    def newest_prices(self) -> DataFrame:
        """Bars of the newest day of the table."""
        return self.prices_from(self.table("lineitem").agg(F.max("l_shipdate").cast("date").cast("timestamp_ntz")).scalar())

    @cached_property
    def constituents(self) -> DataFrame:
        balance = F.col("s_acctbal")
        return self._dimension(self._placed_suppliers.select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("ticker"),
            F.upper("s_name").alias("name"),
            F.col("n_name").alias("sector"),
            F.col("r_name").alias("industry"),
            F.when(balance >= 5000, "Large").when(balance >= 0, "Mid").otherwise("Small").alias("market_cap"),
        ))

    @property
    def _placed_suppliers(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        supplier = self.table("supplier")
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
            region, F.col("n_regionkey") == region.r_regionkey
        )

    @cached_property
    def holdings(self) -> DataFrame:
        def weight(classes: int):
            step = (F.col("s_suppkey") % classes + 1).cast("decimal(9,4)")
            return (step * F.lit("0.01").cast("decimal(9,4)")).cast("decimal(9,4)").alias("weight")

        regional = self._placed_suppliers.select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("etf_upload_id"),
            F.col("s_suppkey").alias("constituent_id"),
            weight(9),
        )
        positive = self.table("supplier").where("s_acctbal > 0").select(
            F.lit(6).cast("bigint").alias("etf_upload_id"), F.col("s_suppkey").alias("constituent_id"), weight(5)
        )
        return self._dimension(regional.unionByName(positive))

    @cached_property
    def uploads(self) -> DataFrame:
        headers = self.holdings.groupBy("etf_upload_id").agg(
            F.sum("weight").alias("total_weight"), F.count(F.lit(1)).alias("num_constituents")
        )
        names = self.table("region").select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("etf_upload_id"), F.lower("r_name").alias("n")
        )
        day = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(etf_upload_id AS INT))")
        return headers.join(names, "etf_upload_id", "left").select(
            F.col("etf_upload_id").alias("id"),
            F.concat(F.coalesce("n", F.lit("positive_balance")), F.lit("_etf.csv")).alias("filename"),
            day.alias("uploaded_at"),
            "total_weight", "num_constituents",
            (F.col("etf_upload_id") != 6).alias("is_active"),
        )

    @cached_property
    def series(self) -> DataFrame:
        return portfolio.portfolio_series(self.prices, self.holdings)

    @cached_property
    def pairs(self) -> DataFrame:
        """Each security with the one that has the next id."""
        ids = self.table("supplier").select(F.col("s_suppkey").alias("key_a"))
        others = self.table("supplier").select(F.col("s_suppkey").alias("key_b"))
        return self._dimension(ids.join(others, F.col("key_b") == F.col("key_a") + 1))

    @cached_property
    def quotes(self) -> DataFrame:
        """Raw quotes with faults: no close on untaxed trades, a negative one on returned trades."""
        line = self.table("lineitem")
        px = F.col("l_extendedprice").cast("decimal(18,2)")
        discount, tax = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
        return line.select(
            F.col("l_suppkey").alias("constituent_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            (px * (1 - discount + tax)).alias("high"),
            (px * (1 - discount)).alias("low"),
            F.when(tax == 0, None).when(F.col("l_returnflag") == "R", -px).otherwise(px).alias("close"),
            "l_orderkey", "l_linenumber", "l_partkey",
            px.alias("px"), F.col("l_quantity").cast("bigint").alias("qty"),
        )

    @property
    def _ticks(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.col("user_id").cast("string").alias("ticker"),
            F.col("ts").cast("date").alias("date"),
            F.col("value").cast("decimal(18,2)").alias("close"),
            (F.col("event_id") % 5).alias("file"),
        )

    @cached_property
    def landing(self) -> DataFrame:
        return self._ticks.where(F.col("date") >= F.lit(FIRST_LANDING).cast("date"))

    @cached_property
    def loaded_ticks(self) -> DataFrame:
        return self._ticks.where(F.col("date") < F.lit(LOADED_BEFORE).cast("date"))

    @cached_property
    def tick_watermarks(self) -> DataFrame:
        return load.high_watermark(self.loaded_ticks, "ticker")

    @cached_property
    def tick_universe(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").cast("string").alias("ticker"))

    @cached_property
    def labelled_landing(self) -> DataFrame:
        return load.classify_landing(
            self.landing, self.tick_watermarks, self.tick_universe, arrival=["event_id"]
        )

    @cached_property
    def landing_files(self) -> DataFrame:
        """One daily price file per event date; those of loaded dates are processed."""
        days = self.table("events").select(F.col("ts").cast("date").alias("date")).distinct()
        done = F.col("date") < F.lit(LOADED_BEFORE).cast("date")
        return days.select(
            F.concat(F.lit("prices_"), F.col("date").cast("string"), F.lit(".csv")).alias("file"),
            F.when(done, "processed").otherwise("pending").alias("state"),
        )

    @cached_property
    def weight_rows(self) -> DataFrame:
        """Weight files made of customers, one per market segment, nation and 1,500 customers, with natural faults."""
        balance = F.col("c_acctbal").cast("decimal(18,2)")
        small = (F.abs(balance) * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,6)").cast("string")
        text = (
            F.when(balance > 9700, F.lit("pending"))
            .when(balance > 9400, F.lit(None))
            .when((balance > 9100) | (balance < -700), balance.cast("string"))
            .otherwise(small)
        )
        named = ~balance.between(8900, 9100)
        return self.table("customer").select(
            self._customer_file.alias("file"),
            F.when(named, self._customer_ticker).alias("name"),
            text.alias("weight_text"),
        )

    @property
    def _customer_group(self):
        return F.floor(F.col("c_custkey") / 1500)

    @property
    def _customer_file(self):
        parts = [F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"), self._customer_group.cast("string"), F.lit("etf.csv")]
        return F.concat_ws("_", *parts)

    @property
    def _customer_ticker(self):
        number = F.floor(F.col("c_custkey") / 14).cast("string")
        return F.concat(F.lit("Supplier#"), F.lpad(number, 9, "0"))

    @cached_property
    def loaded_weight_files(self) -> DataFrame:
        return self.table("customer").where("c_mktsegment = 'BUILDING'").select(
            (self._customer_group * 25 + F.col("c_nationkey") + 100).cast("bigint").alias("id"),
            self._customer_file.alias("filename"),
        ).distinct()

    @cached_property
    def incoming_constituents(self) -> DataFrame:
        return self.table("customer").select(
            self._customer_ticker.alias("ticker"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("sector"),
            F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("industry"),
            "c_custkey",
        )

    # -- the price table as loads commit it -----------------------------------

    @cached_property
    def price_loads(self) -> str:
        """A root of tables with all bars, committed in three loads that interleave by month.

        The second load is run twice: its first run holds the first days of its months only.
        Nothing commits to it afterwards, so a session loads it once.
        """
        key = self.spark.sparkContext.applicationId, self.folder
        if key not in _price_loads:
            _price_loads[key] = self._load_prices()
        return _price_loads[key]

    def _load_prices(self) -> str:
        root = fresh_folder(self.spark, "tables")
        bars = self.prices.select(*schema.PRICES.names)
        third = F.month("date") % 3
        early = (third == 1) & (F.dayofmonth("date") <= 10)
        for load_id, part in (("p0", third == 0), ("p1", early), ("p1", third == 1), ("p2", third == 2)):
            write_load(bars.where(part), root, "prices", load_id)
        return root
