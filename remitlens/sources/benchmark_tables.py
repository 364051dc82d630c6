"""The courier warehouse and the marketplace data set, derived from the benchmark's order tables.

Keys are turned into statuses, weights and charges by integer arithmetic, so any engine derives the same
rows. ``lineitem`` may hold several rows per order and line; settlements fold them per order first.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the load date that decides the festival flag of the derived calendar.
AS_OF = datetime.date(2001, 8, 1)


def _text(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _run(year: Column) -> Column:
    return _text("RUN-", year)


_schemas: dict[tuple[str, str], T.StructType] = {}


class BenchmarkTables:
    """The given Parquet tables of one scale, and the warehouse tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def given(self, name: str) -> DataFrame:
        """A given table; its schema is looked up in the files once per application."""
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _schemas:
            _schemas[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[key]).parquet(path)

    # -- star schema -------------------------------------------------------------------------------

    def couriers(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.given("region").select(
            (key + 1).cast("int").alias("courier_id"),
            F.col("r_name").alias("courier_name"),
            (35 + 8 * key).cast("decimal(10,2)").alias("base_rate_rs"),
            (48 + 24 * (key % 3)).cast("int").alias("sla_hours"),
        )

    def geography(self) -> DataFrame:
        region = self.given("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("zone"))
        return self.given("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").cast("int").alias("geo_id"),
            F.col("n_name").alias("city"),
            _text("Tier-", 1 + F.col("n_nationkey") % 3).alias("tier"),
            "zone",
        )

    def merchants(self) -> DataFrame:
        return self.given("customer").select(
            _text("M-", F.col("c_custkey")).alias("merchant_id"),
            F.col("c_name").alias("merchant_name"),
            F.col("c_mktsegment").alias("category"),
        )

    def orders(self) -> DataFrame:
        """Order facts, with the benchmark's order key kept as ``order_key`` for the settlement join."""
        key = F.col("o_orderkey")
        closed = F.col("o_orderstatus").isin("F", "P")
        on_delivery = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
        status = (
            F.when(closed, "DELIVERED")
            .when(key % 3 == 0, "RTO")
            .when(key % 3 == 1, "IN_TRANSIT")
            .otherwise("LOST")
        )
        eta = (F.col("sla_hours") * (60 + (key * 13) % 90)).cast("decimal(20,0)") * F.expr("0.01BD")
        customers = self.given("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("int").alias("geo_id")
        )
        rows = (
            self.given("orders")
            .withColumn("courier_id", (key % 5 + 1).cast("int"))
            .join(customers, "o_custkey")
            .join(self.couriers().select("courier_id", "sla_hours"), "courier_id")
        )
        return rows.select(
            key.alias("order_key"),
            _text("ORD", key).alias("order_id"),
            _text("AWB", key).alias("awb_number"),
            "courier_id",
            _text("M-", F.col("o_custkey")).alias("merchant_id"),
            "geo_id",
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.lit(None).cast("date").alias("delivery_date"),
            status.alias("order_status"),
            F.when(on_delivery, "COD").otherwise("Prepaid").alias("payment_mode"),
            F.when(on_delivery, F.col("o_totalprice")).otherwise(0.0).cast("decimal(12,2)").alias("cod_amount"),
            ((400 + (key * 37) % 8000).cast("decimal(20,0)") * F.expr("0.001BD"))
            .cast("decimal(8,3)")
            .alias("declared_weight"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("order_value"),
            F.col("sla_hours").alias("promised_eta_hrs"),
            F.when(closed, eta.cast("decimal(8,2)")).alias("actual_eta_hrs"),
        )

    def bookings(self) -> DataFrame:
        """Every line as its courier books it: an order's lines of one year meet in one run."""
        return self.given("lineitem").select(
            _text("AWB", F.col("l_orderkey")).alias("awb_number"), _run(F.year("l_shipdate")).alias("batch_id")
        )

    def settlements(self, orders: DataFrame) -> DataFrame:
        """Settlement facts from what an order's lines have in common.

        The least discount, tax and quantity of the lines make the cash, weight and freight differ from the order's.
        Lines that were all returned cost a return charge, and orders whose lines are all open are paid two weeks
        later. An order is settled in the run of the year that it ships last; if it has eight or more lines, also in
        that of the year that it ships first.
        """
        # An order's lines lie anywhere in the files, so there is next to nothing to fold before they meet, and the tables of
        # folded lines would outgrow a task's memory. They are gathered first and folded once.
        gathered = (
            self.given("lineitem")
            .select(
                F.col("l_orderkey").alias("order_key"), "l_discount", "l_tax", "l_quantity", "l_extendedprice",
                (F.col("l_returnflag") == "R").alias("is_returned"), (F.col("l_linestatus") == "O").alias("is_open"), "l_shipdate",
            )
            .repartition("order_key")
        )
        lines = gathered.groupBy("order_key").agg(
            F.count(F.lit(1)).alias("lines"),
            F.round(F.min("l_discount") * 100).cast("int").alias("discount"),
            F.round(F.min("l_tax") * 100).cast("int").alias("tax"),
            F.min("l_quantity").cast("int").alias("units"),
            F.min("l_extendedprice").alias("least_price"),
            F.min("is_returned").alias("returned"),
            F.min("is_open").alias("open"),
            F.min("l_shipdate").alias("ships_first"),
            F.max("l_shipdate").alias("ships_last"),
        )
        first, last = F.year("ships_first"), F.year("ships_last")
        years = F.when(F.col("lines") >= 8, F.array_distinct(F.array(last, first))).otherwise(F.array(last))
        cod, weight = F.col("cod_amount"), F.col("declared_weight")
        slab = F.expr("case when declared_weight <= 1 then 42 when declared_weight <= 3 then 65 else 95 end")
        kept_back = F.greatest(F.col("discount") - 3, F.lit(0))
        days = F.floor(F.dayofmonth("ships_last") / 2) + F.when(F.col("open"), 14).otherwise(0)
        return (
            lines.join(orders, "order_key")
            .withColumn("year", F.explode(years))
            .select(
                F.concat(F.lit("SET"), F.col("order_key").cast("string"), F.lit("-"), F.col("year").cast("string")).alias("settlement_id"),
                "awb_number",
                _run(F.col("year")).alias("batch_id"),
                "courier_id",
                F.date_add("order_date", days.cast("int")).alias("settlement_date"),
                (cod * ((100 - kept_back).cast("decimal(5,0)") * F.expr("0.01BD"))).cast("decimal(12,2)").alias("settled_cod"),
                (weight * ((200 + 3 * F.col("tax")).cast("decimal(5,0)") * F.expr("0.005BD")))
                .cast("decimal(8,3)")
                .alias("charged_weight"),
                (slab * ((200 + F.col("units")).cast("decimal(5,0)") * F.expr("0.005BD"))).cast("decimal(10,2)").alias("forward_charge"),
                F.when(F.col("returned"), F.floor(F.col("least_price") / 100)).otherwise(0).cast("decimal(10,2)").alias("rto_charge"),
                (cod * F.expr("0.015BD")).cast("decimal(10,2)").alias("cod_fee"),
            )
        )

    def tariffs(self) -> DataFrame:
        """Rates that couriers announce: every ninety-seventh order's date is one's effective date."""
        key = F.col("o_orderkey")
        return self.given("orders").where(key % 97 == 0).select(
            (key % 5 + 1).cast("int").alias("courier_id"),
            F.col("o_orderdate").cast("date").alias("effective_from"),
            (30 + key % 61).cast("decimal(10,2)").alias("agreed_rate"),
        )

    def seasons(self) -> DataFrame:
        """Seasons of couriers around every eighty-third order: of days, of weeks, and a few of years."""
        key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        length = F.when(key % 10 == 0, 1500).otherwise(key % 40)
        return self.given("orders").where(key % 83 == 0).select(
            (key % 5 + 1).cast("int").alias("courier_id"),
            F.date_sub(day, 3).alias("season_start"),
            F.date_add(day, length.cast("int")).alias("season_end"),
        )

    # -- marketplace -------------------------------------------------------------------------------

    def market_orders(self) -> DataFrame:
        key, placed = F.col("o_orderkey"), F.col("o_orderdate")
        done = F.col("o_orderstatus").isin("F", "P")
        hours = (24 * ((key * 7) % 33) + key % 24).cast("int")
        arrived = placed + F.make_dt_interval(hours=hours)
        return self.given("orders").select(
            _text("O", key).alias("order_id"),
            _text("C", F.col("o_custkey")).alias("customer_id"),
            F.when(done, "delivered").otherwise("shipped").alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            F.when(done & (key % 97 != 0), arrived).alias("order_delivered_customer_date"),
            (placed + F.make_dt_interval(hours=F.lit(720))).alias("order_estimated_delivery_date"),
        )

    def market_items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return self.given("lineitem").select(
            _text("O", F.col("l_orderkey")).alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            _text("S", F.col("l_suppkey")).alias("seller_id"),
            price.alias("price"),
            (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)").alias("freight_value"),
        )

    def market_payments(self) -> DataFrame:
        surcharge = F.when(F.substring("order_id", 2, 30).cast("long") % 40 == 0, F.expr("5.25BD")).otherwise(
            F.expr("0.00BD")
        )
        return (
            self.market_items()
            .groupBy("order_id")
            .agg(F.sum(F.col("price") + F.col("freight_value")).alias("bill"))
            .select(
                "order_id",
                F.lit(1).alias("payment_sequential"),
                (F.col("bill") + surcharge).cast("decimal(22,2)").alias("payment_value"),
            )
        )

    def market_reviews(self) -> DataFrame:
        """A review of every line. Some titles are one character beyond U+FFFF, messages run over lines or are blank."""
        score = 1 + (F.col("l_quantity").cast("int") + F.col("l_orderkey")) % 5
        review = F.concat(F.lit("R"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        message = F.concat(F.col("l_returnflag"), F.lit('\nsaid "yes", \U0001f600'), F.col("l_linestatus"))
        return self.given("lineitem").select(
            review.alias("review_id"),
            _text("O", F.col("l_orderkey")).alias("order_id"),
            score.cast("int").alias("review_score"),
            F.when(F.col("l_discount") > 0, F.col("l_returnflag")).otherwise("\U0001f600").alias("review_comment_title"),
            F.when(F.col("l_tax") > 0, message).otherwise("  ").alias("review_comment_message"),
            F.col("l_shipdate").alias("review_creation_date"),
        )
