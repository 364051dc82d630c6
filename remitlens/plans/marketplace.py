"""The rules carried over to the marketplace data set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.functions.calendar import fractional_days, month_date, month_id
from remitlens.functions.numbers import half_up, ratio
from remitlens.operators.ordering import exact_quantiles
from remitlens.plans.hypotheses import chi2_2x2
from remitlens.plans.kpis import union_one_row
from remitlens.session import written
from remitlens.sources.benchmark_tables import BenchmarkTables

# Fixed values of the checks.
MISMATCH_ABOVE = 1.0
BAD_SCORE = 3
MIN_SELLER_ITEMS = 50
OUTLIER_QUANTILE = 0.99


class Marketplace:
    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame


@dataclass(frozen=True)
class LoadedMarketplace(Marketplace):
    """A marketplace over frames at hand."""

    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame


class BenchmarkMarketplace(Marketplace):
    """The marketplace derived from the given tables of one scale; a query plans the tables it reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.tables = BenchmarkTables(spark, folder)

    @property
    def orders(self) -> DataFrame:
        return self.tables.market_orders()

    @property
    def items(self) -> DataFrame:
        return self.tables.market_items()

    @property
    def payments(self) -> DataFrame:
        return self.tables.market_payments()

    @property
    def reviews(self) -> DataFrame:
        return self.tables.market_reviews()


def _late() -> Column:
    """Delivered after the estimate; not late if either moment is unknown."""
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return F.coalesce(delivered > estimated, F.lit(False))


def delivered_orders(m: Marketplace) -> DataFrame:
    return m.orders.where(F.col("order_status") == "delivered").withColumn("late", _late())


def late_rate(m: Marketplace) -> DataFrame:
    days = fractional_days(F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date"))
    return delivered_orders(m).agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if("late").alias("late_n"),
        half_up(ratio(F.count_if("late"), F.count(F.lit(1))), 4).alias("late_rate"),
        half_up(F.avg(F.when(F.col("late"), days)), 4).alias("avg_late_days"),
    )


def billed_and_paid(m: Marketplace) -> DataFrame:
    """Bill and payment per order; both sides are folded before the join."""
    bill = m.items.groupBy("order_id").agg(F.sum("price").alias("price"), F.sum("freight_value").alias("freight"))
    paid = m.payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    return bill.join(paid, "order_id").withColumn("diff", F.col("paid") - F.col("price") - F.col("freight"))


def payment_mismatch(bills: DataFrame) -> DataFrame:
    """Orders whose payments differ from the bill, over ``billed_and_paid`` rows."""
    gap = F.abs("diff")
    off = gap > F.lit(MISMATCH_ABOVE)
    return bills.agg(
        F.count(F.lit(1)).alias("billed_orders"),
        F.count_if(off).alias("mismatches"),
        half_up(ratio(F.count_if(off), F.count(F.lit(1))), 4).alias("mismatch_rate"),
        F.coalesce(F.sum(F.when(off, gap)), F.lit(0)).alias("mismatch_value"),
    )


def freight_outliers(bills: DataFrame) -> DataFrame:
    """Orders whose freight share lies above the exact 99th percentile; reads ``bills`` twice."""
    ratios = bills.select(ratio(F.col("freight"), F.col("price")).alias("fr_ratio"))
    cut = exact_quantiles(ratios, "fr_ratio", {"cut": OUTLIER_QUANTILE}).scalar()
    above = F.col("fr_ratio") > F.col("_cut")
    return ratios.withColumn("_cut", cut).agg(
        F.round(F.max("_cut"), 6).alias("cut"),
        F.count_if(above).alias("outliers"),
        F.round(F.avg(F.when(above, F.col("fr_ratio"))), 6).alias("avg_outlier_ratio"),
    )


def first_review_per_order(m: Marketplace) -> DataFrame:
    """The earliest review of each order; undated reviews come last."""
    order = F.struct(
        F.col("review_creation_date").isNull().alias("undated"), "review_creation_date", "review_id", "review_score"
    )
    return m.reviews.groupBy("order_id").agg(F.min(order)["review_score"].alias("review_score"))


def latest_review_per_id(m: Marketplace) -> DataFrame:
    """The latest version of each review; undated versions come last."""
    order = F.struct("review_creation_date", "review_score", "order_id")
    return m.reviews.groupBy("review_id").agg(F.max(order).alias("best")).select("review_id", "best.*")


def _is_bad() -> Column:
    return F.col("review_score") <= BAD_SCORE


def review_impact_first(m: Marketplace) -> DataFrame:
    """Bad-review shares of late and on-time orders, first review per order, with the independence test."""
    reviewed = delivered_orders(m).select("order_id", "late").join(first_review_per_order(m), "order_id")
    tested = chi2_2x2(reviewed, F.col("late"), _is_bad())
    return tested.select(
        F.col("yes_yes").alias("late_bad"),
        F.col("yes_no").alias("late_good"),
        F.col("no_yes").alias("ontime_bad"),
        F.col("no_no").alias("ontime_good"),
        half_up(ratio(F.col("yes_yes"), F.col("yes_yes") + F.col("yes_no")), 4).alias("bad_review_late"),
        half_up(ratio(F.col("no_yes"), F.col("no_yes") + F.col("no_no")), 4).alias("bad_review_ontime"),
        "chi2",
        "p_value",
    )


def review_impact_latest(m: Marketplace) -> DataFrame:
    """Reviews by lateness and sentiment, latest version per review; reviews fold per order before the join."""
    per_order = (
        latest_review_per_id(m)
        .groupBy("order_id", F.when(_is_bad(), "Bad").otherwise("Good").alias("sentiment"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        delivered_orders(m)
        .select("order_id", F.when(F.col("late"), "Late").otherwise("On-time").alias("late_flag"))
        .join(per_order, "order_id")
        .groupBy("late_flag", "sentiment")
        .agg(F.sum("n").alias("orders"))
    )


def review_pivot(m: Marketplace) -> DataFrame:
    return (
        review_impact_latest(m)
        .groupBy("late_flag")
        .pivot("sentiment", ["Bad", "Good"])
        .agg(F.sum("orders"))
        .na.fill(0, ["Bad", "Good"])
    )


def review_mix(m: Marketplace) -> DataFrame:
    """Each lateness-sentiment group with its share of all orders."""
    all_orders = m.orders.agg(F.count(F.lit(1))).scalar()
    return review_impact_latest(m).select(
        F.concat_ws(" · ", "late_flag", "sentiment").alias("name"),
        F.col("orders").alias("value"),
        half_up(100 * ratio(F.col("orders"), all_orders), 1).alias("share_pct"),
    )


def seller_late(m: Marketplace, min_items: int = MIN_SELLER_ITEMS) -> DataFrame:
    """Late share per seller over its items; items fold per order and seller before the join."""
    sold = m.items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("n"))
    late_items = F.sum(F.when(F.col("late"), F.col("n")).otherwise(0))
    return (
        sold.join(delivered_orders(m).select("order_id", "late"), "order_id")
        .groupBy("seller_id")
        .agg(F.sum("n").alias("orders"), ratio(late_items, F.sum("n")).alias("late_rate"))
        .where(F.col("orders") >= min_items)
        .orderBy(F.col("late_rate").desc(), "seller_id")
    )


def worst_sellers(m: Marketplace, limit: int = 10) -> DataFrame:
    return seller_late(m).limit(limit)


def monthly_late(m: Marketplace) -> DataFrame:
    """Orders by month of purchase; the mean of late days is cut to whole days."""
    days = F.datediff("order_delivered_customer_date", "order_estimated_delivery_date")
    late_days = F.sum(F.when(F.col("late"), days))
    late_orders = F.count_if("late")
    return (
        delivered_orders(m)
        .groupBy(month_id(F.col("order_purchase_timestamp")).alias("ym"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            late_orders.alias("late_orders"),
            F.floor(late_days / F.nullif(late_orders, F.lit(0))).alias("avg_late_days"),
        )
        .withColumn("month", month_date(F.col("ym")))
        .orderBy("ym")
    )


def validation_summary(m: Marketplace) -> DataFrame:
    """The marketplace checks on one row."""
    sellers = seller_late(m).agg(
        F.count(F.lit(1)).alias("sellers_scored"), half_up(F.max("late_rate"), 4).alias("worst_seller_late_rate")
    )
    bills = written(billed_and_paid(m).drop("order_id"), "bills")
    reviews = review_impact_first(m).select("bad_review_late", "bad_review_ontime", F.col("p_value").alias("chi2_p"))
    return union_one_row(
        [
            m.orders.agg(F.count(F.lit(1)).alias("orders")),
            late_rate(m).select("late_rate", "late_n"),
            payment_mismatch(bills).select("mismatch_rate", F.round("mismatch_value", 0).alias("mismatch_value")),
            freight_outliers(bills).select(F.col("outliers").alias("freight_outliers")),
            reviews,
            sellers,
        ]
    )


def market_measures(m: Marketplace) -> DataFrame:
    """Late rate, bad-review rates and their gap, as ratios of sums."""
    late = monthly_late(m).agg(ratio(F.sum("late_orders"), F.sum("orders")).alias("late_rate"))
    counted = review_impact_latest(m)

    def bad_rate(flag: str) -> Column:
        here = F.col("late_flag") == flag
        bad = F.sum(F.when(here & (F.col("sentiment") == "Bad"), F.col("orders")))
        return ratio(bad, F.sum(F.when(here, F.col("orders"))))

    reviews = counted.agg(bad_rate("Late").alias("bad_rate_late"), bad_rate("On-time").alias("bad_rate_ontime"))
    return union_one_row([late, reviews]).withColumn(
        "review_lift", F.col("bad_rate_late") - F.col("bad_rate_ontime")
    )
