"""Questions about what was in force, and about seasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.operators.temporal import as_of_join, interval_join

#: Fixed value: the interval after an order in which a remittance is overdue but not yet long overdue, in days.
OVERDUE_DAYS = (15, 28)


def charged_and_agreed(settlements: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Every settlement with the tariff of its courier in force on its date, and what it was charged beyond.

    ``tariffs`` has ``courier_id``, ``effective_from`` and ``agreed_rate``. Before a courier's first tariff there is none.
    """
    joined = as_of_join(settlements, tariffs, ["courier_id"], "settlement_date", "effective_from")
    beyond = F.greatest(F.col("forward_charge") - F.col("agreed_rate"), F.lit(0).cast("decimal(10,2)"))
    return joined.select(
        "settlement_id", "courier_id", "settlement_date", "effective_from", "agreed_rate",
        F.when(F.col("agreed_rate").isNotNull(), beyond).alias("beyond_rs"),
    )


def seasons_kpis(outcome_rows: DataFrame, seasons: DataFrame) -> DataFrame:
    """Settlements, disputes and leakage within each season of a courier (``courier_id``, ``season_start``, ``season_end``).

    Seasons may overlap, and be of any length; one without settlements is left out.
    """
    rows = outcome_rows.select("settlement_id", "courier_id", "settlement_date", "dispute_count", "leakage_rs")
    keys = ["courier_id", "season_start", "season_end"]
    # Folded by day first: a season takes whole days.
    daily = rows.groupBy("courier_id", "settlement_date").agg(
        F.count(F.lit(1)).alias("settlements"), F.sum("dispute_count").alias("disputes"), F.sum("leakage_rs").alias("leakage_rs")
    )
    joined = interval_join(daily, seasons.select(*keys).distinct(), ["courier_id"], "settlement_date", "season_start", "season_end")
    return joined.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("settlements", "disputes", "leakage_rs")])


def overdue_settlements(settlements: DataFrame, orders: DataFrame) -> DataFrame:
    """Settlements that lie in their order's interval of being overdue."""
    first, last = OVERDUE_DAYS
    due = orders.select(
        "awb_number", F.date_add("order_date", first).alias("overdue_from"), F.date_add("order_date", last).alias("overdue_to")
    )
    rows = settlements.select("settlement_id", "awb_number", "settlement_date", "settled_cod")
    # All intervals are of one length; bins of it hold an interval in two at most.
    return interval_join(rows, due, ["awb_number"], "settlement_date", "overdue_from", "overdue_to", last - first + 1)


def trailing_leakage(outcome_rows: DataFrame, days: int = 7) -> DataFrame:
    """By courier and day with settlements: disputes and leakage of that day and the days before it, ``days`` in all.

    Rows fold by day first, so the frame, which is one of values and not of rows, slides over days: gaps count as nothing.
    """
    daily = outcome_rows.where(F.col("settlement_date").isNotNull()).groupBy("courier_id", F.col("settlement_date").alias("day")).agg(
        F.sum("dispute_count").alias("disputes"), F.sum("leakage_rs").alias("leakage_rs")
    )
    back = Window.partitionBy("courier_id").orderBy(F.unix_date("day")).rangeBetween(1 - days, 0)
    return daily.select(
        "courier_id", "day", "disputes", "leakage_rs",
        F.sum("disputes").over(back).alias("trailing_disputes"), F.sum("leakage_rs").over(back).alias("trailing_leakage_rs"),
        F.max("leakage_rs").over(back).alias("worst_day_rs"),
    )


def booked_and_settled(orders: DataFrame, settlements: DataFrame) -> DataFrame:
    """By courier and month: cash to collect on orders of the month, and cash settled in it; either may be missing.

    Both facts fold before they meet, so the full join is of months.
    """
    month = lambda day: F.date_format(day, "yyyy-MM").alias("month")
    booked = orders.groupBy("courier_id", month("order_date")).agg(F.sum("cod_amount").alias("booked_rs"))
    settled = settlements.groupBy("courier_id", month("settlement_date")).agg(F.sum("settled_cod").alias("settled_rs"))
    none = F.lit(0).cast("decimal(22,2)")
    return booked.join(settled, ["courier_id", "month"], "full").withColumn(
        "open_rs", F.coalesce("booked_rs", none) - F.coalesce("settled_rs", none)
    )
