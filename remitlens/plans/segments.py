"""Merchant segments and merchant health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions.calendar import week_start
from remitlens.functions.numbers import half_up, ratio, tile_of
from remitlens.operators.ordering import exact_quantiles, global_ntile
from remitlens.plans.kpis import disputed_orders, joined_rows
from remitlens.plans.warehouse import Warehouse
from remitlens.session import written

# Fixed values of the health bands.
HIGH_RISK, WATCHLIST, TOP_OF_SCALE = 0.30, 0.15, 2.0


def health_band(rate: Column) -> Column:
    return F.when(rate > HIGH_RISK, "high-risk").when(rate > WATCHLIST, "watchlist").otherwise("healthy")


def health_cut(rate: Column) -> Column:
    """The bands as right-closed intervals with an end: a rate beyond it has no band."""
    return F.when(rate <= TOP_OF_SCALE, health_band(rate))


def quartile_cut(value: Column, limits: DataFrame) -> Column:
    """Right-closed quartile label from a one-row frame of limits q1, q2, q3; the top quarter is Q1."""
    low, middle, high = (limits.select(q).scalar() for q in ("q1", "q2", "q3"))
    return F.when(value <= low, "Q4").when(value <= middle, "Q3").when(value <= high, "Q2").otherwise("Q1")


def merchant_totals(wh: Warehouse, grain: str = "joined") -> DataFrame:
    """Orders, order value, leakage and dispute share per merchant."""
    weight = joined_rows(grain)
    disputes = F.col("dispute_count") if grain == "joined" else (F.col("dispute_count") > 0).cast("int")
    totals = disputed_orders(wh).groupBy("merchant_id").agg(
        F.sum(weight).alias("orders"),
        F.sum(F.col("order_value") * weight).alias("gmv"),
        F.sum("leakage_rs").alias("leakage_rs"),
        F.sum(disputes).alias("disputes"),
    )
    return totals.withColumn("dispute_rate", ratio(F.col("disputes"), F.col("orders"))).drop("disputes")


def _segment_columns(quartile: Column) -> list:
    rate = F.col("dispute_rate")
    return [
        "merchant_id",
        "orders",
        "gmv",
        "leakage_rs",
        half_up(rate * 100, 1).alias("dispute_pct"),
        quartile.cast("long").alias("value_quartile"),
        health_band(rate).alias("health_band"),
    ]


def merchant_segments(wh: Warehouse, limit: int = 50, grain: str = "joined") -> DataFrame:
    """The merchants with the largest order value, with their value quartile among all merchants.

    A merchant in the top list has its place in the list as row number, so its tile needs the number of
    merchants only and no ordering of all of them.
    """
    merchants = wh.orders.select("merchant_id").distinct().agg(F.count(F.lit(1))).scalar()
    top = merchant_totals(wh, grain).orderBy(F.col("gmv").desc(), "merchant_id").limit(limit)
    place = F.row_number().over(Window.orderBy(F.col("gmv").desc(), "merchant_id"))
    return (
        top.withColumn("_rn", place)
        .select(*_segment_columns(tile_of(F.col("_rn"), merchants, 4)))
        .orderBy(F.col("gmv").desc(), "merchant_id")
    )


def merchant_quartiles(wh: Warehouse, grain: str = "joined") -> DataFrame:
    """All merchants with their value quartile, ordered globally by ranges."""
    order = [F.col("gmv").desc(), F.col("merchant_id")]
    return global_ntile(merchant_totals(wh, grain), order, 4, "_tile").select(*_segment_columns(F.col("_tile")))


def merchant_health(wh: Warehouse) -> DataFrame:
    """Merchants with quantile-threshold quartiles and right-closed health bands."""
    totals = written(merchant_totals(wh), "merchant-totals")
    limits = exact_quantiles(totals, "gmv", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return totals.join(wh.merchants.select("merchant_id", "category"), "merchant_id").select(
        "merchant_id",
        "category",
        "orders",
        "gmv",
        "leakage_rs",
        "dispute_rate",
        quartile_cut(F.col("gmv").cast("double"), limits).alias("value_quartile"),
        health_cut(F.col("dispute_rate")).alias("health"),
    )


def merchant_retention(wh: Warehouse, weeks: int = 4) -> DataFrame:
    """Share of merchants that ship in the week ``weeks`` after the week of their first dispute."""
    first = (
        wh.outcomes.where(F.col("dispute_count") > 0)
        .groupBy("merchant_id")
        .agg(F.min("settlement_date").alias("first"))
        .select("merchant_id", F.date_add(week_start(F.col("first")), 7 * weeks).alias("wk"))
    )
    active = wh.orders.select("merchant_id", week_start(F.col("order_date")).alias("wk")).distinct()
    return (
        first.join(active.withColumn("kept", F.lit(1)), ["merchant_id", "wk"], "left")
        .agg(F.count(F.lit(1)).alias("disputed_merchants"), F.coalesce(F.sum("kept"), F.lit(0)).alias("retained"))
        .withColumn("retention_pct", half_up(100 * ratio(F.col("retained"), F.col("disputed_merchants")), 2))
    )
