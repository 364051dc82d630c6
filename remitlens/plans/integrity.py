"""Lists of single settlements: duplicates, overdue, short and overweight ones; delivery-time adherence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numbers import half_up, percent, ratio
from remitlens.functions.pricing import is_cod_short, is_overweight
from remitlens.operators.ordering import grouped_row_number
from remitlens.plans.warehouse import Warehouse
from remitlens.settings import RULES


def duplicate_awbs(wh: Warehouse) -> DataFrame:
    """Every copy of an AWB that was settled more than once, numbered by date within its AWB."""
    # Copies are counted on the outcomes already, and a group of copies may be large: it is numbered by
    # slices, never as one window partition.
    copies = wh.outcomes.where(F.col("copies") > 1).select(
        "awb_number", "batch_id", "courier_id", "settlement_date", "settlement_id", F.col("copies").alias("cnt")
    )
    order = [F.col("settlement_date"), F.col("batch_id"), F.col("settlement_id")]
    numbered = grouped_row_number(copies, ["awb_number"], order, "rn")
    return wh.named_courier(numbered).select("awb_number", "batch_id", "courier_name", "settlement_date", "rn", "cnt")


def overdue_list(wh: Warehouse, limit: int = 100) -> DataFrame:
    days = F.datediff("settlement_date", "order_date")
    late = wh.outcomes.where(days > RULES.overdue_days).select(
        "awb_number", "batch_id", "courier_id", "order_date", "settlement_date", days.alias("dso_days"), "settled_cod"
    )
    return (
        wh.named_courier(late)
        .drop("courier_id")
        .orderBy(F.col("dso_days").desc(), "awb_number", "batch_id")
        .limit(limit)
    )


def cod_short_list(wh: Warehouse, limit: int = 100) -> DataFrame:
    cod, settled = F.col("cod_amount"), F.col("settled_cod")
    short = wh.outcomes.where(is_cod_short(cod, settled)).select(
        "awb_number",
        "batch_id",
        "order_courier_id",
        cod.alias("expected_cod"),
        settled.alias("actual_cod"),
        (cod - settled).alias("shortfall_rs"),
    )
    return (
        wh.named_courier(short, "order_courier_id")
        .drop("order_courier_id")
        .orderBy(F.col("shortfall_rs").desc(), "awb_number", "batch_id")
        .limit(limit)
    )


def weight_list(wh: Warehouse, limit: int = 100) -> DataFrame:
    declared, charged = F.col("declared_weight"), F.col("charged_weight")
    heavy = wh.outcomes.where(is_overweight(declared, charged)).select(
        "awb_number",
        "batch_id",
        "order_courier_id",
        "geo_id",
        "declared_weight",
        "charged_weight",
        percent(charged - declared, declared, 1).alias("inflate_pct"),
        "forward_charge",
    )
    return (
        wh.with_tier(wh.named_courier(heavy, "order_courier_id"))
        .drop("order_courier_id", "geo_id")
        .orderBy(F.col("inflate_pct").desc(), "awb_number", "batch_id")
        .limit(limit)
    )


def eta_adherence(wh: Warehouse) -> DataFrame:
    """Delivery times by courier and tier; equal times are counted before the exact percentiles."""
    actual, promised = F.col("actual_eta_hrs"), F.col("promised_eta_hrs")
    counted = (
        wh.orders.where((F.col("order_status") == "DELIVERED") & actual.isNotNull())
        .groupBy("courier_id", "geo_id", "actual_eta_hrs", "promised_eta_hrs")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.col("n")
    spread = F.percentile(actual.cast("double"), F.array(F.lit(0.5), F.lit(0.95)), n)
    return (
        wh.with_tier(wh.named_courier(counted))
        .groupBy("courier_name", "tier")
        .agg(
            F.sum("n").alias("delivered"),
            F.sum((actual - promised) * n).alias("delay"),
            spread.alias("p"),
            F.sum(F.when(actual <= promised, n).otherwise(0)).alias("met"),
        )
        .select(
            "courier_name",
            "tier",
            "delivered",
            half_up(ratio(F.col("delay"), F.col("delivered")), 1).alias("avg_delay_hrs"),
            F.col("p")[0].alias("p50_eta"),
            F.col("p")[1].alias("p95_eta"),
            percent(F.col("met"), F.col("delivered"), 1).alias("sla_met_pct"),
        )
    )
