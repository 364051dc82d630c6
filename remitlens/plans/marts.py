"""The daily KPI mart and its refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numbers import ratio
from remitlens.operators.upsert import merge_rows
from remitlens.plans.kpis import joined_rows
from remitlens.plans.warehouse import Warehouse

MART_KEYS = ["kpi_date", "courier_id", "geo_id"]


def daily_kpis(wh: Warehouse) -> DataFrame:
    """Orders, disputed AWBs, leakage and mean days to settle by day, courier and place.

    AWBs are folded within a cell first, so the distinct counts need no row expansion.
    """
    days, weight = F.datediff("settlement_date", "order_date"), joined_rows()
    per_awb = (
        wh.outcomes.where(F.col("has_order"))
        .groupBy(F.col("settlement_date").alias("kpi_date"), "courier_id", "geo_id", "awb_number")
        .agg(
            F.max((F.col("dispute_count") > 0).cast("int")).alias("disputed"),
            F.sum("leakage_rs").alias("leakage_rs"),
            F.sum(days * weight).alias("days"),
            F.sum(weight).alias("weight"),
        )
    )
    return per_awb.groupBy(*MART_KEYS).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("disputed").alias("disputed_awbs"),
        F.sum("leakage_rs").cast("decimal(24,2)").alias("leakage_rs"),
        ratio(F.sum("days"), F.sum("weight")).cast("decimal(8,2)").alias("avg_dso_days"),
    )


def upsert_daily_kpis(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Cells of ``fresh`` replace stored ones; stored cells without a fresh one stay."""
    return merge_rows(stored, fresh, MART_KEYS)


def kpi_daily_export(wh: Warehouse, mart: DataFrame) -> DataFrame:
    places = wh.geography.select("geo_id", "city", "tier")
    return wh.named_courier(mart).join(places, "geo_id").select(
        "kpi_date", "courier_name", "city", "tier", "orders", "disputed_awbs", "leakage_rs", "avg_dso_days"
    )


def discrepancies_export(wh: Warehouse, discrepancies: DataFrame | None = None) -> DataFrame:
    rows = wh.discrepancies if discrepancies is None else discrepancies
    extra = ["detected_at"] if "detected_at" in rows.columns else []
    places = wh.geography.select("geo_id", "city", "tier")
    return wh.named_courier(rows).join(places, "geo_id").select(
        "awb_number", "batch_id", "courier_name", "merchant_id", "city", "tier", "discrepancy_type",
        "expected_value", "actual_value", "variance_rs", "severity", *extra,
    )
