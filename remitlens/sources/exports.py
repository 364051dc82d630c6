"""Named aggregates for the serving layer and the report tool."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numbers import half_even
from remitlens.plans import forecast, kpis, marketplace, marts, segments
from remitlens.plans.marketplace import Marketplace
from remitlens.plans.warehouse import Warehouse
from remitlens.session import written

Build = Callable[[], DataFrame]
Builders = dict[str, Build]


def health_of(wh: Warehouse) -> Build:
    """Merchant health, computed and written when first asked for, for exports that share it."""
    return cache(lambda: written(segments.merchant_health(wh), "merchant-health"))


def serving_frames(wh: Warehouse, health: Build | None = None) -> Builders:
    """What the dashboard reads, one small aggregate per name; orders meet their discrepancies once for all of them.

    The headline figures are computed once for themselves and the funnel. ``health`` brings merchant health where other
    exports hold it too.
    """
    joined = cache(lambda: kpis.with_disputed(wh))
    header = cache(lambda: written(kpis.header_kpis(wh), "header"))
    return {
        "kpis": header,
        "trend": lambda: kpis.weekly_trend(wh),
        "pareto": lambda: kpis.pareto_couriers(wh, rounded=half_even),
        "funnel": lambda: kpis.funnel(wh, header()),
        "scorecard": lambda: kpis.courier_scorecard_frame(joined(), 1),
        "rca_cells": lambda: kpis.rca_cells(wh, 60, rounded=half_even),
        "merchants": health or (lambda: segments.merchant_health(joined())),
        "tier_entry": lambda: kpis.tier_entry(joined()).drop("leakage_pct_of_gmv", "avg_delay_hrs"),
        "forecast": lambda: forecast.actual_and_forecast(forecast.weekly_series(wh)),
    }


def report_frames(wh: Warehouse, mart: DataFrame, health: Build | None = None) -> Builders:
    """What the report tool loads as CSV."""
    joined = cache(lambda: kpis.with_disputed(wh))
    return {
        "kpi_daily": lambda: marts.kpi_daily_export(wh, mart),
        "discrepancies": lambda: marts.discrepancies_export(wh),
        "courier_scorecard": lambda: kpis.courier_scorecard_frame(joined(), 1),
        "merchant_health": health or (lambda: segments.merchant_health(joined())),
    }


def market_frames(m: Marketplace) -> Builders:
    return {
        "review_impact": lambda: marketplace.review_impact_latest(m),
        "monthly": lambda: marketplace.monthly_late(m).drop("month"),
        "seller_late": lambda: marketplace.seller_late(m),
        "validation": lambda: marketplace.validation_summary(m),
    }


def write_json(frames: Builders, folder: str) -> None:
    for name, build in frames.items():
        build().write.mode("overwrite").json(f"{folder}/{name}")


def write_csv(frames: Builders, folder: str) -> None:
    """Dates as ISO text, as the report tool reads them."""
    for name, build in frames.items():
        build().write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(f"{folder}/{name}")


def bundle_sizes(spark, folder: str, names: list[str], fmt: str) -> DataFrame:
    """Rows per written export."""
    counts = None
    for name in names:
        rows = spark.read.format(fmt).option("header", True).load(f"{folder}/{name}")
        one = rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("export_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
