"""Report measures over the mart, the discrepancies and the scorecard, under optional slicers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numbers import ratio
from remitlens.operators.reconcile import list_discrepancies
from remitlens.plans.kpis import courier_rates, union_one_row
from remitlens.plans.warehouse import Warehouse
from remitlens.settings import SCORE


def measures_overview(wh: Warehouse, mart: DataFrame, courier: str | None = None, tier: str | None = None,
                      severity: str | None = None) -> DataFrame:
    """All measures on one row. Courier and tier slice every table that has them, severity the discrepancies."""

    def sliced(df: DataFrame) -> DataFrame:
        # Only the tables a slicer needs are joined.
        if courier is not None:
            df = wh.named_courier(df).where(F.col("courier_name") == courier)
        if tier is not None:
            df = wh.with_tier(df).where(F.col("tier") == tier)
        return df

    found = sliced(list_discrepancies(wh.outcomes.where(F.col("dispute_count") > 0)))
    if severity is not None:
        found = found.where(F.col("severity") == severity)
    tiers = wh.geography.select("geo_id", F.col("tier").alias("place_tier"))
    amount = F.col("variance_rs")
    per_awb = found.join(tiers, "geo_id").groupBy("awb_number").agg(
        F.sum(amount).alias("leakage_rs"),
        F.sum(F.when(F.col("severity") == "HIGH", amount)).alias("high"),
        F.sum(F.when(F.col("place_tier") == "Tier-3", amount)).alias("tier3"),
    )
    leaked = per_awb.agg(
        F.sum("leakage_rs").alias("total_leakage"),
        F.count(F.lit(1)).alias("disputed_awbs"),
        F.sum("high").alias("high_risk_leakage"),
        F.sum("tier3").alias("tier3_leakage"),
    )
    settled = sliced(mart).agg(F.sum("orders").alias("settled_awbs"), F.avg("avg_dso_days").alias("avg_dso"))
    rates = courier_rates(wh)
    if courier is not None:
        rates = rates.where(F.col("courier_name") == courier)
    score = rates.agg(
        (
            SCORE.on_time * F.avg("ontime")
            + SCORE.clean * (1 - F.avg("dispute"))
            + SCORE.no_phantom * (1 - F.avg("phantom"))
        ).alias("reliability_score")
    )
    return union_one_row([leaked, settled, score]).select(
        "total_leakage",
        "disputed_awbs",
        "settled_awbs",
        ratio(F.col("disputed_awbs"), F.col("settled_awbs")).alias("dispute_pct"),
        "avg_dso",
        "high_risk_leakage",
        ratio(F.col("tier3_leakage"), F.col("total_leakage")).alias("tier3_leakage_pct"),
        "reliability_score",
    )


def leakage_vs_week_before(mart: DataFrame) -> DataFrame:
    """Leakage by day against the day seven days earlier; one row per day on either side of the join."""
    by_day = mart.groupBy("kpi_date").agg(F.sum("leakage_rs").alias("leakage_rs"))
    earlier = by_day.select(F.date_add("kpi_date", 7).alias("kpi_date"), F.col("leakage_rs").alias("prev_leakage_rs"))
    change = ratio(F.col("leakage_rs") - F.col("prev_leakage_rs"), F.col("prev_leakage_rs"))
    return by_day.join(earlier, "kpi_date", "left").withColumn("change", change)
