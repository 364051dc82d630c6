"""Headline figures, trends, scorecards and drill-down cells.

Settlement-grain queries read outcomes: a settlement with n discrepancies stands for max(n, 1) joined
rows. Order-grain queries fold discrepancies per AWB and weight each order in the same way. With
``grain="settlement"`` or ``grain="order"`` every row counts once instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions.calendar import week_start
from remitlens.functions.numbers import average_rank, half_even, half_up, percent, ratio
from remitlens.operators.reconcile import list_discrepancies
from remitlens.plans.warehouse import LoadedWarehouse, Warehouse
from remitlens.session import written
from remitlens.settings import SCORE, ScoreWeights


Rounding = Callable[[Column, int], Column]


def joined_rows(grain: str = "joined") -> Column:
    """How many rows of the settlement-discrepancy (or order-discrepancy) join a row stands for."""
    if grain == "joined":
        return F.greatest(F.col("dispute_count"), F.lit(1))
    return F.lit(1)


def disputes_by_awb(outcome_rows: DataFrame) -> DataFrame:
    """Discrepancies folded per AWB."""
    # A rule fires at most once per settlement; the test reads the array's type field only.
    phantom = F.array_contains("disputes.discrepancy_type", "PHANTOM_RTO_CHARGE").cast("int")
    return (
        outcome_rows.where(F.col("dispute_count") > 0)
        .groupBy("awb_number")
        .agg(
            F.sum("dispute_count").alias("dispute_count"),
            F.sum(phantom).alias("phantom_count"),
            F.sum("leakage_rs").alias("leakage_rs"),
        )
    )


def disputed_orders(wh: Warehouse) -> DataFrame:
    """Orders left-joined with their folded discrepancies."""
    if wh.disputed is not None:
        return wh.disputed
    return (
        wh.orders.join(disputes_by_awb(wh.outcomes), "awb_number", "left")
        .withColumn("dispute_count", F.coalesce("dispute_count", F.lit(0)))
        .withColumn("phantom_count", F.coalesce("phantom_count", F.lit(0)))
        .withColumn("leakage_rs", F.coalesce("leakage_rs", F.lit(0)))
    )


#: What scorecards, tiers and merchants read of an order and its discrepancies.
_DISPUTED_COLUMNS = (
    "courier_id", "merchant_id", "geo_id", "order_value", "promised_eta_hrs", "actual_eta_hrs",
    "dispute_count", "phantom_count", "leakage_rs",
)


def with_disputed(wh: Warehouse) -> Warehouse:
    """The warehouse with what is read of that join written once, for runs that read it more than once."""
    if wh.disputed is not None:
        return wh
    frames = (wh.couriers, wh.geography, wh.merchants, wh.dates, wh.orders, wh.outcomes)
    return LoadedWarehouse(*frames, written(disputed_orders(wh).select(*_DISPUTED_COLUMNS), "disputed"))


# -- header and trends -----------------------------------------------------------------------------


def header_kpis(wh: Warehouse) -> DataFrame:
    """Settled and disputed AWBs, dispute rate and leakage, with the mean days to settle."""
    days = F.datediff("settlement_date", "order_date")
    weight = joined_rows()
    per_awb = wh.outcomes.groupBy("awb_number").agg(
        F.max((F.col("dispute_count") > 0).cast("int")).alias("disputed"),
        F.sum("leakage_rs").alias("leakage_rs"),
        F.sum(days * weight).alias("days"),
        F.sum(F.when(F.col("has_order"), weight)).alias("dated"),
    )
    total = per_awb.agg(
        F.count(F.lit(1)).alias("settled_awbs"),
        F.coalesce(F.sum("disputed"), F.lit(0)).alias("disputed_awbs"),
        F.coalesce(F.sum("leakage_rs"), F.lit(0)).alias("leakage_rs"),
        F.sum("days").alias("days"),
        F.sum("dated").alias("dated"),
    )
    return total.select(
        "settled_awbs",
        "disputed_awbs",
        percent(F.col("disputed_awbs"), F.col("settled_awbs"), 2).alias("dispute_rate_pct"),
        "leakage_rs",
        half_up(ratio(F.col("days"), F.col("dated")), 1).alias("avg_dso_days"),
    )


def _trend(wh: Warehouse, label: Column, name: str, grain: str) -> DataFrame:
    return (
        wh.outcomes.groupBy(label.alias(name))
        .agg(
            F.sum(joined_rows(grain)).alias("settlements"),
            F.sum("dispute_count").alias("disputes"),
            F.sum("leakage_rs").alias("leakage_rs"),
        )
        .orderBy(name)
    )


def daily_trend(wh: Warehouse, grain: str = "joined") -> DataFrame:
    return _trend(wh, F.col("settlement_date"), "kpi_date", grain)


def weekly_trend(wh: Warehouse, week_mode: str = "sunday", grain: str = "joined") -> DataFrame:
    return _trend(wh, week_start(F.col("settlement_date"), week_mode), "wk", grain)


def weekly_wow(wh: Warehouse, week_mode: str = "sunday") -> DataFrame:
    """Leakage by week against the week before. One row per week reaches the ordered window."""
    by_week = Window.orderBy("wk")
    return (
        weekly_trend(wh, week_mode)
        .select("wk", "leakage_rs", F.lag("leakage_rs").over(by_week).alias("prev_wk"))
        .withColumn("wow_pct", percent(F.col("leakage_rs") - F.col("prev_wk"), F.col("prev_wk"), 1))
    )


def dso_by_courier(wh: Warehouse) -> DataFrame:
    """Mean and median days to settle; days are counted per value before the exact median."""
    counted = (
        wh.outcomes.where(F.col("has_order"))
        .groupBy(F.col("order_courier_id").alias("courier_id"), F.datediff("settlement_date", "order_date").alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        wh.named_courier(counted)
        .groupBy("courier_name")
        .agg(
            half_up(ratio(F.sum(F.col("days") * F.col("n")), F.sum("n")), 1).alias("avg_dso_days"),
            F.percentile("days", 0.5, F.col("n")).alias("p50_dso"),
        )
    )


def funnel(wh: Warehouse, header: DataFrame | None = None) -> DataFrame:
    """Orders, delivered, settled, matched and disputed, each with its share of the stage before.

    ``header`` brings the headline figures where they have been computed already.
    """
    placed = wh.orders.agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("order_status") == "DELIVERED").alias("delivered")
    )
    settled = (header_kpis(wh) if header is None else header).select("settled_awbs", "disputed_awbs")
    # One row each; the missing columns of either are null, and the sum of nulls and a number is the number.
    both = placed.unionByName(settled, allowMissingColumns=True).agg(
        *[F.sum(c).alias(c) for c in ("orders", "delivered", "settled_awbs", "disputed_awbs")]
    )
    stages = {
        "Orders": F.col("orders"),
        "Delivered": F.col("delivered"),
        "Settled": F.col("settled_awbs"),
        "Matched": F.col("settled_awbs") - F.col("disputed_awbs"),
        "Disputed": F.col("disputed_awbs"),
    }
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), n.cast("long").alias("n"))
            for i, (name, n) in enumerate(stages.items(), 1)
        ]
    )
    before = F.lag("n").over(Window.orderBy("step"))
    return (
        both.select(F.inline(rows))
        .withColumn("share_of_previous", half_up(ratio(F.col("n"), before), 4))
        .orderBy("step")
    )


def festival_vs_normal(wh: Warehouse) -> DataFrame:
    """Settled AWBs, discrepancies and leakage by the period of the order date."""
    days = wh.dates.select(F.col("date_id").alias("order_date"), "is_festival")
    per_awb = (
        wh.outcomes.where(F.col("has_order"))
        .groupBy("awb_number", "order_date")
        .agg(F.sum("dispute_count").alias("disputes"), F.sum("leakage_rs").alias("leakage_rs"))
    )
    per_day = per_awb.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("settled"), F.sum("disputes").alias("disputes"), F.sum("leakage_rs").alias("leakage_rs")
    )
    return (
        per_day.join(days, "order_date")
        .groupBy(F.when(F.col("is_festival"), "festival").otherwise("normal").alias("period"))
        .agg(
            F.sum("settled").alias("settled"),
            F.sum("disputes").alias("disputes"),
            F.sum("leakage_rs").alias("leakage_rs"),
        )
        .select("period", "settled", "disputes", percent(F.col("disputes"), F.col("settled"), 2).alias("dispute_pct"),
                "leakage_rs")
    )


# -- scorecards ------------------------------------------------------------------------------------


def courier_rates(wh: Warehouse, grain: str = "joined", score: ScoreWeights = SCORE) -> DataFrame:
    """Unrounded on-time, dispute and phantom shares per courier of the order, and the reliability (0-1)."""
    weight = joined_rows(grain)
    on_time = F.col("actual_eta_hrs") <= F.col("promised_eta_hrs")
    phantom = F.col("phantom_count") if grain == "joined" else (F.col("phantom_count") > 0).cast("int")
    per_courier = disputed_orders(wh).groupBy("courier_id").agg(
        F.sum(weight).alias("orders"),
        F.sum(F.when(on_time, weight).otherwise(0)).alias("on_time_rows"),
        F.count_if(F.col("dispute_count") > 0).alias("disputed"),
        F.count(F.lit(1)).alias("awbs"),
        F.sum(phantom).alias("phantoms"),
        F.sum("leakage_rs").alias("leakage_rs"),
    )
    shares = per_courier.select(
        "courier_id",
        "orders",
        ratio(F.col("on_time_rows"), F.col("orders")).alias("ontime"),
        ratio(F.col("disputed"), F.col("awbs")).alias("dispute"),
        ratio(F.col("phantoms"), F.col("orders")).alias("phantom"),
        "leakage_rs",
    )
    reliability = (
        score.on_time * F.col("ontime")
        + score.clean * (1 - F.col("dispute"))
        + score.no_phantom * (1 - F.col("phantom"))
    )
    return wh.named_courier(shares).drop("courier_id").withColumn("reliability", reliability)


def courier_scorecard(wh: Warehouse, grain: str = "joined") -> DataFrame:
    """Rounded scorecard; RANK is taken over the unrounded score."""
    best_first = Window.orderBy(F.col("reliability").desc())
    return (
        courier_rates(wh, grain)
        .select(
            "courier_name",
            "orders",
            half_up(F.col("ontime") * 100, 1).alias("ontime_pct"),
            half_up(F.col("dispute") * 100, 1).alias("dispute_pct"),
            half_up(F.col("reliability") * 100, 1).alias("reliability_score"),
            F.rank().over(best_first).alias("reliability_rank"),
            "leakage_rs",
        )
        .orderBy("reliability_rank", "courier_name")
    )


def courier_scorecard_frame(wh: Warehouse, digits: int | None = None) -> DataFrame:
    """Scorecard with shares as fractions and tied ranks averaged; ``digits`` rounds the score half-even first."""
    score = F.col("reliability") * 100
    rows = courier_rates(wh).withColumn("reliability", score if digits is None else half_even(score, digits))
    return rows.withColumn("rank", average_rank(F.col("reliability"))).orderBy("rank", "courier_name")


def dispute_share_by_courier(wh: Warehouse) -> DataFrame:
    return (
        courier_rates(wh)
        .select("courier_name", (100 * F.col("dispute")).alias("dispute_pct"), "leakage_rs")
        .orderBy(F.col("dispute_pct").desc(), "courier_name")
    )


def radar(wh: Warehouse) -> DataFrame:
    """Four score parts as rows, each with its value by courier, of the couriers that the scorecard has."""
    long = courier_scorecard_frame(wh, 1).select(
        "courier_name",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), half_up(value, 1).alias("value"))
                    for name, value in (
                        ("Reliability", F.col("reliability")),
                        ("On-time %", 100 * F.col("ontime")),
                        ("Clean %", 100 * (1 - F.col("dispute"))),
                        ("No-phantom %", 100 * (1 - F.col("phantom"))),
                    )
                ]
            )
        ),
    )
    return long.groupBy("metric").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("courier_name", "value")))).alias("values")
    )


def radar_long(wh: Warehouse) -> DataFrame:
    """The radar as one row per metric and courier."""
    return radar(wh).select("metric", F.explode("values").alias("courier_name", "value"))


def tier_entry(wh: Warehouse, grain: str = "joined") -> DataFrame:
    """Orders, order value, leakage and delay by tier; orders fold per place before the tier is joined."""
    weight = joined_rows(grain)
    late_by = F.col("actual_eta_hrs") - F.col("promised_eta_hrs")
    per_place = disputed_orders(wh).groupBy("geo_id").agg(
        F.sum(weight).alias("orders"),
        F.sum(F.col("order_value") * weight).alias("gmv"),
        F.sum("leakage_rs").alias("leakage_rs"),
        F.sum(late_by * weight).alias("delay"),
        F.sum(F.when(late_by.isNotNull(), weight)).alias("timed"),
    )
    per_tier = wh.with_tier(per_place).groupBy("tier").agg(
        *[F.sum(c).alias(c) for c in ("orders", "gmv", "leakage_rs", "delay", "timed")]
    )
    delay = ratio(F.col("delay"), F.col("timed"))
    return per_tier.select(
        "tier",
        "orders",
        "gmv",
        "leakage_rs",
        percent(F.col("leakage_rs"), F.col("gmv"), 2).alias("leakage_pct_of_gmv"),
        half_up(delay, 1).alias("avg_delay_hrs"),
        delay.alias("delay"),
    ).orderBy("tier")


# -- discrepancy cells -----------------------------------------------------------------------------


def cells(wh: Warehouse, severity: str | None = None) -> DataFrame:
    """Cases and leakage by courier, place and type: a few thousand rows that the reports regroup."""
    found = list_discrepancies(wh.outcomes.where(F.col("dispute_count") > 0))
    if severity is not None:
        found = found.where(F.col("severity") == severity)
    folded = found.groupBy("courier_id", "geo_id", "discrepancy_type").agg(
        F.count(F.lit(1)).alias("cases"), F.sum("variance_rs").alias("leakage_rs")
    )
    return wh.with_tier(wh.named_courier(folded))


def _regroup(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("cases").alias("cases"), F.sum("leakage_rs").alias("leakage_rs"))


def rca_cells(wh: Warehouse, limit: int | None = 20, rounded: Rounding = half_up, courier: str | None = None,
              tier: str | None = None) -> DataFrame:
    """Courier, tier and type cells by leakage, largest first, for one courier or tier if given; all without a limit."""
    rows = _regroup(cells(wh), "courier_name", "tier", "discrepancy_type")
    if courier is not None:
        rows = rows.where(F.col("courier_name") == courier)
    if tier is not None:
        rows = rows.where(F.col("tier") == tier)
    mean = ratio(F.col("leakage_rs"), F.col("cases"))
    ordered = rows.withColumn("avg_loss", rounded(mean, 0)).orderBy(
        F.col("leakage_rs").desc(), "courier_name", "tier", "discrepancy_type"
    )
    return ordered if limit is None else ordered.limit(limit)


def rca_workbench(wh: Warehouse, courier: str | None = None, tier: str | None = None) -> DataFrame:
    """The first fifteen cells under a filter; the cell to fix first is marked."""
    first = Window.orderBy(F.col("leakage_rs").desc(), "courier_name", "tier", "discrepancy_type")
    return rca_cells(wh, 15, half_even, courier, tier).withColumn("is_top", F.row_number().over(first) == 1)


def rca_rollup(wh: Warehouse) -> DataFrame:
    """Cells with subtotals per tier, per courier and overall."""
    return (
        cells(wh)
        .rollup("courier_name", "tier", "discrepancy_type")
        .agg(
            F.grouping_id().alias("level"), F.sum("cases").alias("cases"), F.sum("leakage_rs").alias("leakage_rs")
        )
    )


def leakage_by(wh: Warehouse, key: str) -> DataFrame:
    """Cases, leakage and mean loss by discrepancy_type, courier_name or tier."""
    return (
        _regroup(cells(wh), key)
        .withColumn("avg_loss", ratio(F.col("leakage_rs"), F.col("cases")))
        .orderBy(F.col("leakage_rs").desc(), key)
    )


def average_loss_by_type(wh: Warehouse) -> DataFrame:
    """Mean loss of the types that cost money."""
    return leakage_by(wh, "discrepancy_type").where(F.col("leakage_rs") > 0).orderBy(F.col("avg_loss").desc())


def severity_mix(wh: Warehouse) -> DataFrame:
    return wh.discrepancies.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def worst_courier_per_tier(wh: Warehouse) -> DataFrame:
    by_tier = Window.partitionBy("tier").orderBy(F.col("leakage_rs").desc())
    return (
        _regroup(cells(wh), "tier", "courier_name")
        .select("tier", "courier_name", F.col("cases").alias("disputes"), "leakage_rs",
                F.rank().over(by_tier).alias("tier_rank"))
        .orderBy("tier", "tier_rank", "courier_name")
    )


def pareto_couriers(wh: Warehouse, rounded: Rounding = half_up) -> DataFrame:
    """Share and running share of leakage by courier."""
    rows = _regroup(cells(wh), "courier_name")
    whole = F.sum("leakage_rs").over(Window.partitionBy(F.lit(1)))
    so_far = F.sum("leakage_rs").over(
        Window.orderBy(F.col("leakage_rs").desc(), "courier_name").rowsBetween(Window.unboundedPreceding, 0)
    )
    return rows.select(
        "courier_name",
        "cases",
        "leakage_rs",
        rounded(100 * ratio(F.col("leakage_rs"), whole), 1).alias("pct_of_total"),
        rounded(100 * ratio(so_far, whole), 1).alias("running_pct"),
    ).orderBy(F.col("leakage_rs").desc(), "courier_name")


def treemap(wh: Warehouse) -> DataFrame:
    """Types by total leakage, each with its tiers by leakage; sizes are whole rupees per cell."""
    per_cell = _regroup(cells(wh), "courier_name", "tier", "discrepancy_type")
    # Round half up towards plus infinity, as the page's rounding does.
    size = F.floor(F.col("leakage_rs").cast("double") + 0.5)
    by_type = Window.partitionBy("discrepancy_type")
    return (
        per_cell.select("discrepancy_type", "tier", "courier_name", size.alias("size"))
        .withColumn("type_total", F.sum("size").over(by_type))
        .withColumn(
            "position",
            F.row_number().over(by_type.orderBy(F.col("size").desc(), "tier", "courier_name")),
        )
        .orderBy(F.col("type_total").desc(), "discrepancy_type", "position")
    )


def nested_treemap(wh: Warehouse) -> DataFrame:
    """The treemap as one row per type with an ordered list of children."""
    child = F.struct("position", "tier", "size")
    return (
        treemap(wh)
        .groupBy("discrepancy_type", "type_total")
        .agg(F.sort_array(F.collect_list(child)).alias("children"))
        .orderBy(F.col("type_total").desc(), "discrepancy_type")
    )


def scatter(wh: Warehouse) -> DataFrame:
    """Cases against mean loss per cell, grouped by type, largest type first."""
    rows = rca_cells(wh, None, half_even)
    z = F.floor(F.col("leakage_rs").cast("double") + 0.5)
    return rows.select(
        "discrepancy_type",
        "courier_name",
        "tier",
        F.col("cases").alias("x"),
        F.floor(F.col("avg_loss") + 0.5).alias("y"),
        z.alias("z"),
        F.sum(z).over(Window.partitionBy("discrepancy_type")).alias("group_total"),
    ).orderBy(F.col("group_total").desc(), "discrepancy_type", "courier_name", "tier")


def glossary(wh: Warehouse) -> DataFrame:
    """North star and input metrics on one row."""
    return header_kpis(wh).select(
        F.col("leakage_rs").alias("recoverable_leakage_rs"),
        "dispute_rate_pct",
        F.col("avg_dso_days").alias("dso_days"),
        half_up(ratio(F.col("leakage_rs"), F.col("disputed_awbs")), 2).alias("avg_loss_per_disputed_awb"),
    )


def union_one_row(frames: list[DataFrame]) -> DataFrame:
    """Put one-row frames with different columns on one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
