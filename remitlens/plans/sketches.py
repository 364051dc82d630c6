"""Mergeable sketches by mart cell: distinct AWBs and amounts of any range and slice, without the rows.

Distinct counts do not add up over cells, and quantiles even less. A cell's sketch is of bounded size, and sketches of
cells merge to that of all their rows, so the mart answers for any days, couriers and places at the cost of its cells.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.plans.warehouse import Warehouse

#: Binary logarithm of the registers of a distinct count, and the size parameter of a quantile sketch.
REGISTERS, QUANTILES = 14, 400
#: Errors that are exceeded in fewer than one of a hundred cases: relative, for distinct counts, and of the rank.
DISTINCT_ERROR, RANK_ERROR = 0.025, 0.0075
CELL = ["kpi_date", "courier_id", "geo_id"]


def sketch_mart(wh: Warehouse) -> DataFrame:
    """A sketch of the AWBs, of the disputed AWBs and of the amounts paid, per day, courier and place.

    A hot cell folds into one sketch per task before they meet.
    """
    disputed = F.when(F.col("dispute_count") > 0, F.col("awb_number"))
    return wh.outcomes.where(F.col("has_order")).groupBy(F.col("settlement_date").alias("kpi_date"), "courier_id", "geo_id").agg(
        F.hll_sketch_agg("awb_number", REGISTERS).alias("awbs"),
        F.hll_sketch_agg(disputed, REGISTERS).alias("disputed"),
        F.kll_sketch_agg_double(F.col("settled_cod").cast("double"), QUANTILES).alias("paid"),
    )


def merged(mart: DataFrame, *by: str, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
    """The sketches of the mart's cells of some days (both ends included) as one per value of the ``by`` columns."""
    if first is not None:
        mart = mart.where(F.col("kpi_date") >= F.lit(first))
    if last is not None:
        mart = mart.where(F.col("kpi_date") <= F.lit(last))
    return mart.groupBy(*by).agg(
        F.hll_union_agg("awbs").alias("awbs"), F.hll_union_agg("disputed").alias("disputed"), F.kll_merge_agg_double("paid").alias("paid")
    )


def estimates(sketches: DataFrame, *by: str, ranks: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """``awbs``, ``disputed`` and a ``paid_p`` column per rank (null without rows), as far as the errors of this module allow."""
    held = F.kll_sketch_get_n_double("paid") > 0
    quantiles = [F.when(held, F.kll_sketch_get_quantile_double("paid", F.lit(r))).alias(f"paid_p{round(100 * r)}") for r in ranks]
    return sketches.select(
        *by, F.hll_sketch_estimate("awbs").alias("awbs"), F.hll_sketch_estimate("disputed").alias("disputed"), *quantiles
    )


def sketch_check(wh: Warehouse, mart: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """By courier, over some days: the exact distinct counts, and whether sketches and medians are within their errors."""
    found = estimates(merged(mart, "courier_id", first=first, last=last), "courier_id", ranks=(0.5,))
    rows = wh.outcomes.where(F.col("has_order") & F.col("settlement_date").between(F.lit(first), F.lit(last)))
    # Folded by AWB and amount first: counts and ranks need no row twice.
    per_awb = rows.groupBy("courier_id", "awb_number").agg(F.max((F.col("dispute_count") > 0).cast("int")).alias("is_disputed"))
    exact = per_awb.groupBy("courier_id").agg(F.count(F.lit(1)).alias("exact_awbs"), F.sum("is_disputed").alias("exact_disputed"))
    ranked = rows.join(found.select("courier_id", "paid_p50"), "courier_id").groupBy("courier_id").agg(
        F.avg((F.col("settled_cod").cast("double") <= F.col("paid_p50")).cast("double")).alias("upto"),
        F.avg((F.col("settled_cod").cast("double") < F.col("paid_p50")).cast("double")).alias("below"),
    )
    near = lambda estimate, true: F.abs(F.col(estimate) - F.col(true)) <= DISTINCT_ERROR * F.col(true) + 1
    return found.join(exact, "courier_id").join(ranked, "courier_id").select(
        "courier_id", "exact_awbs", "exact_disputed",
        near("awbs", "exact_awbs").alias("awbs_near"), near("disputed", "exact_disputed").alias("disputed_near"),
        ((F.col("below") <= 0.5 + RANK_ERROR) & (F.col("upto") >= 0.5 - RANK_ERROR)).alias("median_near"),
    )
