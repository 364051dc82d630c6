"""Settlements against orders: outcomes, discrepancies and their summary.

An *outcome* is a settlement row with its order's attributes and the array of its discrepancies. It is
built by one skew-safe join and then answers the analyst queries without joining the facts again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.operators.rules import listed, one_sided, with_disputes
from remitlens.operators.skew import SHARE, heavy_buckets, repeat_rows, spread_rows
from remitlens.settings import RULES, SKEW, RuleSettings, SkewSettings

SETTLEMENT_COLUMNS = (
    "settlement_id", "awb_number", "batch_id", "courier_id", "settlement_date", "settled_cod",
    "charged_weight", "forward_charge", "rto_charge", "cod_fee",
)
ORDER_COLUMNS = (
    "merchant_id", "geo_id", "order_date", "order_status", "cod_amount", "declared_weight",
    "promised_eta_hrs", "actual_eta_hrs",
)
DISCREPANCY_COLUMNS = (
    "discrepancy_id", "awb_number", "batch_id", "courier_id", "merchant_id", "geo_id", "discrepancy_type",
    "expected_value", "actual_value", "variance_rs", "severity",
)


def order_side(orders: DataFrame) -> DataFrame:
    """The order columns the rules and queries read; the order's courier keeps a name of its own."""
    return orders.select(
        "awb_number", F.col("courier_id").alias("order_courier_id"), *ORDER_COLUMNS, F.lit(True).alias("has_order")
    )


def match_orders(settlements: DataFrame, orders: DataFrame, batch_id: str | None = None,
                 skew: SkewSettings = SKEW, counts: DataFrame | None = None) -> DataFrame:
    """Each settlement with its order (null columns if unknown) and its number of copies.

    Copies are counted over all settlements, also when only one batch is matched; ``counts`` brings known copies per AWB,
    where an AWB it lacks has one, and then only the batch's settlements are read.
    """
    keys = ["awb_number"]
    if counts is None:
        # The filter that the joins would infer stands here for all uses, so they share one shuffle.
        named = settlements.where(F.col("awb_number").isNotNull())
        counts = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    heavy = heavy_buckets(counts, keys, "copies", skew)
    rows = settlements.select(*SETTLEMENT_COLUMNS)
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") == batch_id)
        # Few AWBs of all: orders shrink to them before they meet.
        orders = orders.join(rows.select(*keys).distinct(), keys, "left_semi")
    rows = spread_rows(rows, heavy, keys, F.col("settlement_id"), skew)
    partners = repeat_rows(order_side(orders), heavy, keys, skew)
    repeated = repeat_rows(counts.where(F.col("copies") > 1), heavy, keys, skew)
    on = [*keys, SHARE]
    return (
        rows.join(partners, on, "left")
        .join(repeated, on, "left")
        .withColumn("copies", F.coalesce("copies", F.lit(1)))
        .withColumn("has_order", F.coalesce("has_order", F.lit(False)))
        .drop(SHARE)
    )


def match_for(settlements: DataFrame, orders: DataFrame, names: tuple[str, ...], batch_id: str | None = None,
              rules: RuleSettings = RULES, skew: SkewSettings = SKEW) -> DataFrame:
    """The matched rows on which the named rules may fire.

    What all of them ask of one side is asked before the join, and copies are joined only for the duplicate rule. All
    rules need an order, so settlements without one drop out.
    """
    keys, duplicates = ["awb_number"], "DUPLICATE_SETTLEMENT" in names
    of_settlement, of_order = one_sided(names, rules)
    rows = settlements.select(*SETTLEMENT_COLUMNS).where(F.col("awb_number").isNotNull())
    partners = order_side(orders)
    if of_settlement is not None:
        rows = rows.where(of_settlement)
    if of_order is not None:
        partners = partners.where(of_order)
    if batch_id is not None and not duplicates:
        rows = rows.where(F.col("batch_id") == batch_id)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    if batch_id is not None and duplicates:
        rows = rows.where(F.col("batch_id") == batch_id)
    heavy = heavy_buckets(counts, keys, "copies", skew)
    on = [*keys, SHARE]
    rows = spread_rows(rows, heavy, keys, F.col("settlement_id"), skew)
    if duplicates:
        repeated = repeat_rows(counts.where(F.col("copies") > 1), heavy, keys, skew)
        # If only copies count, settlements without any drop out before they meet their orders.
        rows = rows.join(repeated, on, "inner" if names == ("DUPLICATE_SETTLEMENT",) else "left")
        rows = rows.withColumn("copies", F.coalesce("copies", F.lit(1)))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    return rows.join(repeat_rows(partners, heavy, keys, skew), on).drop(SHARE)


def outcomes(settlements: DataFrame, orders: DataFrame, batch_id: str | None = None, rules: RuleSettings = RULES,
             skew: SkewSettings = SKEW, counts: DataFrame | None = None) -> DataFrame:
    """One row per settlement: its order, its copies (known ones, if given) and its discrepancies."""
    return with_disputes(match_orders(settlements, orders, batch_id, skew, counts), rules)


def _identified(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.concat_ws("|", "awb_number", "batch_id", "discrepancy_type").alias("discrepancy_id"),
        *DISCREPANCY_COLUMNS[1:],
    )


_CARRIED = ("awb_number", "batch_id", "courier_id", "merchant_id", "geo_id")


def list_discrepancies(outcome_rows: DataFrame) -> DataFrame:
    """One row per discrepancy of stored outcomes."""
    return _identified(outcome_rows.select(*_CARRIED, F.inline("disputes")))


def find_discrepancies(matched: DataFrame, names: tuple[str, ...] | None = None,
                       rules: RuleSettings = RULES) -> DataFrame:
    """One row per discrepancy of matched settlements, under the named rules or all."""
    return _identified(listed(matched, _CARRIED, names, rules))


def reconcile(settlements: DataFrame, orders: DataFrame, batch_id: str | None = None, rules: RuleSettings = RULES,
              skew: SkewSettings = SKEW, names: tuple[str, ...] | None = None) -> DataFrame:
    """All discrepancies of all batches, or of one; under all rules, or some."""
    if names is not None:
        return find_discrepancies(match_for(settlements, orders, names, batch_id, rules, skew), names, rules)
    return find_discrepancies(match_orders(settlements, orders, batch_id, skew), names, rules)


def summarise(discrepancies: DataFrame) -> DataFrame:
    """Cases and leakage by type, largest leakage first."""
    return (
        discrepancies.groupBy("discrepancy_type")
        .agg(F.count(F.lit(1)).alias("cases"), F.sum("variance_rs").alias("leakage_rs"))
        .orderBy(F.col("leakage_rs").desc(), "discrepancy_type")
    )


def attach_discrepancies(settlements: DataFrame, orders: DataFrame, discrepancies: DataFrame,
                         skew: SkewSettings = SKEW) -> DataFrame:
    """Outcome rows (without the array) from a stored discrepancy table, joined on AWB and batch.

    Discrepancies are folded per key first; a settlement row then stands for ``dispute_count`` joined rows.
    """
    keys = ["awb_number", "batch_id"]
    folded = discrepancies.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("dispute_count"), F.sum("variance_rs").alias("leakage_rs")
    )
    matched = match_orders(settlements, orders, skew=skew)
    counts = settlements.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = heavy_buckets(counts, keys, "_rows", skew)
    rows = spread_rows(matched, heavy, keys, F.col("settlement_id"), skew)
    return (
        rows.join(repeat_rows(folded, heavy, keys, skew), [*keys, SHARE], "left")
        .withColumn("dispute_count", F.coalesce("dispute_count", F.lit(0)))
        .withColumn("leakage_rs", F.coalesce("leakage_rs", F.lit(0)).cast("decimal(14,2)"))
        .drop(SHARE)
    )


def unsettled_orders(settlements: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders that no settlement names."""
    return orders.join(settlements.select("awb_number").distinct(), "awb_number", "left_anti")


def same_batch_copies(settlements: DataFrame) -> DataFrame:
    """AWBs named more than once in one batch."""
    return (
        settlements.groupBy("awb_number", "batch_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
