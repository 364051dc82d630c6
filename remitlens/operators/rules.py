"""The seven reconciliation rules as columns of one row.

Each rule yields a struct or null; a settlement row is tested against all rules in a single pass.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.pricing import forward_slab, is_cod_short, is_overweight, severity_of
from remitlens.schema import DISPUTES
from remitlens.settings import RULES, RuleSettings

# The rules that need one settlement row and its order only; duplicates need all settlements.
PER_ROW_RULES = (
    "COD_SHORT_REMITTANCE",
    "WEIGHT_DISPUTE",
    "PHANTOM_RTO_CHARGE",
    "OVERDUE_REMITTANCE",
    "ETA_SLA_BREACH",
    "EXCESS_FORWARD_CHARGE",
)


class Rule(NamedTuple):
    """When a rule fires, and what it then reports.

    ``of_settlement`` and ``of_order`` are what the rule asks of one side alone, if anything; rows that lack it need not
    be joined.
    """

    fires: Column
    expected: Column
    actual: Column
    variance: Column
    severity: Column
    of_settlement: Column | None = None
    of_order: Column | None = None

    def amount(self) -> Column:
        return self.variance.cast("decimal(12,2)")

    def finding(self, kind: str) -> Column:
        """The report as a struct, or null."""
        report = F.struct(
            F.lit(kind).alias("discrepancy_type"),
            self.expected.cast("decimal(12,2)").alias("expected_value"),
            self.actual.cast("decimal(12,2)").alias("actual_value"),
            self.amount().alias("variance_rs"),
            self.severity.alias("severity"),
        )
        return F.when(self.fires, report)


def all_rules(limits: RuleSettings = RULES) -> dict[str, Rule]:
    """The rules by name, over a frame with settlement columns and the order's attributes."""
    cod, settled = F.col("cod_amount"), F.col("settled_cod")
    declared, charged = F.col("declared_weight"), F.col("charged_weight")
    rto, forward = F.col("rto_charge"), F.col("forward_charge")
    promised, actual = F.col("promised_eta_hrs"), F.col("actual_eta_hrs")
    delivered = F.col("order_status") == "DELIVERED"
    days = F.datediff("settlement_date", "order_date")
    extra_weight = (charged - declared) * F.lit(limits.rupees_per_kg)
    slab = forward_slab(declared, limits)
    copies = F.col("copies")
    return {
        "COD_SHORT_REMITTANCE": Rule(
            is_cod_short(cod, settled, limits), cod, settled, cod - settled, severity_of(cod - settled, limits),
            of_order=cod > 0,
        ),
        # Graded on the unrounded amount.
        "WEIGHT_DISPUTE": Rule(
            is_overweight(declared, charged, limits), declared, charged, F.round(extra_weight, 0),
            severity_of(extra_weight, limits),
        ),
        "PHANTOM_RTO_CHARGE": Rule(
            (rto > 0) & delivered, F.lit(0), rto, rto, severity_of(rto, limits), rto > 0, delivered
        ),
        # The cash that is late, graded by days.
        "OVERDUE_REMITTANCE": Rule(
            days > limits.overdue_days, F.lit(limits.overdue_days), days, settled,
            F.when(days > limits.overdue_high_days, "HIGH").otherwise("MEDIUM"),
        ),
        "DUPLICATE_SETTLEMENT": Rule(F.col("has_order") & (copies > 1), F.lit(1), copies, settled, F.lit("HIGH")),
        # No money, but it counts as a dispute.
        "ETA_SLA_BREACH": Rule(
            delivered & (actual > promised * F.lit(limits.eta_tolerance)), promised, actual, F.lit(0), F.lit("LOW"),
            of_order=delivered & (actual > promised * F.lit(limits.eta_tolerance)),
        ),
        "EXCESS_FORWARD_CHARGE": Rule(
            forward > slab * F.lit(limits.forward_tolerance), slab, forward, forward - slab,
            severity_of(forward - slab, limits),
        ),
    }


def one_sided(names: tuple[str, ...] | None, limits: RuleSettings = RULES) -> tuple[Column | None, Column | None]:
    """What all named rules together need of a settlement and of its order; None if any row may count."""
    rules = all_rules(limits)
    sides = []
    for side in ("of_settlement", "of_order"):
        asked = [getattr(rules[name], side) for name in (names or tuple(rules))]
        sides.append(None if any(c is None for c in asked) else reduce(lambda a, b: a | b, asked))
    return sides[0], sides[1]


def listed(df: DataFrame, keep: tuple[str, ...], names: tuple[str, ...] | None = None,
           limits: RuleSettings = RULES) -> DataFrame:
    """One row per finding of the named rules (all by default) with the ``keep`` columns of its settlement.

    The array is given to ``inline`` as an expression with its nulls, so that the rules run once per row:
    from a column, Spark would infer a size filter and evaluate them again.
    """
    rules = all_rules(limits)
    found = F.array(*[rules[name].finding(name) for name in (names or tuple(rules))])
    return df.select(*keep, F.inline(found)).where(F.col("discrepancy_type").isNotNull())


def with_disputes(df: DataFrame, limits: RuleSettings = RULES) -> DataFrame:
    """Add the array of findings, their number and their total variance.

    Number and total come from the rules, not from the array: columns of structs in between would cost more
    than testing a rule twice.
    """
    rules = all_rules(limits)
    found = F.array(*[rule.finding(name) for name, rule in rules.items()])
    count, total = F.lit(0), F.lit(0).cast("decimal(14,2)")
    for rule in rules.values():
        count = count + F.when(rule.fires, 1).otherwise(0)
        total = (total + F.when(rule.fires, rule.amount()).otherwise(F.lit(0))).cast("decimal(14,2)")
    return df.select(
        "*",
        F.array_compact(found).cast(DISPUTES).alias("disputes"),
        count.alias("dispute_count"),
        total.alias("leakage_rs"),
    )
