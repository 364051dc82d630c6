"""Thresholds of the reconciliation rules and limits of the skew handling."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# The discrepancy types, in rule order.
DISCREPANCY_TYPES = (
    "COD_SHORT_REMITTANCE",
    "WEIGHT_DISPUTE",
    "PHANTOM_RTO_CHARGE",
    "OVERDUE_REMITTANCE",
    "DUPLICATE_SETTLEMENT",
    "ETA_SLA_BREACH",
    "EXCESS_FORWARD_CHARGE",
)

# The enumerations the tables may hold.
SEVERITIES = ("HIGH", "MEDIUM", "LOW")
ORDER_STATUSES = ("DELIVERED", "RTO", "IN_TRANSIT", "LOST")
PAYMENT_MODES = ("COD", "Prepaid")
TIERS = ("Tier-1", "Tier-2", "Tier-3")
CATEGORIES = ("Grocery", "Food", "Pharmacy", "D2C")


@dataclass(frozen=True)
class RuleSettings:
    """Fixed values of the seven rules; decimals, so every comparison is exact."""

    cod_tolerance_share: Decimal = Decimal("0.02")
    cod_tolerance_cap: Decimal = Decimal("10")
    weight_tolerance: Decimal = Decimal("1.10")
    rupees_per_kg: Decimal = Decimal("60")
    overdue_days: int = 14
    overdue_high_days: int = 28
    eta_tolerance: Decimal = Decimal("1.3")
    forward_tolerance: Decimal = Decimal("1.15")
    slab_limits: tuple[Decimal, Decimal] = (Decimal("1"), Decimal("3"))
    slab_charges: tuple[Decimal, Decimal, Decimal] = (Decimal("42"), Decimal("65"), Decimal("95"))
    severity_high: Decimal = Decimal("500")
    severity_medium: Decimal = Decimal("100")


@dataclass(frozen=True)
class ScoreWeights:
    """Fixed values of the courier reliability score."""

    on_time: float = 0.4
    clean: float = 0.35
    no_phantom: float = 0.25


@dataclass(frozen=True)
class SkewSettings:
    """When a join key counts as heavy, how finely its rows are spread, and into how many buckets keys fall.

    ``buckets`` bounds what is sent to every task: a row of two integers per bucket that holds a heavy key.
    """

    heavy_rows: int = 200_000
    rows_per_share: int = 100_000
    buckets: int = 1 << 20


RULES = RuleSettings()
SCORE = ScoreWeights()
SKEW = SkewSettings()
