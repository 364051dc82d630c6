"""Reusable expressions of the rules: tolerance, slab, severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlens.settings import RULES, RuleSettings


def cod_tolerance(cod_amount: Column, rules: RuleSettings = RULES) -> Column:
    return F.least(cod_amount * F.lit(rules.cod_tolerance_share), F.lit(rules.cod_tolerance_cap))


def is_cod_short(cod_amount: Column, settled_cod: Column, rules: RuleSettings = RULES) -> Column:
    return (cod_amount > 0) & (settled_cod < cod_amount - cod_tolerance(cod_amount, rules))


def is_overweight(declared: Column, charged: Column, rules: RuleSettings = RULES) -> Column:
    return charged > declared * F.lit(rules.weight_tolerance)


def forward_slab(declared_weight: Column, rules: RuleSettings = RULES) -> Column:
    light, middle = rules.slab_limits
    low, mid, high = rules.slab_charges
    return (
        F.when(declared_weight <= F.lit(light), F.lit(low))
        .when(declared_weight <= F.lit(middle), F.lit(mid))
        .otherwise(F.lit(high))
    )


def severity_of(variance: Column, rules: RuleSettings = RULES) -> Column:
    """Grade of an amount; a value exactly on a limit takes the lower grade."""
    return (
        F.when(variance > F.lit(rules.severity_high), "HIGH")
        .when(variance > F.lit(rules.severity_medium), "MEDIUM")
        .otherwise("LOW")
    )
