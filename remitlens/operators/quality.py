"""Constraint checks that the table definitions state and Spark does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import settings
from remitlens.schema import DAILY_KPIS, FACT_DISCREPANCIES


def _report(df: DataFrame, check: str, count) -> DataFrame:
    return df.agg(F.coalesce(count, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(check).alias("check_name"), "violations"
    )


def row_checks(df: DataFrame, table: str, schema: T.StructType, enums: dict[str, tuple[str, ...]]) -> DataFrame:
    """Null and enumeration violations of one table, counted in one pass."""
    checks = {
        f"{table}.{field.name} not null": F.col(field.name).isNull()
        for field in schema.fields
        if not field.nullable and field.name in df.columns
    }
    for column, allowed in enums.items():
        checks[f"{table}.{column} in enum"] = ~F.col(column).isin(*allowed)
    names = {f"c{i}": name for i, name in enumerate(checks)}
    counted = df.agg(*[F.count_if(check).alias(short) for short, check in zip(names, checks.values(), strict=True)])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(s).alias("violations")) for s, n in names.items()])
    return counted.select(F.inline(pairs))


def unique_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key."""
    surplus = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("surplus")).where(F.col("surplus") > 0)
    return _report(surplus, f"{table}.{'+'.join(keys)} unique", F.sum("surplus"))


def reference_check(df: DataFrame, table: str, key: str, parent: DataFrame, parent_name: str) -> DataFrame:
    """Rows whose key the parent table lacks; rows are counted per key before the join."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return _report(orphans, f"{table}.{key} in {parent_name}", F.sum("n"))


def warehouse_violations(tables: dict[str, DataFrame], schemas: dict[str, T.StructType]) -> DataFrame:
    """One row per constraint of the star schema with its number of violating rows."""
    enums = {
        "dim_geography": {"tier": settings.TIERS},
        "dim_merchant": {"category": settings.CATEGORIES},
        "fact_orders": {"order_status": settings.ORDER_STATUSES, "payment_mode": settings.PAYMENT_MODES},
    }
    unique = {
        "dim_courier": (["courier_id"], ["courier_name"]),
        "dim_geography": (["geo_id"],),
        "dim_merchant": (["merchant_id"],),
        "fact_orders": (["order_id"], ["awb_number"]),
        "fact_settlements": (["settlement_id"],),
    }
    references = (
        ("fact_orders", "courier_id", "dim_courier"),
        ("fact_orders", "merchant_id", "dim_merchant"),
        ("fact_orders", "geo_id", "dim_geography"),
        ("fact_settlements", "courier_id", "dim_courier"),
        ("fact_settlements", "awb_number", "fact_orders"),
    )
    parts = [row_checks(df, name, schemas[name], enums.get(name, {})) for name, df in tables.items()]
    parts += [unique_check(tables[name], name, keys) for name, sets in unique.items() for keys in sets]
    parts += [
        reference_check(tables[child], child, key, tables[parent], parent) for child, key, parent in references
    ]
    return reduce(DataFrame.unionByName, parts)


def result_violations(discrepancies: DataFrame, mart: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per constraint of the discrepancies and of the daily mart."""
    enums = {"discrepancy_type": settings.DISCREPANCY_TYPES, "severity": settings.SEVERITIES}
    parts = [
        row_checks(discrepancies, "fact_discrepancies", FACT_DISCREPANCIES, enums),
        unique_check(discrepancies, "fact_discrepancies", ["discrepancy_id"]),
        row_checks(mart, "fct_daily_kpis", DAILY_KPIS, {}),
        unique_check(mart, "fct_daily_kpis", ["kpi_date", "courier_id", "geo_id"]),
    ]
    for key, parent in (("courier_id", "dim_courier"), ("merchant_id", "dim_merchant"), ("geo_id", "dim_geography")):
        parts.append(reference_check(discrepancies, "fact_discrepancies", key, tables[parent], parent))
        if key in mart.columns:
            parts.append(reference_check(mart, "fct_daily_kpis", key, tables[parent], parent))
    return reduce(DataFrame.unionByName, parts)
