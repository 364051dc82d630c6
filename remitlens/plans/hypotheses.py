"""Welch and chi-square tests from sufficient statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions.probability import chi2_p_value, student_p_value
from remitlens.plans.kpis import disputed_orders
from remitlens.plans.warehouse import Warehouse


def decision(p: Column, alpha: float = 0.05) -> Column:
    return F.when(p < alpha, "reject").otherwise("no signal")


def _tested(moments: DataFrame) -> DataFrame:
    """Welch's t from both sides' number, mean and variance on one row."""
    err_a, err_b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    spread = err_a + err_b
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(spread))
    df_ = F.try_divide(
        spread * spread,
        F.try_divide(err_a * err_a, F.col("n_a") - 1) + F.try_divide(err_b * err_b, F.col("n_b") - 1),
    )
    tested = moments.withColumn("t", t).withColumn("df", df_)
    return tested.withColumn("p_value", student_p_value("t", "df")).withColumn("decision", decision(F.col("p_value")))


def welch(df: DataFrame, value: Column, in_group: Column) -> DataFrame:
    """Welch's t with a one-sided p for a larger mean in the group than in the rest."""
    rows = df.select(value.cast("double").alias("x"), in_group.alias("g"))
    parts = []
    for side, member in (("a", F.col("g")), ("b", ~F.col("g"))):
        x = F.when(member, F.col("x"))
        parts += [F.count(x).alias(f"n_{side}"), F.avg(x).alias(f"mean_{side}"), F.var_samp(x).alias(f"var_{side}")]
    return _tested(rows.agg(*parts))


def folded_moments(df: DataFrame, value: Column, keys: list[str]) -> DataFrame:
    """Number, mean and sum of squared distances of a value by key, from which those of any union of keys follow."""
    x = value.cast("double")
    return df.groupBy(*keys).agg(F.count(x).alias("n"), F.avg(x).alias("m"), (F.var_pop(x) * F.count(x)).alias("s"))


def welch_of_moments(folded: DataFrame, in_group: Column) -> DataFrame:
    """Welch's t from folded moments, few rows whatever was folded."""
    side = Window.partitionBy("g")
    centred = folded.where("n > 0").withColumn("g", in_group).withColumn(
        "mean", F.sum(F.col("n") * F.col("m")).over(side) / F.sum("n").over(side)
    )
    gap = F.col("m") - F.col("mean")
    parts = []
    for name, member in (("a", F.col("g")), ("b", ~F.col("g"))):
        size = F.coalesce(F.sum(F.when(member, F.col("n"))), F.lit(0))
        squares = F.sum(F.when(member, F.col("s") + F.col("n") * gap * gap))
        parts += [
            size.alias(f"n_{name}"),
            F.max(F.when(member, F.col("mean"))).alias(f"mean_{name}"),
            F.try_divide(squares, size - 1).alias(f"var_{name}"),
        ]
    return _tested(centred.agg(*parts))


def chi2_counts(counts: DataFrame, a: str, b: str, c: str, d: str) -> DataFrame:
    """Chi-square of the table [[a, b], [c, d]] with the continuity correction, on each row of ``counts``."""
    a_, b_, c_, d_ = (F.col(name).cast("double") for name in (a, b, c, d))
    n = a_ + b_ + c_ + d_
    gap = F.abs(a_ * d_ - b_ * c_) / F.nullif(n, F.lit(0.0))
    corrected = gap - F.least(F.lit(0.5), gap)
    margins = (a_ + b_) * (c_ + d_) * (a_ + c_) * (b_ + d_)
    # The sum of 1/expected over the four cells is n^3 / margins.
    chi2 = corrected * corrected * n * n * n / F.nullif(margins, F.lit(0.0))
    tested = counts.withColumn("chi2", chi2).withColumn("p_value", chi2_p_value("chi2"))
    return tested.withColumn("decision", decision(F.col("p_value")))


def chi2_2x2(df: DataFrame, row: Column, column: Column, weight: Column | None = None) -> DataFrame:
    """Independence of two conditions over the rows of ``df``; ``weight`` says how many rows a row stands for."""
    weight = F.lit(1) if weight is None else weight
    cell = lambda first, second: F.coalesce(F.sum(F.when(first & second, weight)), F.lit(0))
    counts = df.agg(
        cell(row, column).alias("yes_yes"),
        cell(row, ~column).alias("yes_no"),
        cell(~row, column).alias("no_yes"),
        cell(~row, ~column).alias("no_no"),
    )
    return chi2_counts(counts, "yes_yes", "yes_no", "no_yes", "no_no")


def weight_inflation_test(wh: Warehouse, courier: str, tier: str) -> DataFrame:
    """Is weight inflation in one courier-tier cell larger than elsewhere? Settlement grain."""
    declared = F.col("declared_weight").cast("double")
    inflation = (F.col("charged_weight").cast("double") - declared) / F.nullif(declared, F.lit(0.0)) * 100
    rows = wh.outcomes.where(F.col("has_order")).withColumn("courier_id", F.col("order_courier_id"))
    folded = folded_moments(rows, inflation, ["courier_id", "geo_id"])
    named = wh.with_tier(wh.named_courier(folded))
    return welch_of_moments(named, (F.col("courier_name") == courier) & (F.col("tier") == tier))


def festival_dispute_test(wh: Warehouse) -> DataFrame:
    """Are orders placed on festival days disputed more often?"""
    days = wh.dates.select(F.col("date_id").alias("order_date"), "is_festival")
    per_day = disputed_orders(wh).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("dispute_count") > 0).alias("disputed")
    )
    fest = F.col("is_festival")
    counts = per_day.join(days, "order_date").agg(
        F.coalesce(F.sum(F.when(fest, F.col("disputed"))), F.lit(0)).alias("fest_disputed"),
        F.coalesce(F.sum(F.when(fest, F.col("n") - F.col("disputed"))), F.lit(0)).alias("fest_clean"),
        F.coalesce(F.sum(F.when(~fest, F.col("disputed"))), F.lit(0)).alias("normal_disputed"),
        F.coalesce(F.sum(F.when(~fest, F.col("n") - F.col("disputed"))), F.lit(0)).alias("normal_clean"),
    )
    return chi2_counts(counts, "fest_disputed", "fest_clean", "normal_disputed", "normal_clean")


def cod_short_test(wh: Warehouse, courier: str) -> DataFrame:
    """Does one courier remit short more often than its peers, over orders with cash to collect?"""
    is_short = F.array_contains("disputes.discrepancy_type", "COD_SHORT_REMITTANCE")
    short = wh.outcomes.where(is_short).select("awb_number").distinct().withColumn("short", F.lit(1))
    per_courier = (
        wh.orders.where(F.col("cod_amount") > 0)
        .select("awb_number", "courier_id")
        .join(short, "awb_number", "left")
        .groupBy("courier_id")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("short"), F.lit(0)).alias("short"))
    )
    own = F.col("courier_name") == courier
    counts = wh.named_courier(per_courier).agg(
        F.coalesce(F.sum(F.when(own, F.col("short"))), F.lit(0)).alias("own_short"),
        F.coalesce(F.sum(F.when(own, F.col("n") - F.col("short"))), F.lit(0)).alias("own_full"),
        F.coalesce(F.sum(F.when(~own, F.col("short"))), F.lit(0)).alias("peer_short"),
        F.coalesce(F.sum(F.when(~own, F.col("n") - F.col("short"))), F.lit(0)).alias("peer_full"),
    )
    return chi2_counts(counts, "own_short", "own_full", "peer_short", "peer_full")
