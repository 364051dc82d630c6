"""Weekly leakage, its ridge fit on time and festival, and the forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions.calendar import week_start
from remitlens.functions.numbers import half_even
from remitlens.plans.warehouse import Warehouse


def weekly_series(wh: Warehouse, week_mode: str = "sunday") -> DataFrame:
    """Leakage, festival flag and row index per week; weeks without settlements leave no gap in the index."""
    days = wh.dates.select(F.col("date_id").alias("order_date"), F.col("is_festival").cast("int").alias("fest"))
    folded = wh.outcomes.groupBy("order_date", week_start(F.col("settlement_date"), week_mode).alias("wk")).agg(
        F.sum("leakage_rs").alias("leakage_rs")
    )
    return (
        folded.join(days, "order_date", "left")
        .groupBy("wk")
        .agg(F.sum("leakage_rs").alias("leakage_rs"), F.coalesce(F.max("fest"), F.lit(0)).alias("fest"))
        .withColumn("t", F.row_number().over(Window.orderBy("wk")) - 1)
    )


def ridge_fit(series: DataFrame, alpha: float = 1.0) -> DataFrame:
    """Closed-form ridge of leakage on (t, fest) with a free intercept: one row of coefficients and R2."""
    t, f, y = (F.col(c).cast("double") for c in ("t", "fest", "leakage_rs"))
    rows = series.select(t.alias("t"), f.alias("f"), y.alias("y"), "wk")
    one = Window.partitionBy(F.lit(1))
    centred = rows.select(
        "t", "f", "y", "wk", *[(F.col(c) - F.avg(c).over(one)).alias(f"{c}c") for c in ("t", "f", "y")]
    )
    pairs = {a + b: F.sum(F.col(f"{a}c") * F.col(f"{b}c")) for a, b in ("tt", "ff", "tf", "ty", "fy", "yy")}
    sums = centred.agg(
        *[value.alias(f"s_{name}") for name, value in pairs.items()],
        *[F.avg(c).alias(f"{c}_mean") for c in ("t", "f", "y")],
        F.count(F.lit(1)).alias("weeks"),
        F.max("wk").alias("last_wk"),
    )
    tt, ff, tf, ty, fy, yy = (F.col(f"s_{name}") for name in pairs)
    det = (tt + alpha) * (ff + alpha) - tf * tf
    fitted = sums.withColumn("coef_t", ((ff + alpha) * ty - tf * fy) / det).withColumn(
        "coef_fest", ((tt + alpha) * fy - tf * ty) / det
    )
    b, g = F.col("coef_t"), F.col("coef_fest")
    residual = yy - 2 * (b * ty + g * fy) + b * b * tt + 2 * b * g * tf + g * g * ff
    return fitted.select(
        "weeks",
        "last_wk",
        (F.col("y_mean") - b * F.col("t_mean") - g * F.col("f_mean")).alias("intercept"),
        "coef_t",
        "coef_fest",
        (1 - residual / F.nullif(yy, F.lit(0.0))).alias("r2"),
    )


def ridge_forecast(series: DataFrame, weeks_ahead: int = 4) -> DataFrame:
    """Leakage of the coming weeks without a festival, rounded half-even to whole rupees."""
    ahead = F.explode(F.sequence(F.lit(1), F.lit(weeks_ahead))).alias("i")
    return ridge_fit(series).select("*", ahead).select(
        F.expr("date_add(last_wk, 7 * i)").alias("wk"),
        half_even(F.col("intercept") + F.col("coef_t") * (F.col("weeks") + F.col("i") - 1), 0).alias("leakage_rs"),
    )


def actual_and_forecast(series: DataFrame, weeks_ahead: int = 4) -> DataFrame:
    known = series.select("wk", F.col("leakage_rs").cast("double"), F.lit(False).alias("forecast"))
    return known.unionByName(ridge_forecast(series, weeks_ahead).withColumn("forecast", F.lit(True)))
