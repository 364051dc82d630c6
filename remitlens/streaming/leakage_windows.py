"""Leakage over tumbling and sliding windows of the settlement date.

The state has one row per day or week of the whole history, so no window is ever closed: a settlement that arrives years
late still counts in its window. Each micro-batch leaves the windows as they are then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.streaming.jobs import EpochTable, each_batch


def _windowed(outcome_rows: DataFrame, span: Column, label: Column, name: str) -> DataFrame:
    return (
        outcome_rows.groupBy(span.alias("w"))
        .agg(
            F.sum(F.greatest("dispute_count", F.lit(1))).alias("settlements"),
            F.sum("dispute_count").alias("disputes"),
            F.sum("leakage_rs").alias("leakage_rs"),
        )
        .select(label.alias(name), "settlements", "disputes", "leakage_rs")
    )


def daily_leakage(outcome_rows: DataFrame) -> DataFrame:
    """Running totals by day."""
    span = F.window(F.col("settlement_date").cast("timestamp"), "1 day")
    return _windowed(outcome_rows, span, F.col("w.start").cast("date"), "kpi_date")


def weekly_leakage(outcome_rows: DataFrame) -> DataFrame:
    """Running totals of weeks from Sunday to Saturday, labelled by their Monday."""
    # Windows count from a Thursday, so three days of offset make them start on Sundays.
    span = F.window(F.col("settlement_date").cast("timestamp"), "7 days", "7 days", "3 days")
    return _windowed(outcome_rows, span, F.date_add(F.col("w.start").cast("date"), 1), "wk")


def sliding_leakage(outcome_rows: DataFrame, weeks: int = 4) -> DataFrame:
    """Running totals of spans of some weeks from Sunday to Saturday, one span for each week that it may begin with."""
    span = F.window(F.col("settlement_date").cast("timestamp"), f"{7 * weeks} days", "7 days", "3 days")
    return _windowed(outcome_rows, span, F.col("w.start").cast("date"), "span_start")


def keep_windows(windows: DataFrame, spark: SparkSession, folder: str) -> EpochTable:
    """Write the windows after each micro-batch; the last one's are the present totals."""
    table = EpochTable(spark, folder, windows.schema, keep=2)
    each_batch(windows, table.write, f"{folder}-progress", "complete")
    return table
