"""Bursts of disputed settlements: sessions by courier and place that end when nothing comes for some days.

The state has one row per session of the whole history, and a settlement that comes late may extend a session or make two
one, so no session is ever closed. Each micro-batch leaves the sessions as they are then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("courier_id", "geo_id")


def bursts(outcome_rows: DataFrame, gap_days: int = 5, least_rs: int = 5000) -> DataFrame:
    """Sessions of settlements with a leakage of at least ``least_rs``, from a stream (complete mode) or a table.

    ``burst_start`` and ``burst_end`` are the days of its first and last settlement; those no more than ``gap_days``
    apart belong together. Rows without a date are in no session.
    """
    rows = outcome_rows.where((F.col("leakage_rs") >= least_rs) & F.col("settlement_date").isNotNull())
    span = F.session_window(F.col("settlement_date").cast("timestamp"), f"{gap_days} days")
    return rows.groupBy(*KEYS, span.alias("w")).agg(
        F.count(F.lit(1)).alias("settlements"), F.sum("dispute_count").alias("disputes"), F.sum("leakage_rs").alias("leakage_rs")
    ).select(
        *KEYS, F.col("w.start").cast("date").alias("burst_start"), F.date_sub(F.col("w.end").cast("date"), gap_days).alias("burst_end"),
        "settlements", "disputes", "leakage_rs",
    )
