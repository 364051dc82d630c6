"""A reconciliation run: load, checks, outcomes, mart, events, exports."""

from __future__ import annotations

import datetime
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.operators.quality import result_violations, warehouse_violations
from remitlens.operators.reconcile import list_discrepancies, outcomes, summarise
from remitlens.plans.copies import refresh_copies, store_copies
from remitlens.plans.kpis import with_disputed
from remitlens.plans.marts import daily_kpis, upsert_daily_kpis
from remitlens.plans.warehouse import from_tables
from remitlens.schema import WAREHOUSE_TABLES
from remitlens.sources import csv_tables, exports
from remitlens.sources.events import event_rows, write_events
from remitlens.sources.store import TableStore


def reconcile_into(store: TableStore, settlements: DataFrame, orders: DataFrame, batch_id: str | None = None) -> None:
    """Store the outcomes of all batches, or of one.

    One batch's run reads its own settlements and the stored copies; other batches keep the outcomes that they have.
    """
    if batch_id is None:
        copies = store_copies(store, settlements)
    else:
        copies = refresh_copies(store, settlements, batch_id)
    store.write_outcomes(outcomes(settlements, orders, batch_id, counts=copies), batch_id)


def run_cycle(store: TableStore, tables: dict[str, DataFrame], as_of: datetime.date, detected_at: datetime.datetime,
              version: int, batch_id: str | None = None) -> DataFrame:
    """Reconcile all batches or one, refresh the mart, write the events; returns the summary by type.

    Each step reads what the step before wrote. One batch's run recomputes the days that its old or new settlements
    touch and no others. Mart cells that no settlement supports any more are kept.
    """
    wh = from_tables(tables, as_of)
    if batch_id is None:
        reconcile_into(store, tables["fact_settlements"], tables["fact_orders"])
        store.write("daily_kpis", daily_kpis(replace(wh, outcomes=store.read("outcomes"))), _month("kpi_date"))
        touched = store.read("outcomes")
    else:
        # A batch settles a bounded number of days, whatever its rows.
        days_of = lambda: {r[0] for r in store.read("outcomes", batch_id).select("settlement_date").distinct().collect()}
        before = days_of()
        reconcile_into(store, tables["fact_settlements"], tables["fact_orders"], batch_id)
        days = sorted(day for day in before | days_of() if day)
        refresh_mart(store, replace(wh, outcomes=store.read("outcomes")), days)
        touched = store.read("outcomes", batch_id)
    found = list_discrepancies(touched)
    write_events(event_rows(found, detected_at), store.path(f"events/version={version}"))
    return summarise(found)


def _month(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def refresh_mart(store: TableStore, wh, days: list[datetime.date]) -> None:
    """Recompute the mart's cells of some days from the outcomes of these days; their months are written anew."""
    if days:
        fresh = daily_kpis(replace(wh, outcomes=wh.outcomes.where(F.col("settlement_date").isin(*days))))
        months = sorted({f"{day:%Y-%m}" for day in days})
        store.replace("daily_kpis", upsert_daily_kpis(store.read("daily_kpis", *months), fresh), _month("kpi_date"), months)


def run_all(spark: SparkSession, source: str, folder: str, as_of: datetime.date,
            detected_at: datetime.datetime) -> dict[str, DataFrame]:
    """From a folder of CSV files to the written exports.

    Loads the warehouse, keeps its tables, checks them, reconciles all batches, builds the mart, writes events and the
    serving and report exports below ``folder``. Returns ``violations`` of the given and the resulting tables, and
    ``summary``. Violations do not stop the run.
    """
    store = TableStore(spark, folder)
    for name, table in csv_tables.load_warehouse(spark, source).items():
        store.write(name, table)
    tables = {name: store.read(name) for name in WAREHOUSE_TABLES}
    summary = run_cycle(store, tables, as_of, detected_at, 1)
    wh = with_disputed(replace(from_tables(tables, as_of), outcomes=store.read("outcomes")))
    mart, health = store.read("daily_kpis"), exports.health_of(wh)
    exports.write_json(exports.serving_frames(wh, health), f"{folder}/serving")
    exports.write_csv(exports.report_frames(wh, mart, health), f"{folder}/report")
    violations = warehouse_violations(tables, WAREHOUSE_TABLES).unionByName(
        result_violations(wh.discrepancies, mart, tables)
    )
    return {"violations": violations, "summary": summary}
