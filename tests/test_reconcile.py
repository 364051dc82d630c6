import datetime

import pytest
from pyspark.sql import functions as F

from remitlens.operators import reconcile as rec
from remitlens.operators import upsert
from remitlens.plans import cycle
from remitlens.plans.copies import refresh_copies
from remitlens.plans.cycle import run_cycle
from remitlens.plans.warehouse import BenchmarkWarehouse, unstaged_warehouse
from remitlens.session import names_in, new_folder
from remitlens.settings import SkewSettings
from remitlens.sources.store import TableStore
from tests.conftest import SMALL, day

EAGER = SkewSettings(heavy_rows=3, rows_per_share=2, buckets=2)


@pytest.fixture(scope="module")
def benchmark(spark):
    return BenchmarkWarehouse(spark, SMALL)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_counts_of_the_small_tables(spark):
    found = {r[0]: (r[1], float(r[2])) for r in rec.summarise(unstaged_warehouse(spark, SMALL).discrepancies).collect()}
    assert found == {
        "COD_SHORT_REMITTANCE": (227, 1510955.50),
        "WEIGHT_DISPUTE": (26, 743.0),
        "PHANTOM_RTO_CHARGE": (52, 20107.0),
        "OVERDUE_REMITTANCE": (251, 38962522.14),
        "DUPLICATE_SETTLEMENT": (154, 21950445.0),
        "ETA_SLA_BREACH": (209, 0.0),
        "EXCESS_FORWARD_CHARGE": (115, 1824.4),
    }


def test_every_copy_is_flagged_and_copies_in_one_batch_are_reported(orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A"), dict(awb_number="B"), dict(awb_number="C"))
    settled = settlements_of(
        dict(awb_number="A", batch_id="B1"), dict(awb_number="A", batch_id="B2"),
        dict(awb_number="B", batch_id="B1"), dict(awb_number="B", batch_id="B1"), dict(awb_number="C"),
    )
    found = rec.reconcile(settled, orders).collect()
    assert sorted((r.awb_number, r.batch_id, int(r.actual_value), r.severity) for r in found) == [
        ("A", "B1", 2, "HIGH"), ("A", "B2", 2, "HIGH"), ("B", "B1", 2, "HIGH"), ("B", "B1", 2, "HIGH"),
    ]
    assert [tuple(r) for r in rec.same_batch_copies(settled).collect()] == [("B", "B1", 2)]


def test_settlements_without_order_stay_as_outcomes_but_yield_nothing(orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A"))
    settled = settlements_of(dict(awb_number="X", rto_charge=900), dict(awb_number="X", batch_id="B2"))
    kept = rec.outcomes(settled, orders).collect()
    assert len(kept) == 2 and all(not r.has_order and r.dispute_count == 0 for r in kept)
    assert rec.reconcile(settled, orders).count() == 0
    assert [r.awb_number for r in rec.unsettled_orders(settled, orders).collect()] == ["A"]


def test_spreading_heavy_keys_changes_no_row(orders_of, settlements_of):
    """One AWB holds a third of the rows, a second is heavy too, a third exceeds the list of heavy keys."""
    orders = orders_of(*[dict(awb_number=f"A{i}") for i in range(60)])
    awbs = ["A0"] * 40 + ["A1"] * 12 + ["A2"] * 8 + [f"A{i}" for i in range(3, 63)]
    settled = settlements_of(*[dict(awb_number=a, batch_id=f"B{i}", rto_charge=i) for i, a in enumerate(awbs)])
    plain = rec.outcomes(settled, orders)
    assert plain.count() == len(awbs)
    assert rows_of(rec.outcomes(settled, orders, skew=EAGER)) == rows_of(plain)
    assert rows_of(rec.reconcile(settled, orders, skew=EAGER)) == rows_of(rec.list_discrepancies(plain))


def test_attached_discrepancies_equal_outcomes(benchmark):
    whole = benchmark.outcomes.select("settlement_id", "dispute_count", "leakage_rs")
    for skew in (rec.SKEW, SkewSettings(heavy_rows=2, rows_per_share=1, buckets=5)):
        joined = rec.attach_discrepancies(benchmark.settlements, benchmark.orders, benchmark.discrepancies, skew)
        assert rows_of(joined.select(whole.columns)) == rows_of(whole)


def test_attached_discrepancies_are_whole_for_a_heavy_pair(orders_of, settlements_of):
    """A pair of AWB and batch that repeats meets all discrepancies of the pair, as the join says."""
    orders = orders_of(dict(awb_number="A"), dict(awb_number="B"))
    settled = settlements_of(*[dict(awb_number="A", rto_charge=1 + i) for i in range(6)], dict(awb_number="B"))
    found = rec.reconcile(settled, orders)
    joined = rec.attach_discrepancies(settled, orders, found, EAGER)
    assert sorted(r.dispute_count for r in joined.collect()) == [0] + [12] * 6


def test_batch_reruns_are_idempotent(spark, orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A"), dict(awb_number="B"))
    settled = settlements_of(
        dict(awb_number="A", batch_id="B1", rto_charge=150), dict(awb_number="B", batch_id="B2", rto_charge=200)
    )
    store = TableStore(spark, new_folder(spark, "store"))
    stored = lambda: rows_of(rec.list_discrepancies(store.read("outcomes")))
    store.write_outcomes(rec.outcomes(settled, orders))
    first = stored()
    assert len(first) == 2
    for batch in (None, "B1", "B1", "B2"):
        store.write_outcomes(rec.outcomes(settled, orders, batch), batch)
        assert stored() == first
    # A batch that lost its discrepancies, and one that lost its settlements, keep none.
    clean = settled.withColumn("rto_charge", F.lit(0).cast("decimal(10,2)"))
    store.write_outcomes(rec.outcomes(clean, orders, "B1"), "B1")
    assert [r[0] for r in stored()] == [r[0] for r in first if "B2" in str(r)]
    gone = settled.where("batch_id <> 'B2'")
    store.write_outcomes(rec.outcomes(gone, orders, "B2"), "B2")
    assert stored() == []


ODD = ["A+B", "B(1)", "a/b", "a=b", "50%", "%2F", "0023", "2026-01-06", "श्री", " lead", "trail ", "", "null", "__HIVE_DEFAULT_PARTITION__", None]


def test_batches_of_any_name_are_replaced(spark):
    rows = [(b, i, "old") for b in ODD for i in range(3)]
    store = TableStore(spark, new_folder(spark, "store"))
    store.write("t", spark.createDataFrame(rows, "b string, i int, v string"), "b")
    assert store.read("t", "0023").schema["b"].dataType.typeName() == "string"
    assert rows_of(store.read("t")) == sorted(rows, key=str)
    for batch in ODD:
        store.replace("t", spark.createDataFrame([(batch, 9, "new")], "b string, i int, v string"), "b", [batch])
    want = sorted(((b, 9, "new") for b in ODD), key=str)
    assert rows_of(store.read("t")) == want
    assert [tuple(r) for r in store.read("t", "0023").collect()] == [("0023", 9, "new")]
    assert [tuple(r) for r in store.read("t", None).collect()] == [(None, 9, "new")]
    store.replace("t", store.read("t").limit(0), "b", ["a/b", None])
    assert rows_of(store.read("t")) == [r for r in want if r[0] not in ("a/b", None)]
    assert rows_of(store.read("t", "a/b")) == []


def test_a_failed_write_changes_nothing(spark):
    store = TableStore(spark, new_folder(spark, "store"))
    rows = spark.createDataFrame([("B1", 1), ("B2", 2)], "b string, i int")
    store.write("t", rows, "b")
    broken = rows.where("b = 'B1'").withColumn("i", F.raise_error(F.lit("lost")).cast("int"))
    for write in (lambda: store.replace("t", broken, "b", ["B1"]), lambda: store.write("t", broken, "b")):
        with pytest.raises(Exception, match="lost"):
            write()
        assert rows_of(store.read("t")) == [("B1", 1), ("B2", 2)]
    store.replace("t", store.read("t", "B1").withColumn("i", F.lit(5)), "b", ["B1"])
    assert rows_of(store.read("t")) == [("B1", 5), ("B2", 2)]
    # Only the last two versions stay.
    for i in range(3):
        store.write("t", rows.withColumn("i", F.lit(i)), "b")
    assert rows_of(store.read("t")) == [("B1", 2), ("B2", 2)]
    assert len([n for n in names_in(spark, store.path("t")) if n.startswith("version=")]) <= 3


def test_one_value_reads_its_partition(spark):
    store = TableStore(spark, new_folder(spark, "store"))
    store.write("t", spark.createDataFrame([(f"B{i}", i) for i in range(20)], "b string, i int"), "b")
    assert len(store.read("t", "B3").inputFiles()) == 21
    plan = store.read("t", "B3")._jdf.queryExecution().executedPlan().toString()
    assert "(_split#" in plan and "= xB3" in plan and plan.count("PartitionFilters: []") == 0


def counts_of(store):
    return {(r.awb_number, r.batch_id): r.copies for r in store.read("copies").collect()}


def test_copies_are_kept_by_batch_and_changed_by_difference(spark, orders_of, settlements_of):
    orders = orders_of(*[dict(awb_number=f"A{i}") for i in range(6)])
    rows = [dict(awb_number=f"A{i % 6}", batch_id=f"B{i % 4}") for i in range(24)]
    settled = settlements_of(*rows)
    store = TableStore(spark, new_folder(spark, "store"))
    cycle.reconcile_into(store, settled, orders)
    assert rows_of(rec.list_discrepancies(store.read("outcomes"))) == rows_of(rec.reconcile(settled, orders))
    # Batch B2 loses an AWB, gains another and gets a third copy of a third.
    changed = [dict(awb_number=a, batch_id="B2") for a in ("A1", "A4", "A4", "A4")]
    now = settlements_of(*[r for r in rows if r["batch_id"] != "B2"], *changed)
    for _ in range(2):
        cycle.reconcile_into(store, now, orders, "B2")
        want = {}
        for r in now.collect():
            want[r.awb_number, r.batch_id] = want.get((r.awb_number, r.batch_id), 0) + 1
        assert counts_of(store) == want
        got = rec.list_discrepancies(store.read("outcomes", "B2"))
        assert rows_of(got) == rows_of(rec.reconcile(now, orders, "B2"))
    cycle.reconcile_into(store, now.where("batch_id <> 'B2'"), orders, "B2")
    assert not [key for key in counts_of(store) if key[1] == "B2"] and store.read("outcomes", "B2").count() == 0


def test_an_unchanged_batch_writes_no_counts(spark, orders_of, settlements_of):
    store = TableStore(spark, new_folder(spark, "store"))
    settled = settlements_of(*[dict(awb_number=f"A{i}", batch_id=f"B{i % 3}") for i in range(30)])
    cycle.reconcile_into(store, settled, orders_of(dict(awb_number="A0")))
    before = sorted(store.read("copies").inputFiles())
    cycle.reconcile_into(store, settled, orders_of(dict(awb_number="A0")), "B1")
    assert sorted(store.read("copies").inputFiles()) == before
    more = settled.unionByName(settlements_of(dict(awb_number="A1", batch_id="B1", settlement_id="T")))
    cycle.reconcile_into(store, more, orders_of(dict(awb_number="A0")), "B1")
    assert len(set(store.read("copies").inputFiles()) - set(before)) == 1


def test_one_batch_reads_its_own_settlements(spark, benchmark):
    """Neither the counts nor the outcomes of one batch scan the settlements of another."""
    wh, store = BenchmarkWarehouse(spark, SMALL), TableStore(spark, new_folder(spark, "store"))
    cycle.reconcile_into(store, wh.settlements, wh.orders)
    copies = refresh_copies(store, wh.settlements, "RUN-1997")
    plan = rec.outcomes(wh.settlements, wh.orders, "RUN-1997", counts=copies)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "settlement_id#" in line and "FileScan" in line]
    scans += [line for line in plan.splitlines() if "FileScan" in line and "/settlements-" in line]
    assert scans and all("= RUN-1997)" in line.partition("PartitionFilters")[2] for line in scans)
    assert "LeftSemi" in plan


def test_a_cycle_refreshes_mart_and_events(spark, orders_of, settlements_of):
    couriers = spark.sql("select 1 courier_id, 'A' courier_name")
    tables = {
        "dim_courier": couriers, "dim_geography": None, "dim_merchant": None,
        "fact_orders": orders_of(dict(awb_number="A"), dict(awb_number="B")),
        "fact_settlements": settlements_of(
            dict(awb_number="A", batch_id="B1", rto_charge=150), dict(awb_number="B", batch_id="B2", rto_charge=200)
        ),
    }
    store, at = TableStore(spark, new_folder(spark, "store")), datetime.datetime(2026, 9, 14)
    summary = run_cycle(store, tables, day(40), at, 1).collect()
    assert [(r.discrepancy_type, r.cases, int(r.leakage_rs)) for r in summary] == [("PHANTOM_RTO_CHARGE", 2, 350)]
    assert [int(r.leakage_rs) for r in store.read("daily_kpis").collect()] == [350]
    # Batch B1 moves to another day without its charge; the day's cell shrinks to B2, the new day appears.
    tables["fact_settlements"] = settlements_of(
        dict(awb_number="A", batch_id="B1", settlement_date=day(6)), dict(awb_number="B", batch_id="B2", rto_charge=200)
    )
    assert run_cycle(store, tables, day(40), at, 2, "B1").collect() == []
    mart = {r.kpi_date: (r.orders, int(r.leakage_rs)) for r in store.read("daily_kpis").collect()}
    assert mart == {day(5): (1, 200), day(6): (1, 0)}
    assert spark.read.text(store.path("events/version=1")).count() == 2
    assert spark.read.text(store.path("events/version=2")).count() == 0
    store.register_views("outcomes")
    asked = spark.sql("select awb_number from outcomes where leakage_rs > :floor", args={"floor": 100}).collect()
    assert [r.awb_number for r in asked] == ["B"]


def test_one_batch_counts_copies_over_all(orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A"))
    settled = settlements_of(dict(awb_number="A", batch_id="B1"), dict(awb_number="A", batch_id="B2"))
    found = rec.reconcile(settled, orders, "B2").collect()
    assert [(r.batch_id, r.discrepancy_type) for r in found] == [("B2", "DUPLICATE_SETTLEMENT")]


def test_merges(spark):
    old = spark.createDataFrame([("a", "B1", 1), ("b", "B2", 2)], "k string, batch_id string, v int")
    changed = spark.createDataFrame([("b", "B2", 9), ("d", "B3", 4)], old.schema)
    merged = {r.k: r.v for r in upsert.merge_rows(old, changed, ["k"]).collect()}
    assert merged == {"a": 1, "b": 9, "d": 4}
    kept = {r.k: r.v for r in upsert.insert_missing(old, changed, ["k"]).collect()}
    assert kept == {"a": 1, "b": 2, "d": 4}


def test_totals_agree_across_reports(benchmark):
    from remitlens.plans import kpis

    header = kpis.header_kpis(benchmark).first()
    for report in (
        kpis.daily_trend(benchmark), kpis.weekly_trend(benchmark), kpis.leakage_by(benchmark, "tier"),
        kpis.leakage_by(benchmark, "courier_name"), kpis.leakage_by(benchmark, "discrepancy_type"),
        kpis.tier_entry(benchmark), kpis.courier_rates(benchmark),
    ):
        assert report.agg(F.sum("leakage_rs")).first()[0] == header.leakage_rs
    whole = kpis.rca_rollup(benchmark).where("level = 7").first()
    assert (whole.cases, whole.leakage_rs) == (benchmark.discrepancies.count(), header.leakage_rs)
