"""Sketches against exact values, over many ranges and slices."""

import datetime
import random
from types import SimpleNamespace

from remitlens.operators.reconcile import outcomes
from remitlens.plans import sketches
from remitlens.plans.warehouse import BenchmarkWarehouse
from remitlens.session import written
from tests.conftest import SMALL, day


def test_ranges_and_slices_are_within_the_errors(spark):
    wh = BenchmarkWarehouse(spark, "/root/testdata/sf0.01")
    mart = written(sketches.sketch_mart(wh), "sketch-mart")
    rows = [tuple(r) for r in wh.outcomes.select("settlement_date", "courier_id", "geo_id", "awb_number", "dispute_count", "settled_cod").collect()]
    rng, start = random.Random(5), datetime.date(1992, 1, 1)
    for _ in range(4):
        first = start + datetime.timedelta(days=rng.randint(0, 1500))
        last = first + datetime.timedelta(days=rng.choice([0, 6, 90, 900]))
        for by, place in (((), None), (("courier_id",), 1), (("geo_id",), 2)):
            found = {tuple(r)[: len(by)]: r for r in sketches.estimates(sketches.merged(mart, *by, first=first, last=last), *by).collect()}
            held = {}
            for row in rows:
                if first <= row[0] <= last:
                    held.setdefault(() if place is None else (row[place],), []).append(row)
            assert set(found) == (set(held) or ({()} if not by else set()))
            for key, inside in held.items():
                awbs, disputed = {r[3] for r in inside}, {r[3] for r in inside if r[4] > 0}
                got, paid = found[key], sorted(float(r[5]) for r in inside)
                assert abs(got.awbs - len(awbs)) <= sketches.DISTINCT_ERROR * len(awbs) + 1
                assert abs(got.disputed - len(disputed)) <= sketches.DISTINCT_ERROR * len(disputed) + 1
                for rank, value in ((0.5, got.paid_p50), (0.95, got.paid_p95)):
                    below, upto = sum(p < value for p in paid) / len(paid), sum(p <= value for p in paid) / len(paid)
                    assert below <= rank + sketches.RANK_ERROR + 1 / len(paid) and upto >= rank - sketches.RANK_ERROR - 1 / len(paid)


def test_merging_reads_cells_and_not_rows(spark):
    wh = BenchmarkWarehouse(spark, SMALL)
    mart = written(sketches.sketch_mart(wh), "sketch-mart")
    plan = sketches.merged(mart, "courier_id", first=datetime.date(1995, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(kpi_date,1995-01-01)" in plan and "awb_number" not in plan
    whole = sketches.estimates(sketches.merged(mart)).first().awbs
    assert abs(whole - wh.settlements.select("awb_number").distinct().count()) <= sketches.DISTINCT_ERROR * whole + 1


def test_an_awb_of_many_days_counts_once(spark, orders_of, settlements_of):
    """The sum of daily distinct counts would count it once per day."""
    orders = orders_of(*[dict(awb_number=f"A{i}") for i in range(3)])
    settled = settlements_of(*[dict(awb_number=f"A{i}", settlement_date=day(n)) for i in range(3) for n in range(4)])
    wh = SimpleNamespace(outcomes=outcomes(settled, orders))
    mart = sketches.sketch_mart(wh)
    assert [r.awbs for r in sketches.estimates(mart, "kpi_date").collect()] == [3] * 4
    assert sketches.estimates(sketches.merged(mart, last=day(2))).first().awbs == 3


def test_an_empty_range_has_no_sketch(spark):
    mart = sketches.sketch_mart(BenchmarkWarehouse(spark, SMALL))
    assert sketches.merged(mart, "courier_id", first=datetime.date(2050, 1, 1)).count() == 0
    none = sketches.estimates(sketches.merged(mart, first=datetime.date(2050, 1, 1))).first()
    assert (none.awbs, none.disputed, none.paid_p50) == (0, 0, None)
