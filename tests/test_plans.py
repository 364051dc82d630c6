"""Plan shapes that matter at scale."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from remitlens.operators import reconcile as rec
from remitlens.plans import integrity, kpis, marts
from remitlens.plans.warehouse import BenchmarkWarehouse, from_tables
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def wh(spark):
    return BenchmarkWarehouse(spark, SMALL)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to send whole."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reconcile_shuffles_each_side_once(wh, no_broadcast):
    plan = planned(rec.reconcile(wh.settlements, wh.orders))
    # Settlements, orders and repeated AWBs each once by key and share; only the marked buckets are broadcast.
    assert len(re.findall(r"Exchange hashpartitioning\(awb_number#\d+, _share#\d+", plan)) == 3
    assert len(re.findall("SortMergeJoin", plan)) == 2
    bounded = re.findall(r"BroadcastExchange.*\n.*HashAggregate\(.*output=\[_bucket#\d+, _shares#\d+\]", plan)
    assert len(bounded) == len(re.findall("BroadcastExchange", plan)) == 3


def test_a_rule_asks_its_sides_before_the_join(wh, no_broadcast):
    phantom = planned(rec.reconcile(wh.settlements, wh.orders, names=("PHANTOM_RTO_CHARGE",)))
    assert "GreaterThan(rto_charge,0" in phantom and "EqualTo(order_status,DELIVERED)" in phantom
    # Copies are joined for the duplicate rule alone, and its rows shrink to copies first.
    assert len(re.findall("SortMergeJoin", phantom)) == 1 and phantom.count("copies") < planned(
        rec.reconcile(wh.settlements, wh.orders, names=("DUPLICATE_SETTLEMENT",))
    ).count("copies")
    assert "GreaterThan(cod_amount,0" in planned(rec.reconcile(wh.settlements, wh.orders, names=("COD_SHORT_REMITTANCE",)))
    assert len(re.findall("SortMergeJoin", planned(rec.reconcile(wh.settlements, wh.orders, names=("ETA_SLA_BREACH",))))) == 1


def test_the_mart_refresh_reads_touched_days_only(spark, wh):
    day = wh.outcomes.agg({"settlement_date": "max"}).first()[0]
    plan = planned(marts.daily_kpis(replace(from_tables({
        "dim_courier": wh.couriers, "dim_geography": wh.geography, "dim_merchant": wh.merchants,
        "fact_orders": wh.orders, "fact_settlements": wh.settlements,
    }, day), outcomes=wh.outcomes.where(F.col("settlement_date").isin(day)))))
    assert f"EqualTo(settlement_date,{day})" in plan


def test_reconciling_one_batch_reads_its_partition(wh):
    plan = planned(rec.reconcile(wh.settlements, wh.orders, "RUN-1998"))
    assert re.search(r"PartitionFilters: \[isnotnull\(batch_id#\d+\), \(batch_id#\d+ = RUN-1998\)\]", plan)


def test_header_reads_three_columns_and_shuffles_once_by_awb(wh):
    plan = planned(kpis.header_kpis(wh).drop("avg_dso_days"))
    assert "ReadSchema: struct<awb_number:string,dispute_count:int,leakage_rs:decimal(14,2)>" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Expand" not in plan


def test_discrepancy_queries_push_their_filter(wh):
    assert "PushedFilters: [IsNotNull(dispute_count), GreaterThan(dispute_count,0)" in planned(kpis.cells(wh))


def test_lists_keep_only_the_top_rows(wh):
    assert "TakeOrderedAndProject" in planned(integrity.overdue_list(wh))


def test_phantom_count_reads_the_type_field_only(wh):
    plan = planned(kpis.disputes_by_awb(wh.outcomes))
    assert "disputes:array<struct<discrepancy_type:string>>" in plan
