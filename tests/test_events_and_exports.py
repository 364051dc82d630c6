import datetime
import json

from remitlens.operators.reconcile import reconcile
from remitlens.plans import cycle, kpis, marketplace, marts, segments
from remitlens.plans.marketplace import BenchmarkMarketplace
from remitlens.plans.warehouse import BenchmarkWarehouse, from_tables
from remitlens.session import names_in, new_folder, scratch
from remitlens.schema import WAREHOUSE_TABLES
from remitlens.sources import csv_tables, events, exports
from tests.conftest import SMALL, day

AT = datetime.datetime(2026, 9, 14, 22, 11, 32, 127304)


def test_event_lines(spark, orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A", declared_weight="7.324"))
    settled = settlements_of(dict(awb_number="A", charged_weight="7.324", forward_charge=114))
    path = new_folder(spark, "events")
    events.write_events(events.event_rows(reconcile(settled, orders), AT), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    key = "A|B1|EXCESS_FORWARD_CHARGE"
    assert lines == [
        {
            "discrepancy_id": key, "awb_number": "A", "batch_id": "B1", "courier_id": 1, "merchant_id": "M-1",
            "geo_id": 1, "discrepancy_type": "EXCESS_FORWARD_CHARGE", "expected_value": 95.0, "actual_value": 114.0,
            "variance_rs": 19.0, "severity": "LOW", "detected_at": "2026-09-14 22:11:32.127304",
            "idempotency_key": key,
        }
    ]
    assert list(lines[0]) == events.EVENT_SCHEMA.fieldNames()


def test_event_keys_nulls_and_batch_filter(spark):
    rows = spark.createDataFrame(
        [("x|B1|T", "x", "B1", None), ("y|B2|T", "y", "B2", 1.5)],
        "discrepancy_id string, awb_number string, batch_id string, expected_value double",
    ).selectExpr(
        "*", "1 courier_id", "'M' merchant_id", "1 geo_id", "'T' discrepancy_type", "0d actual_value",
        "0d variance_rs", "'LOW' severity",
    )
    messages = events.event_messages(events.event_rows(rows, AT, "B1")).collect()
    assert [m.key for m in messages] == ["x|B1|T"]
    assert json.loads(messages[0].value)["expected_value"] is None


def test_report_and_serving_exports(spark):
    wh = BenchmarkWarehouse(spark, SMALL)
    mart = marts.daily_kpis(wh)
    folder = new_folder(spark, "exports")
    report = {k: v for k, v in exports.report_frames(wh, mart).items() if k != "merchant_health"}
    exports.write_csv(report, folder)
    daily = spark.read.option("header", True).csv(f"{folder}/kpi_daily")
    assert daily.columns == [
        "kpi_date", "courier_name", "city", "tier", "orders", "disputed_awbs", "leakage_rs", "avg_dso_days"
    ]
    assert daily.count() == mart.count()
    found = spark.read.option("header", True).csv(f"{folder}/discrepancies")
    assert found.count() == wh.discrepancies.count()
    serving = {k: v for k, v in exports.serving_frames(wh).items() if k in ("funnel", "forecast")}
    exports.write_json(serving, folder)
    sizes = {r.export_name: r.row_count for r in exports.bundle_sizes(spark, folder, list(serving), "json").collect()}
    assert sizes["funnel"] == 5 and sizes["forecast"] > 4


def test_market_exports(spark):
    market = BenchmarkMarketplace(spark, SMALL)
    folder = new_folder(spark, "market")
    frames = exports.market_frames(market)
    exports.write_csv({k: frames[k] for k in ("review_impact", "monthly", "seller_late")}, folder)
    impact = {(r.late_flag, r.sentiment): int(r.orders)
              for r in spark.read.option("header", True).csv(f"{folder}/review_impact").collect()}
    assert impact == {
        ("Late", "Bad"): 163, ("Late", "Good"): 101, ("On-time", "Bad"): 1648, ("On-time", "Good"): 1103
    }
    first = marketplace.review_impact_first(market).first()
    assert (first.late_bad, first.late_good, first.ontime_bad, first.ontime_good) == (54, 30, 512, 370)
    assert marketplace.seller_late(market).count() == 10


def test_mart_refreshes(spark, orders_of, settlements_of):
    couriers = spark.sql("select 1 courier_id, 'A' courier_name")
    places = spark.sql("select 1 geo_id, 'X' city, 'Tier-1' tier")

    def mart_of(*settled):
        orders = orders_of(*[dict(awb_number=f"A{i}") for i in range(4)])
        tables = {"dim_courier": couriers, "dim_geography": places, "dim_merchant": None,
                  "fact_orders": orders, "fact_settlements": settlements_of(*settled)}
        return marts.daily_kpis(from_tables(tables, day(40)))

    before = mart_of(
        dict(awb_number="A0", rto_charge=150), dict(awb_number="A1"), dict(awb_number="A2", settlement_date=day(6))
    )
    # The cell weighs an order by its number of discrepancies, two of A0's rows against one of A1's.
    twice = mart_of(
        dict(awb_number="A0", rto_charge=150, charged_weight=3, settlement_date=day(8)), dict(awb_number="A1")
    ).collect()
    assert {r.kpi_date: (r.orders, r.disputed_awbs, float(r.avg_dso_days)) for r in twice} == {
        day(8): (1, 1, 8.0), day(5): (1, 0, 5.0)
    }
    after = mart_of(dict(awb_number="A0"), dict(awb_number="A1", courier_id=2))
    merged = {(r.kpi_date, r.courier_id): (r.orders, int(r.leakage_rs))
              for r in marts.upsert_daily_kpis(before, after).collect()}
    assert merged == {(day(5), 1): (1, 0), (day(5), 2): (1, 0), (day(6), 1): (1, 0)}


def test_sample_folder_to_report(spark, tmp_path, orders_of, settlements_of):
    """CSV in, discrepancies out."""
    (tmp_path / "dim_courier.csv").write_text("courier_id,courier_name,base_rate_rs,sla_hours\n1,A,45,72\n")
    (tmp_path / "dim_geography.csv").write_text("geo_id,city,tier,zone\n1,X,Tier-1,W\n")
    (tmp_path / "dim_merchant.csv").write_text("merchant_id,merchant_name,category\nM-1,N,Food\n")
    orders_of(dict(awb_number="A")).toPandas().to_csv(tmp_path / "fact_orders.csv", index=False)
    settlements_of(dict(awb_number="A", rto_charge=150)).toPandas().to_csv(
        tmp_path / "fact_settlements.csv", index=False
    )
    wh = from_tables(csv_tables.load_warehouse(spark, str(tmp_path)), day(40))
    rows = [tuple(r) for r in marts.discrepancies_export(wh).select("courier_name", "city", "variance_rs").collect()]
    assert rows == [("A", "X", 150)]


def test_scratch_goes_and_staged_tables_stay(spark):
    wh = BenchmarkWarehouse(spark, SMALL)
    with scratch(spark):
        kept, gone = wh.written_folder("outcomes"), new_folder(spark, "gone")
        spark.range(3).write.parquet(gone)
        with scratch(spark):
            inner = new_folder(spark, "inner")
            spark.range(3).write.parquet(inner)
        assert not names_in(spark, inner) and names_in(spark, gone)
    assert names_in(spark, kept) and not names_in(spark, gone)


def test_parsing_some_fields_of_an_event(spark):
    lines = [('{"discrepancy_type":"T","variance_rs":1.5,"courier_id":"no number"}',), ("no JSON",), (None,), ('{"variance_rs":null}',)]
    messages = spark.createDataFrame(lines, "value string")
    fields = ("variance_rs", "discrepancy_type")
    some = events.parse_messages(messages, *fields)
    assert some.collect() == events.parse_messages(messages).select(*fields).collect()
    assert some.columns == list(fields)


def test_exports_of_a_run_share_their_joins(spark, monkeypatch):
    """Orders meet their discrepancies once in a run, and merchants and headline figures are computed once."""
    wh, source, out = BenchmarkWarehouse(spark, SMALL), new_folder(spark, "source"), new_folder(spark, "run")
    frames = (wh.couriers, wh.geography, wh.merchants, wh.orders, wh.settlements)
    for name, table in zip(WAREHOUSE_TABLES, frames, strict=True):
        table.write.options(header=True, quote='"', escape='"').csv(f"{source}/{name}.csv")
    written, headers = [], []
    for module in (kpis, segments):
        whole = module.written
        monkeypatch.setattr(module, "written", lambda df, name, *rest, whole=whole: written.append(name) or whole(df, name, *rest))
    header = kpis.header_kpis
    monkeypatch.setattr(kpis, "header_kpis", lambda w: headers.append(w) or header(w))
    cycle.run_all(spark, source, out, datetime.date(2001, 8, 1), AT)
    assert sorted(written) == ["disputed", "merchant-totals"] and len(headers) == 1
    merchants = spark.read.json(f"{out}/serving/merchants")
    assert merchants.count() == spark.read.option("header", True).csv(f"{out}/report/merchant_health").count() > 0
    funnel = {r.stage: r.n for r in spark.read.json(f"{out}/serving/funnel").collect()}
    assert funnel["Settled"] == spark.read.json(f"{out}/serving/kpis").first().settled_awbs
