import datetime
import gzip
import os
from decimal import Decimal

import pytest

from remitlens import schema
from remitlens.operators import quality
from remitlens.sources import csv_tables


def write(folder, name, text) -> str:
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)
    return path


def test_named_columns_and_empty_text(spark, tmp_path):
    path = write(tmp_path, "g.csv", "zone,geo_id,tier,city\nWest,1,Tier-1,Mumbai\n,2,Tier-2,\n")
    rows = [tuple(r) for r in csv_tables.read_named(spark, path, schema.DIM_GEOGRAPHY).collect()]
    assert rows == [(1, "Mumbai", "Tier-1", "West"), (2, None, "Tier-2", None)]


def test_positional_columns_ignore_the_header(spark, tmp_path):
    path = write(tmp_path, "c.csv", "x,y,z,w\n1,Blue,45.50,72\n")
    rows = [tuple(r) for r in csv_tables.read_positional(spark, path, schema.DIM_COURIER).collect()]
    assert rows == [(1, "Blue", Decimal("45.50"), 72)]


def test_bad_rows_are_split_off(spark, tmp_path):
    path = write(tmp_path, "c.csv", "courier_id,courier_name,base_rate_rs,sla_hours\n1,A,45,72\nx,B,45,72\n3,,45,72\n")
    good, bad = csv_tables.split_bad_rows(spark, path, schema.DIM_COURIER)
    assert [r.courier_id for r in good.collect()] == [1]
    assert sorted(r.bad_row for r in bad.collect()) == ["3,,45.00,72", "x,B,45,72"]


def test_marketplace_values_are_coerced_and_reviews_deduplicated(spark, tmp_path):
    items = write(
        tmp_path, "items.csv",
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p,s,2017-09-19 09:45:35,58.90,13.29\no2,x,p,s,soon,abc,1.5\n",
    )
    reviews = write(
        tmp_path, "reviews.csv",
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp\n"
        'r1,o1,4,,"two\nlines, ""quoted"" \U0001f600",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r1,o1,2,  ,later,2018-03-10 00:00:00,2018-03-11 03:05:13\n"
        "r2,o2,5,,dated,2018-01-01 00:00:00,\nr2,o3,1,,undated,,\n",
    )
    loaded = csv_tables.load_marketplace(spark, {"items": items, "reviews": reviews})
    rows = [tuple(r)[1:] for r in loaded["items"].orderBy("order_id").collect()]
    assert rows == [
        (1, "p", "s", datetime.datetime(2017, 9, 19, 9, 45, 35), Decimal("58.90"), Decimal("13.29")),
        (None, "p", "s", None, None, Decimal("1.50")),
    ]
    kept = {r.review_id: (r.review_score, r.review_comment_title, r.review_comment_message)
            for r in loaded["reviews"].collect()}
    assert kept == {"r1": (2, None, "later"), "r2": (1, None, "undated")}
    raw = csv_tables.read_coerced(spark, reviews, schema.MARKET_REVIEWS).where("review_score = 4").first()
    assert raw.review_comment_message == 'two\nlines, "quoted" '


def test_violations(spark, orders_of, settlements_of):
    couriers = spark.createDataFrame([(1, "A", Decimal(1), 48), (2, "A", Decimal(1), 48)], schema.DIM_COURIER)
    places = spark.createDataFrame([(1, "X", "Tier-9", "W")], schema.DIM_GEOGRAPHY)
    merchants = spark.createDataFrame([("M-1", "N", "Food")], schema.DIM_MERCHANT)
    orders = orders_of(
        dict(awb_number="A"), dict(awb_number="A", order_id="O2", merchant_id="M-9", order_status="EATEN"),
        dict(awb_number="C", courier_id=7),
    )
    settled = settlements_of(dict(awb_number="A"), dict(awb_number="Z"), dict(awb_number="Z", settlement_id="S0"))
    tables = dict(zip(schema.WAREHOUSE_TABLES, (couriers, places, merchants, orders, settled), strict=True))
    report = {r.check_name: r.violations
              for r in quality.warehouse_violations(tables, schema.WAREHOUSE_TABLES).collect()}
    assert {name: n for name, n in report.items() if n} == {
        "dim_courier.courier_name unique": 1,
        "dim_geography.tier in enum": 1,
        "fact_orders.awb_number unique": 1,
        "fact_orders.order_status in enum": 1,
        "fact_orders.merchant_id in dim_merchant": 1,
        "fact_orders.courier_id in dim_courier": 1,
        "fact_settlements.settlement_id unique": 1,
        "fact_settlements.awb_number in fact_orders": 2,
    }
    assert "fact_orders.actual_eta_hrs not null" not in report


def test_warehouse_folder(spark, tmp_path, orders_of, settlements_of):
    write(tmp_path, "dim_courier.csv", "courier_id,courier_name,base_rate_rs,sla_hours\n1,A,45,72\n")
    write(tmp_path, "dim_geography.csv", "geo_id,city,tier,zone\n1,X,Tier-1,W\n")
    write(tmp_path, "dim_merchant.csv", "merchant_id,merchant_name,category\nM-1,N,Food\n")
    orders_of(dict(awb_number="A", actual_eta_hrs=None)).toPandas().to_csv(tmp_path / "fact_orders.csv", index=False)
    settlements_of(dict(awb_number="A")).toPandas().to_csv(tmp_path / "fact_settlements.csv", index=False)
    tables = csv_tables.load_warehouse(spark, str(tmp_path))
    assert {name: df.count() for name, df in tables.items()} == dict.fromkeys(schema.WAREHOUSE_TABLES, 1)
    assert tables["fact_orders"].first().actual_eta_hrs is None


def test_a_value_of_the_wrong_type_raises(spark, tmp_path):
    path = write(tmp_path, "c.csv", "courier_id,courier_name,base_rate_rs,sla_hours\nx,A,45,72\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv_tables.read_named(spark, path, schema.DIM_COURIER).collect()


def test_files_with_headers_of_their_own(spark, tmp_path):
    folder = tmp_path / "g"
    folder.mkdir()
    write(folder, "a.csv", "geo_id,city,tier,zone\n1,Mumbai,Tier-1,West\n")
    write(folder, "b.csv", "zone,tier,city,geo_id\nEast,Tier-2,Kolkata,2\n")
    rows = sorted(tuple(r) for r in csv_tables.read_named(spark, str(folder), schema.DIM_GEOGRAPHY).collect())
    assert rows == [(1, "Mumbai", "Tier-1", "West"), (2, "Kolkata", "Tier-2", "East")]
    coerced = sorted(tuple(r) for r in csv_tables.read_coerced(spark, str(folder), schema.DIM_GEOGRAPHY).collect())
    assert coerced == rows


def test_headers_cost_no_second_read(spark, tmp_path):
    """First lines are read as such, also of compressed, empty and oddly named files; no job runs for them."""
    folder = tmp_path / "g"
    folder.mkdir()
    write(folder, "a b%20.csv", "geo_id,city,tier,zone\n1,Mumbai,Tier-1,West\n")
    write(folder, "empty.csv", "")
    (folder / "c.csv.gz").write_bytes(gzip.compress(b"zone,tier,city,geo_id\nEast,Tier-2,Kolkata,2\n"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    frames = csv_tables.by_header(spark, str(folder))
    # Each frame looks at the head of one file for its columns.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before <= len(frames) == 2
    rows = sorted(tuple(r) for r in csv_tables.read_named(spark, str(folder), schema.DIM_GEOGRAPHY).collect())
    assert rows == [(1, "Mumbai", "Tier-1", "West"), (2, "Kolkata", "Tier-2", "East")]
