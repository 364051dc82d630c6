import datetime

from pyspark.sql import functions as F

from remitlens.functions import calendar, text
from remitlens.plans.warehouse import derive_dates, extend_dates
from tests.conftest import day


def test_weeks(spark):
    # Sunday 13 and Monday 14 September 2026.
    df = spark.createDataFrame([(day(5),), (day(6),), (day(7),)], "d date")
    sunday = df.select(calendar.week_start(F.col("d"))).collect()
    iso = df.select(calendar.week_start(F.col("d"), "iso")).collect()
    assert [r[0] for r in sunday] == [day(0), day(7), day(7)]
    assert [r[0] for r in iso] == [day(0), day(0), day(7)]


def test_calendar_flags_and_keeps_old_days(orders_of):
    as_of = day(40)
    orders = orders_of(*[dict(awb_number=f"A{n}", order_date=day(n)) for n in (2, 3, 10, 11)])
    dates = derive_dates(orders, as_of)
    assert {r.date_id: r.is_festival for r in dates.collect()} == {
        day(2): False, day(3): True, day(10): True, day(11): False,
    }
    assert {(r.week_id, r.month_id) for r in dates.where(F.col("date_id") == day(2)).collect()} == {
        ("2026-09-07", "2026-09")
    }
    later = orders_of(dict(awb_number="A", order_date=day(3)), dict(awb_number="B", order_date=day(50)))
    grown = {r.date_id: r.is_festival for r in extend_dates(dates, later, day(80)).collect()}
    assert grown[day(3)] and grown[day(50)] and len(grown) == 5


def test_month_text_and_fractions(spark):
    df = spark.sql("select '2017-03' ym, timestamp_ntz'2020-01-01 00:00:00' a, timestamp_ntz'2020-01-02 12:00:00' b")
    row = df.select(
        calendar.month_date(F.col("ym")), calendar.fractional_days(F.col("a"), F.col("b")), calendar.month_id(F.col("a"))
    ).first()
    assert tuple(row) == (datetime.date(2017, 3, 1), 1.5, "2020-01")


def test_text_clean_up(spark):
    df = spark.createDataFrame([("ok",), ("  ",), ("a\U0001f600b",), ("\U0001f600",), (None,)], "t string")
    assert [r[0] for r in df.select(text.basic_plane_only(F.col("t"))).collect()] == ["ok", None, "ab", None, None]
