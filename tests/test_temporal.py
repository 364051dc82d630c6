"""Joins on time against plain Python, with one key that holds most rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from remitlens.operators.temporal import as_of_join, interval_join
from remitlens.plans import periods
from remitlens.settings import SkewSettings

EAGER = SkewSettings(heavy_rows=20, rows_per_share=7, buckets=4)
DAY0 = datetime.date(1969, 6, 1)


def date(n):
    return None if n is None else DAY0 + datetime.timedelta(days=n)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def asof_case(seed):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
    left = [(i, key(), rng.choice([rng.randint(0, 900), 400, None])) for i in range(400)]
    right = [(key(), rng.choice([rng.randint(100, 900), None]), rng.randint(0, 9), rng.choice(["x", None])) for _ in range(60)]
    return left, right


def plain_asof(left, right):
    found = []
    for i, key, at in left:
        fits = [r for r in right if key is not None and at is not None and r[0] == key and r[1] is not None and r[1] <= at]
        last = max((r[1] for r in fits), default=None)
        # The greatest by the columns' names, null lowest: ``rate``, ``since``, ``word``.
        best = max((r for r in fits if r[1] == last), key=lambda r: (r[2], r[1], r[3] is not None, r[3] or ""), default=None)
        found.append((i, key, date(at), *((best[2], date(best[1]), best[3]) if best else (None, None, None))))
    return sorted(found, key=str)


@pytest.mark.parametrize("seed, slice_days", [(1, 90), (2, 7), (3, 5000)])
def test_as_of_join(spark, seed, slice_days):
    left, right = asof_case(seed)
    asks = spark.createDataFrame([(i, k, date(d)) for i, k, d in left], "i int, k string, at date")
    answers = spark.createDataFrame([(k, date(d), r, w) for k, d, r, w in right], "k string, since date, rate int, word string")
    found = as_of_join(asks, answers, ["k"], "at", "since", slice_days, EAGER)
    assert found.columns == ["i", "k", "at", "rate", "since", "word"]
    assert rows_of(found) == plain_asof(left, right)


def test_as_of_join_of_moments_and_of_none(spark):
    at = datetime.datetime(2026, 1, 1)
    asks = spark.createDataFrame([(1, "k", at), (2, "k", at + datetime.timedelta(microseconds=1)), (1, "k", at)], "i int, k string, at timestamp")
    answers = spark.createDataFrame([("k", at + datetime.timedelta(microseconds=1), 5)], "k string, since timestamp, rate int")
    assert [(r.i, r.rate) for r in as_of_join(asks, answers, ["k"], "at", "since").orderBy("i").collect()] == [(1, None), (1, None), (2, 5)]
    assert as_of_join(asks, answers.limit(0), ["k"], "at", "since").where("rate is null").count() == 3
    assert as_of_join(asks.limit(0), answers, ["k"], "at", "since").count() == 0
    with pytest.raises(ValueError, match="rate"):
        as_of_join(asks.withColumn("rate", F.lit(1)), answers, ["k"], "at", "since")


def test_a_hot_key_is_cut_into_slices(spark):
    """No task sorts the whole of one key, and the rows that ask are spread."""
    asks = spark.range(5000).select(F.lit("hot").alias("k"), F.date_add(F.lit(DAY0), (F.col("id") % 2000).cast("int")).alias("at"), "id")
    answers = spark.range(300).select(F.lit("hot").alias("k"), F.date_add(F.lit(DAY0), (F.col("id") * 7).cast("int")).alias("since"), F.col("id").alias("rate"))
    found = as_of_join(asks, answers, ["k"], "at", "since", 30, EAGER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "_slice#" in plan.split("Window")[1] and "_share#" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.where("rate <> floor((id % 2000) / 7) and (id % 2000) / 7 < 300").count() == 0
    assert found.where("rate is null").count() == 0


def interval_case(seed):
    rng = random.Random(seed)
    points = [(i, rng.choice(["hot"] * 5 + ["a", None]), rng.choice([rng.randint(-50, 6000), 300, None])) for i in range(300)]
    ranges = []
    for n in range(60):
        start = rng.choice([rng.randint(-100, 6000), None])
        length = rng.choice([0, 1, 15, 16, 17, 255, 256, 257, 5000, -3])
        ranges.append((n, rng.choice(["hot", "a", None]), start, None if start is None or rng.random() < 0.05 else start + length))
    return points, ranges


@pytest.mark.parametrize("seed, step, fan", [(1, 1, 16), (2, 7, 2), (3, 1, 4)])
def test_interval_join(spark, seed, step, fan):
    points, ranges = interval_case(seed)
    p = spark.createDataFrame([(i, k, date(d)) for i, k, d in points], "i int, k string, at date")
    r = spark.createDataFrame([(n, k, date(a), date(b)) for n, k, a, b in ranges], "n int, k string, a date, b date")
    for keys in (["k"], []):
        r_own = r if keys else r.withColumnRenamed("k", "rk")
        found = interval_join(p, r_own, keys, "at", "a", "b", step, fan, EAGER).select("i", "n")
        want = [
            (i, n) for i, k, d in points for n, rk, a, b in ranges
            if None not in (d, a, b) and a <= d <= b and (not keys or (k is not None and k == rk))
        ]
        assert rows_of(found) == sorted(want, key=str)


def test_long_ranges_are_not_repeated_without_bound(spark):
    points = spark.range(50).select(F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("at"))
    ranges = spark.range(20).select(F.lit(DAY0).alias("a"), F.date_add(F.lit(DAY0), F.pow(F.lit(2), F.col("id") % 17).cast("int")).alias("b"))
    found = interval_join(points, ranges, [], "at", "a", "b")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and found.count() == sum(min(2 ** (i % 17), 49) + 1 for i in range(20))
    executed = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in executed and "Cartesian" not in executed
    # 65536 days are 17 bins of 4096 at most.
    spans = [2 ** (i % 17) for i in range(20)]
    for days in spans:
        level = next(n for n in range(16) if days < 16 ** (n + 1))
        assert days // 16**level + 2 <= 17
    assert interval_join(points.limit(0), ranges, [], "at", "a", "b").count() == 0
    assert interval_join(points, ranges.limit(0), [], "at", "a", "b").count() == 0


def test_a_trailing_frame_is_of_days_and_not_of_rows(spark):
    days = {0: 5, 1: 7, 6: 1, 7: 2, 30: 4}
    rows = [(1, date(d), n, float(n)) for d, n in days.items()] + [(2, date(3), 9, 9.0), (1, None, 100, 100.0)]
    found = periods.trailing_leakage(spark.createDataFrame(rows, "courier_id int, settlement_date date, dispute_count int, leakage_rs double"))
    got = {r.day: (r.trailing_disputes, r.worst_day_rs) for r in found.where("courier_id = 1").collect()}
    assert got == {date(0): (5, 5.0), date(1): (12, 7.0), date(6): (13, 7.0), date(7): (10, 7.0), date(30): (4, 4.0)}
    assert found.where("courier_id = 2").first().trailing_disputes == 9


def test_a_month_on_either_side_alone(spark, orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A", order_date=datetime.date(2026, 1, 5), cod_amount=10))
    settled = settlements_of(dict(awb_number="A", settlement_date=datetime.date(2026, 2, 5), settled_cod=4))
    got = sorted((r.month, r.booked_rs, r.settled_rs, int(r.open_rs)) for r in periods.booked_and_settled(orders, settled).collect())
    assert [(m, b and int(b), s and int(s), o) for m, b, s, o in got] == [("2026-01", 10, None, 10), ("2026-02", None, 4, -4)]


def test_ranges_repeated_by_bin_are_not_broadcast(spark):
    """Few rows, but each repeated by bin: Spark's estimate knows nothing of the repeats."""
    points = spark.range(50).select("id", F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("at"))
    ranges = spark.range(20).select("id", F.lit(DAY0).alias("a"), F.date_add(F.lit(DAY0), 13).alias("b"))
    found = interval_join(points, ranges, ["id"], "at", "a", "b")
    assert "Join Inner, " in found._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin [id" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 14


def test_overdue_intervals_lie_in_two_bins_at_most(spark, orders_of, settlements_of):
    orders = orders_of(*[dict(awb_number=f"A{i}", order_date=date(i)) for i in range(30)])
    settled = settlements_of(*[dict(awb_number=f"A{i}", settlement_date=date(i + n)) for i in range(30) for n in (14, 15, 28, 29)])
    found = periods.overdue_settlements(settled, orders)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(FLOOR((cast(unix_date(" in plan and "14" in plan
    assert sorted((r.awb_number, (r.settlement_date - r.overdue_from).days) for r in found.collect()) == sorted(
        (f"A{i}", n) for i in range(30) for n in (0, 13)
    )
