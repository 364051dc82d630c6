import pytest
from pyspark.sql import functions as F

from remitlens.operators.marks import may_meet
from remitlens.session import names_in, new_folder
from remitlens.streaming import jobs


@pytest.mark.parametrize("words", [1, 1 << 10])
def test_rows_that_meet_pass_and_most_others_drop_out(spark, words):
    text = F.concat(F.lit("A"), F.col("id").cast("string")).alias("awb")
    rows = spark.range(20_000).select(text, "id").unionByName(spark.createDataFrame([(None, -1)], "awb string, id long"))
    others = spark.range(0, 20_000, 20).select(text).unionByName(spark.createDataFrame([(None,), ("A0",)], "awb string"))
    passed = may_meet(rows, others, ["awb"], words)
    assert passed.columns == ["awb", "id"] and passed.count() == passed.distinct().count()
    assert passed.join(others.distinct(), "awb", "left_semi").count() == 1000
    assert (passed.count() < 3000) == (words > 1)
    assert may_meet(rows, others.limit(0), ["awb"], words).count() == 0


def test_a_stored_table_does_not_move_for_a_micro_batch(spark, orders_of, settlements_of):
    """Stored rows without a partner stay where they are: they drop out before the shuffle."""
    from remitlens.streaming.settlement_feed import _of_awbs

    stored = orders_of(*[dict(awb_number=f"A{i}") for i in range(3)])
    plan = _of_awbs(stored, settlements_of(dict(awb_number="A1")))
    assert "getbit" in plan._jdf.queryExecution().executedPlan().toString() and [r.awb_number for r in plan.collect()] == ["A1"]


def test_more_rows_make_more_files_and_not_larger_ones(spark):
    rows = spark.range(1000)
    for most, each in ((1000, 1), (50, 5)):
        path = new_folder(spark, "cut")
        assert jobs.cut_into_files(rows, path, 4, F.xxhash64("id"), most) == each
        assert len([n for n in names_in(spark, path) if n.endswith(".parquet")]) == 4 * each
        seen = []
        stream = jobs.table_stream(spark, path, rows.schema, files_per_trigger=each)
        jobs.each_batch(stream, lambda batch, epoch, seen=seen: seen.append(batch.count()), f"{path}-progress")
        assert len(seen) == 4 and sum(seen) == 1000
