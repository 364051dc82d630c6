"""Tables that are derived once: what moves while they are built, and how they are written."""

from pyspark.sql import functions as F

from remitlens.session import names_in, new_folder
from remitlens.sources.benchmark_tables import BenchmarkTables
from remitlens.sources.store import WRITERS, read_table, write_in_place
from tests.conftest import SMALL


def test_lines_are_gathered_before_they_are_folded(spark):
    """Lines of an order lie apart, so folding them first would hold as many rows as there are lines."""
    tables = BenchmarkTables(spark, SMALL)
    lines = tables.settlements(tables.orders())._jdf.queryExecution().executedPlan().toString()
    below = lines[lines.index("partial_count(1)") :]
    assert "REPARTITION_BY_COL" in below and "l_linestatus" in below[below.index("REPARTITION_BY_COL") :]


def test_a_table_is_written_where_its_rows_are(spark):
    """No rows move for it, and more values than a task writes at once are no matter."""
    rows = spark.range(0, 1000, 1, 3).select("id", F.concat(F.lit("b"), F.col("id") % (2 * WRITERS)).alias("batch"))
    path, before = new_folder(spark, "in-place"), spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    for _ in range(2):
        write_in_place(rows, path, "batch")
    found = read_table(spark, path, rows.schema)
    assert found.columns == ["id", "batch"] and sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
    assert len([name for name in names_in(spark, f"{path}/batch=b1") if name.endswith(".parquet")]) == 3
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
