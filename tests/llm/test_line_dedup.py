"""Line dedup against plain Python, and its query against its SQL twin."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from remitlens.llm import line_dedup, queries
from remitlens.session import names_in, new_folder, written
from tests.compare import differences, given_tables
from tests.llm.samples import SPACES, texts


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def expected(rows):
    owners = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            owners[key(line)].add(i)
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in owners.items()}
    found = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(owners[key(x)]) < 2 or least[key(x)] == i]
        found.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(found, key=str)


def rows():
    shared = [f"Shared line number {n} é" for n in range(12)] + ["short", "  Shared LINE number 3 é\t", "123456789", "1234567890", "ééééééééé", "éééééééééé"]
    found = list(enumerate(texts(20)))
    for i in range(100, 190):
        found.append((i, "\n".join(shared[(i * k) % len(shared)] for k in range(1, 5)) + f"\nown {i} line of its own"))
    return found + [found[-1], (None, shared[0] + "\nonly without an id"), (None, "only without an id")]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (7, 2), (4, 3)])
def test_lines(spark, batches, fanout):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    got = line_dedup.dedup_lines(docs, batches, fanout).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows())


def test_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "key line one two", 5, b"x"), (2, "KEY line one two", 6, b"y")], "doc_id long, text string, n_lines int, keys binary")
    got = sorted(map(tuple, line_dedup.dedup_lines(docs).collect()))
    assert got == [(1, "key line one two", 1, b"x", 0), (2, "", 1, b"y", 1)]
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def pairs_of(spark, n, *keys):
    return written(spark.createDataFrame([(n, 0, k) for k in keys], line_dedup.PAIRS), "pairs")


def test_runs_are_merged_by_levels(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=4)
    for n in range(7):
        gone = [r.key for r in runs.add(pairs_of(spark, n, b"all", b"own%d" % n)).collect()]
        assert gone == ([bytearray(b"all")] if n else [])
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert [(r.first, r.last) for r in runs.runs] == [(0, 3), (4, 5), (6, 6)]
    # What was merged is gone.
    assert len(names_in(spark, runs.path)) == 3


def test_a_later_job_adds_its_batch(spark):
    """Another session opens the folder: it knows none of the tables."""
    first = spark.createDataFrame([(5, "a line that comes early\nanother one of the first")], "doc_id long, text string")
    path = new_folder(spark, "line-runs")
    line_dedup.dedup_lines(first, 2, 2, runs=line_dedup.LineRuns(spark, path, 2, 4)).collect()
    for row in spark.sql("show tables like 'line_run_*'").collect():
        spark.sql(f"drop table {row.tableName}")
    session = spark.newSession()
    later = session.createDataFrame([(1, "A line that comes early\nand a new one of its own"), (2, "and a new one of its own")], "doc_id long, text string")
    runs = line_dedup.LineRuns(session, path, 2, 4)
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.dedup_lines(later, 1, 2, runs=runs).collect()}
    # Earlier jobs' documents come first, whatever their ids.
    assert got == {1: ("and a new one of its own", 1), 2: ("", 1)}
    assert runs.runs[-1].last == 2


def test_a_run_that_was_not_ended_is_written_again(spark):
    runs = line_dedup.LineRuns(spark, fanout=9, buckets=4)
    runs.add(pairs_of(spark, 1, b"k1"))
    broken = pairs_of(spark, 2, b"k1", b"k2").withColumn("key", F.when(F.col("key") == b"k2", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("key")))
    with pytest.raises(Exception, match="lost"):
        runs.add(broken)
    assert [r.last for r in runs.runs] == [0]
    assert [r.key for r in runs.add(pairs_of(spark, 2, b"k1", b"k2")).collect()] == [bytearray(b"k1")]
    assert [r.last for r in runs.runs] == [0, 1]


def test_runs_are_read_in_their_order(spark):
    """A batch is shuffled and sorted, the runs that it meets are not."""
    runs = line_dedup.LineRuns(spark, fanout=9, buckets=16)
    for n in range(3):
        runs.add(pairs_of(spark, n, *[b"key%d" % (k * n) for k in range(50)]))
    files = [path for run in runs.runs for path in runs.read(run).inputFiles()]
    assert len(files) <= 3 * 16
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with line_dedup._in_order(spark):
            plan = runs.new_lines(pairs_of(spark, 9, b"key1"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("SortMergeJoin") == 3 and plan.count("Bucketed: true") == 3
    # One sort and the shuffles of the batch: by its own fold, and into the buckets.
    assert plan.count("Sort [") == 1 and plan.count("Exchange") <= 2


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    df = queries.op10_line_dedup(spark, folder)
    assert differences(df, given_tables(folder), queries.oracle_sql()["op10_line_dedup"]) is None
