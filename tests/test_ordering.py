import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.functions.numbers import average_rank
from remitlens.operators.ordering import exact_quantiles, global_ntile, grouped_row_number, running_total


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value, and one group holds a third of the rows."""
    rng = random.Random(7)
    rows = [(i, 5 if i % 3 == 0 else rng.randrange(1000), "hot" if i % 3 == 1 else f"g{rng.randrange(50)}")
            for i in range(1501)]
    return rows, spark.createDataFrame(rows, "id int, v int, g string")


def test_running_total(values):
    rows, df = values
    got = {r.id: r.upto for r in running_total(df, [F.col("v").desc(), F.col("id")], F.col("v"), "upto").collect()}
    total, expected = 0, {}
    for i, v, _ in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += v
        expected[i] = total
    assert got == expected


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10, 1501])
def test_ntile_gives_the_first_tiles_one_row_more(values, n):
    rows, df = values
    part = df.where(F.col("id") < n)
    got = {r.id: r.tile for r in global_ntile(part, [F.col("v").desc(), F.col("id")], 4, "tile").collect()}
    ranked = sorted((r for r in rows if r[0] < n), key=lambda r: (-r[1], r[0]))
    expected, start = {}, 0
    for tile in range(4):
        size = n // 4 + (1 if tile < n % 4 else 0)
        expected.update({r[0]: tile + 1 for r in ranked[start:start + size]})
        start += size
    assert got == expected


def test_row_numbers_within_a_group_that_spans_slices(values):
    rows, df = values
    got = {r.id: r.rn for r in grouped_row_number(df, ["g"], [F.col("v"), F.col("id")], "rn").collect()}
    expected, seen = {}, {}
    for i, _, g in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        seen[g] = seen.get(g, 0) + 1
        expected[i] = seen[g]
    assert got == expected


def test_exact_quantiles_interpolate(values):
    rows, df = values
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.987, "e": 1.0}
    with_nulls = df.withColumn("v", F.when(F.col("id") % 10 != 0, F.col("v")))
    got = exact_quantiles(with_nulls, "v", shares).first().asDict()
    kept = [v for i, v, _ in rows if i % 10 != 0]
    assert got == pytest.approx({k: float(np.quantile(kept, q)) for k, q in shares.items()})


def test_tied_ranks_are_averaged_and_cut(spark):
    df = spark.createDataFrame([(x,) for x in (9.0, 7.0, 7.0, 5.0, 5.0, 5.0, 1.0)], "x double")
    assert [r.k for r in df.withColumn("k", average_rank(F.col("x"))).orderBy(F.desc("x")).collect()] == [
        1, 2, 2, 5, 5, 5, 7,
    ]
