"""Bags of rows against counters, grouping sets against sets in plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from remitlens.operators import cubes, multisets

SCHEMA = "k string, v int"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def bags(seed):
    rng = random.Random(seed)
    pick = lambda: [(rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for _ in range(rng.randint(0, 25))]
    return pick(), pick()


@pytest.mark.parametrize("seed", range(4))
def test_bags(spark, seed):
    left, right = bags(seed)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    mine, theirs = Counter(left), Counter(right)
    assert bag(multisets.except_all(a, b)) == mine - theirs == bag(a.exceptAll(b))
    assert bag(multisets.intersect_all(a, b)) == mine & theirs == bag(a.intersectAll(b))
    lost, gained = mine - theirs, theirs - mine
    want = Counter()
    for side, name in ((lost, "lost"), (gained, "gained")):
        other = {k for k, _ in (gained if side is lost else lost)}
        for (k, v), n in side.items():
            want[k, v, (f"changed_{'from' if side is lost else 'to'}" if k in other else name), n] += 1
    assert bag(multisets.difference(a, b, ["k"])) == want


def test_repeats_fold_before_the_shuffle(spark):
    rows = spark.range(0, 100_000, 1, 4).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    found = multisets.difference(rows, rows.limit(99_990).unionByName(rows.limit(1)), ["k"])
    assert [tuple(r) for r in found.collect()] == [("hot", 1, "lost", 9)]
    plan = multisets.difference(rows, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def cube_case(seed):
    rng = random.Random(seed)
    return [
        (rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice(["x", "y", None]), rng.choice([1, 2]), rng.choice(["p", "q"]), rng.randint(-5, 5))
        for _ in range(300)
    ]


@pytest.mark.parametrize("sets", [None, [("d", "e"), ("f",), ()]])
def test_grouping_sets(spark, sets):
    rows = cube_case(3)
    dims = ["d", "e", "f"]
    df = spark.createDataFrame(rows, "k string, d string, e int, f string, v int")
    found = cubes.grouped(df, dims, "k", {"total": F.sum("v")}, sets)
    count, keys, total = Counter(), defaultdict(set), Counter()
    for wanted in cubes.all_sets(dims) if sets is None else sets:
        for k, *values, v in rows:
            place = tuple(x if d in wanted else None for d, x in zip(dims, values, strict=True))
            cell = (sum(1 << (2 - i) for i, d in enumerate(dims) if d not in wanted), *place)
            count[cell] += 1
            total[cell] += v
            keys[cell] |= {k} - {None}
    assert {tuple(r)[:4]: tuple(r)[4:] for r in found.collect()} == {c: (count[c], len(keys[c]), total[c]) for c in count}


def test_no_raw_row_is_repeated(spark):
    df = spark.createDataFrame(cube_case(4), "k string, d string, e int, f string, v int")
    plan = cubes.grouped(df, ["d", "e", "f"], "k", {"total": F.sum("v")})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate") == 1
    # Below what is repeated for the sets, rows have been folded.
    assert "HashAggregate" in plan[plan.index("Generate") :] or "ObjectHashAggregate" in plan[plan.index("Generate") :]
    assert cubes.grouped(df.limit(0), ["d"], "k", {}).count() == 0
