"""Joins on time: the latest earlier row, and the ranges that a moment lies in. Both are equi-joins to Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.operators.skew import SHARE, heavy_buckets, repeat_rows, spread_rows
from remitlens.settings import SKEW, SkewSettings


def _days(moment: Column) -> Column:
    """Days since 1970 of a date or timestamp."""
    return F.unix_date(moment.cast("date")).cast("long")


def _others(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in df.columns if c not in names]


def _skewed_join(left: DataFrame, right: DataFrame, keys: list[str], skew: SkewSettings, how: str,
                 hint: str | None = None) -> DataFrame:
    """Join a side whose keys may be heavy with one that has few rows per key; equal left rows count as one for spreading.

    ``hint`` names the kind of join, where Spark's own estimate of the right side would mislead it.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = heavy_buckets(counts, keys, "_rows", skew)
    by = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    spread, repeated = spread_rows(left, heavy, keys, by, skew), repeat_rows(right, heavy, keys, skew)
    if hint is not None:
        repeated = repeated.hint(hint)
    return spread.join(repeated, [*keys, SHARE], how).drop(SHARE)


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, slice_days: int = 90,
               skew: SkewSettings = SKEW) -> DataFrame:
    """Each left row with the right row of its keys whose time is the latest not after its own; null columns if none.

    Both sides fold by keys and time first: equal moments have one answer, however many rows ask. The times of a key are
    cut into slices of some days, each sorted by itself, and a slice without an answer takes the last one of the slices
    before, so a key that holds most rows is no single task's. The rows that ask then meet their answers by a join that
    spreads heavy keys.

    Of right rows with equal keys and time the greatest counts, by its columns in the order of their names. A left row
    with a null key or time has no answer, and a right row with one is none. Left rows keep their number. Columns of both
    sides must have different names, but for the keys.
    """
    values = sorted(_others(right, keys))
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    answer = F.struct(*[F.col(f"`{c}`") for c in values])
    named = lambda df, time: df.where(F.col(time).isNotNull() & F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    asked = named(left, left_time).select(*keys, F.col(left_time).alias("_time")).distinct()
    known = named(right, right_time).groupBy(*keys, F.col(right_time).alias("_time")).agg(F.max(answer).alias("_answer"))
    both = asked.withColumns({"_asks": F.lit(1), "_answer": F.lit(None).cast(known.schema["_answer"].dataType)}).unionByName(
        known.withColumn("_asks", F.lit(0))
    )
    both = both.groupBy(*keys, "_time").agg(F.max("_asks").alias("_asks"), F.max("_answer").alias("_answer"))
    both = both.withColumn("_slice", F.floor(_days(F.col("_time")) / slice_days))
    upto = Window.partitionBy(*keys, "_slice").orderBy("_time").rowsBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("_own", F.last("_answer", ignorenulls=True).over(upto))
    # A row per key and slice: the last answer of the slices before.
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(*keys, "_slice")
        .agg(F.max_by("_answer", F.when(F.col("_answer").isNotNull(), F.col("_time"))).alias("_last"))
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
        .drop("_last")
    )
    answers = own.where("_asks = 1").join(carried, [*keys, "_slice"]).select(
        *keys, F.col("_time").alias(left_time), F.coalesce("_own", "_carried").alias("_answer")
    )
    joined = _skewed_join(left, answers.where(F.col("_answer").isNotNull()), [*keys, left_time], skew, "left")
    return joined.select(*left.columns, *[F.col(f"_answer.`{c}`").alias(c) for c in values])


def interval_join(points: DataFrame, ranges: DataFrame, keys: list[str], time: str, start: str, end: str,
                  step_days: int = 1, fan: int = 16, skew: SkewSettings = SKEW) -> DataFrame:
    """Each pair of a point and a range of its keys (none: all ranges) that holds the point's time, both ends included.

    Days fall into bins of ``step_days``, and of ``fan`` times, ``fan`` squared times and so on that many. A range goes to
    the smallest bins of which it touches no more than ``fan`` + 1, so a long range is not repeated for each of its days; a
    point is repeated once per size of bins that ranges use, of which there are few. Points and ranges meet by keys, size
    and bin, and the ends are checked after.

    Ranges with a null end, or that end before they start, hold nothing; points with a null time or key lie in none. All
    columns of both sides come back, so these must have different names, but for the keys.
    """
    if clash := set(_others(ranges, keys)) & set(points.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    level, bins = "_level", "_bin"
    first, last = _days(F.col(start)), _days(F.col(end))
    spans = F.floor((last - first) / step_days)
    # The least level of which the range spans no more than ``fan`` bins.
    levels, n = F.when(spans < fan, 0), 1
    while fan**n < 1 << 32:  # more days than a date can be away from another
        levels, n = levels.when(spans < fan ** (n + 1), n), n + 1
    width = lambda n: F.lit(step_days).cast("long") * F.pow(F.lit(fan), n).cast("long")
    held = ranges.where(F.col(start) <= F.col(end)).withColumn(level, levels.cast("int"))
    # As many numbers as there are levels.
    used = sorted(r[0] for r in held.select(level).distinct().collect())
    bin_of = lambda day: F.floor(day / width(F.col(level)))
    held = held.withColumn(bins, F.explode(F.sequence(bin_of(first), bin_of(last))))
    asked = points.where(F.col(time).isNotNull()).withColumn(level, F.explode(F.array(*map(F.lit, used)).cast("array<int>")))
    asked = asked.withColumn(bins, bin_of(_days(F.col(time))))
    # Spark sizes ranges by their rows before they are repeated by bin, and would broadcast what fits no driver.
    joined = _skewed_join(asked, held, [*keys, level, bins], skew, "inner", "merge")
    inside = F.col(time).between(F.col(start), F.col(end))
    return joined.where(inside).select(*points.columns, *_others(ranges, keys))
