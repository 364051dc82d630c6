"""Global orderings without a one-partition window.

Rows are cut into ordered slices by a range shuffle. Each slice works on its own rows and adds what the
slices before it hold; that offset table has one row per slice. The sliced rows are written before they
are read twice, so a lost executor cannot make the sampled slice limits differ between the two reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions.numbers import tile_of
from remitlens.session import written

_SLICE = "_slice"


def _sliced(df: DataFrame, order: list[Column]) -> DataFrame:
    # Without a number, Spark sizes the slices by the volume that arrives.
    return written(df.repartitionByRange(*order).withColumn(_SLICE, F.spark_partition_id()), "sliced")


def running_total(df: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over all rows up to and including this one; ``order`` must be unique."""
    sliced = _sliced(df.withColumn("_amount", amount), order)
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(_SLICE)
        .agg(F.sum("_amount").alias("_total"))
        .select(_SLICE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(_SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.join(F.broadcast(offsets), _SLICE)
        .withColumn(name, F.col("_offset") + F.sum("_amount").over(within))
        .drop(_SLICE, "_amount", "_offset")
    )


def global_ntile(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    """NTILE over the whole frame; ``order`` must be unique."""
    total = df.agg(F.count(F.lit(1))).scalar()
    numbered = running_total(df, order, F.lit(1), "_rn")
    return numbered.withColumn(name, tile_of(F.col("_rn"), total, tiles).cast("long")).drop("_rn")


def grouped_row_number(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """ROW_NUMBER within groups of any size: a group may run over many slices."""
    sliced = _sliced(df, [*[F.col(g) for g in group], *order])
    earlier = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(_SLICE, *group)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    local = F.row_number().over(Window.partitionBy(_SLICE, *group).orderBy(*order))
    return (
        sliced.withColumn("_local", local)
        .join(offsets, [_SLICE, *group])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop(_SLICE, "_local", "_offset")
    )


def exact_quantiles(df: DataFrame, value: str, shares: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """One row with the linearly interpolated quantiles of a numeric column, named by ``shares``' keys.

    Approximate quantiles a little to either side, whose error in ranks is bounded by ``accuracy``, enclose each exact one.
    Rows below the band are counted and only the band, a few parts in ``accuracy`` of the rows, is sorted; equal values
    fold into one row first, so a repeated value does not end up in one task. ``df`` is read for the bounds and for each
    share.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    names, total = list(shares), rows.count()
    if not total:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(name) for name in names])
    # The bound on the ranks' error, and two ranks for rounding.
    margin = 2.0 / accuracy + 2.0 / total
    ends = [min(max(shares[n] + side, 0.0), 1.0) for n in names for side in (-margin, margin)]
    found = rows.agg(F.percentile_approx("v", F.array(*map(F.lit, ends)), accuracy).alias("ends")).first()["ends"]
    result = None
    for i, name in enumerate(names):
        low, high = found[2 * i], found[2 * i + 1]
        place = shares[name] * (total - 1)
        below = rows.where(F.col("v") < low).agg(F.count(F.lit(1))).scalar()
        band = rows.where(F.col("v").between(low, high)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        upto = running_total(band, [F.col("v")], F.col("n"), "upto").withColumn("upto", F.col("upto") + below)

        def at(index: int) -> Column:
            return F.max(F.when((F.col("upto") > index) & (F.col("upto") - F.col("n") <= index), F.col("v")))

        lower, upper = int(place), min(int(place) + 1, total - 1)
        one = upto.agg(at(lower).alias("a"), at(upper).alias("b")).select(
            (F.col("a") + (F.col("b") - F.col("a")) * F.lit(place - lower)).alias(name)
        )
        result = one if result is None else result.withColumn(name, one.scalar())
    return result
