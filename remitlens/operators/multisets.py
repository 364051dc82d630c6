"""Tables as bags of rows: what one has that another lacks, repeats counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counted(before: DataFrame, after: DataFrame) -> DataFrame:
    """Each distinct row of either with its times in both; nulls are equal. Rows fold before they are shuffled."""
    mark = lambda df, b, a: df.select(*after.columns, F.lit(b).alias("_before"), F.lit(a).alias("_after"))
    both = mark(before, 1, 0).unionByName(mark(after, 0, 1))
    return both.groupBy(*after.columns).agg(F.sum("_before").alias("_before"), F.sum("_after").alias("_after"))


def _times(rows: DataFrame, times: Column) -> DataFrame:
    """Each row so many times."""
    wanted = [c for c in rows.columns if c not in ("_before", "_after")]
    return rows.where(times > 0).select(*wanted, F.explode(F.sequence(F.lit(1), times)).alias("_n")).select(*wanted)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` beyond those of ``right``."""
    return _times(_counted(right, left), F.col("_after") - F.col("_before"))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, as often as the one that has them less often."""
    return _times(_counted(right, left), F.least("_after", "_before"))


def difference(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What changed from one table to the other: each row that has become more or fewer, with ``change`` and ``times``.

    ``change`` is ``lost`` or ``gained``; where rows of the same keys did both, it is ``changed_from`` and ``changed_to``.
    ``times`` is by how many repeats the row differs. Rows that are in both as often are not listed.
    """
    counted = _counted(before, after)
    more = F.col("_after") - F.col("_before")
    apart = counted.withColumn("times", F.abs(more)).withColumn("_gained", more > 0).where(F.col("times") > 0).drop("_before", "_after")
    # Distinct rows of one key: how many there are does not depend on repeats. Keys are compared so that nulls are equal.
    sides = apart.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg((F.min("_gained") != F.max("_gained")).alias("_both"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    kind = F.when(F.col("_both"), F.when(F.col("_gained"), "changed_to").otherwise("changed_from")).otherwise(
        F.when(F.col("_gained"), "gained").otherwise("lost")
    )
    return apart.join(sides, same).select(*after.columns, kind.alias("change"), "times")
