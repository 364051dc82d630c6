"""Ratios, shares and ranks."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double; null where the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero; binary noise beyond nine digits cannot turn a tie."""
    return F.round(F.round(value, 9), digits)


def half_even(value: Column, digits: int) -> Column:
    """Round a double with ties to the even digit, as array libraries do."""
    return F.bround(F.round(value, 9), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return half_up(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def average_rank(value: Column) -> Column:
    """Descending rank where ties share their mean rank, cut to an integer. For small aggregates only."""
    down = Window.orderBy(value.desc())
    ties = F.count(F.lit(1)).over(Window.partitionBy(value))
    return F.floor(F.rank().over(down) + (ties - 1) / F.lit(2.0)).cast("long")


def tile_of(row_number: Column, total: Column, tiles: int) -> Column:
    """NTILE number of a row from its row number: the first ``total % tiles`` tiles get one row more."""
    small = F.floor(total / F.lit(tiles))
    longer = total % F.lit(tiles)
    in_longer = longer * (small + 1)
    return F.when(row_number <= in_longer, F.ceil(row_number / (small + 1))).otherwise(
        longer + F.ceil((row_number - in_longer) / F.nullif(small, F.lit(0)))
    )
