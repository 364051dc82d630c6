"""Week, month and festival columns."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# An order date counts as festival when it lies this many days before the load date.
FESTIVAL_DAYS = (30, 37)


def week_start(day: Column, mode: str = "sunday") -> Column:
    """Monday label of a day's week.

    ``sunday``: weeks change on Sunday, so a Sunday belongs to the Monday after it.
    ``iso``: weeks run Monday to Sunday.
    """
    if mode == "sunday":
        return F.trunc(F.date_add(day, 1), "week")
    if mode == "iso":
        return F.trunc(day, "week")
    raise ValueError(f"unknown week mode {mode!r}")


def month_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def month_date(text: Column) -> Column:
    """First day of a ``yyyy-MM`` text."""
    return F.to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd")


def is_festival(day: Column, as_of: datetime.date) -> Column:
    first, last = FESTIVAL_DAYS
    return F.datediff(F.lit(as_of), day).between(first, last)


def fractional_days(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / F.lit(86400.0)
