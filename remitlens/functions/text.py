"""Text clean-up at the load edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def basic_plane_only(text: Column) -> Column:
    """Drop characters beyond U+FFFF; text that is blank, or empty afterwards, becomes null."""
    kept = F.regexp_replace(blank_to_null(text), r"[\x{10000}-\x{10FFFF}]", "")
    return F.when(kept != "", kept)
