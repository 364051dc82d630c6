"""Set-based changes to stored tables, as new frames or partition replacements."""

from __future__ import annotations

from pyspark.sql import DataFrame


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Update matched, insert missing, never delete."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keep every old row; add the new rows whose key is not there yet."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))
