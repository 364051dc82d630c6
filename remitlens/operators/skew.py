"""Joins whose key may be held by a large share of all rows.

Keys fall into hash buckets, and a bucket that holds a heavy key is marked with the number of shares that this key needs.
Rows of a marked bucket are spread over numbered shares on the repeating side, and the partner rows are repeated once per
share. Light keys of a marked bucket are spread and repeated too, which costs a little and changes nothing. Every other
key has share 0, so the join stays one equi-join. The list of marks has one row per bucket at most, however many keys are
heavy, so none is left out and the list can be sent whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.settings import SKEW, SkewSettings

SHARE = "_share"
_BUCKET, _SHARES = "_bucket", "_shares"


def _bucket(keys: list[str], skew: SkewSettings) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(skew.buckets)).cast("int")


def heavy_buckets(counts: DataFrame, keys: list[str], rows: str, skew: SkewSettings = SKEW) -> DataFrame:
    """The buckets that hold a heavy key, with the number of shares that the heaviest of each needs."""
    return (
        counts.where(F.col(rows) >= skew.heavy_rows)
        .groupBy(_bucket(keys, skew).alias(_BUCKET))
        .agg(F.ceil(F.max(rows) / skew.rows_per_share).cast("int").alias(_SHARES))
    )


def spread_rows(df: DataFrame, heavy: DataFrame, keys: list[str], by: Column, skew: SkewSettings = SKEW) -> DataFrame:
    """Number the rows of heavy keys by a hash of ``by``, a column that tells rows of one key apart."""
    share = F.when(F.col(_SHARES).isNull(), 0).otherwise(F.pmod(F.xxhash64(by), F.col(_SHARES)))
    marked = df.withColumn(_BUCKET, _bucket(keys, skew)).join(F.broadcast(heavy), _BUCKET, "left")
    return marked.withColumn(SHARE, share.cast("int")).drop(_SHARES, _BUCKET)


def repeat_rows(df: DataFrame, heavy: DataFrame, keys: list[str], skew: SkewSettings = SKEW) -> DataFrame:
    """Repeat the row of a heavy key once per share."""
    shares = F.sequence(F.lit(0), F.coalesce(_SHARES, F.lit(1)) - 1)
    marked = df.withColumn(_BUCKET, _bucket(keys, skew)).join(F.broadcast(heavy), _BUCKET, "left")
    return marked.withColumn(SHARE, F.explode(shares)).drop(_SHARES, _BUCKET)
