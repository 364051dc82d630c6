"""Copies per AWB, kept by AWB and batch, so that one batch's run counts no other batch's settlements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.sources.store import TableStore

#: Hash buckets of the AWB by which the counts are stored.
BUCKETS = 64
_COPIES, _KEYS = "copies", ["awb_number", "batch_id"]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("awb_number"), F.lit(buckets))


def counted(settlements: DataFrame) -> DataFrame:
    """Copies by AWB and batch; settlements without an AWB are no copies."""
    return settlements.where(F.col("awb_number").isNotNull()).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("copies"))


def _by_awb(counts: DataFrame) -> DataFrame:
    return counts.groupBy("awb_number").agg(F.sum("copies").alias("copies"))


def store_copies(store: TableStore, settlements: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Count all settlements anew; returns copies per AWB."""
    store.write(_COPIES, counted(settlements), _bucket(buckets))
    return _by_awb(store.read(_COPIES))


def refresh_copies(store: TableStore, settlements: DataFrame, batch_id: str, buckets: int = BUCKETS) -> DataFrame:
    """Count one batch anew and change the stored counts where they differ; returns copies per AWB of its buckets.

    Read are the batch's settlements, the AWBs that its stored outcomes had, and the stored counts of the buckets that these
    AWBs fall into. Buckets in which nothing changed are not written. One write changes all that has to, and from the same
    settlements it changes nothing again, so a run that failed may be repeated.
    """
    now = counted(settlements.where(F.col("batch_id") == batch_id))
    had = store.read("outcomes", batch_id).where(F.col("awb_number").isNotNull()).select("awb_number")
    bucket = _bucket(buckets).alias("bucket")
    # At most as many numbers as there are buckets.
    touched = [r["bucket"] for r in now.select(bucket).union(had.select(bucket)).distinct().collect()]
    if not touched:
        return _by_awb(store.read(_COPIES).limit(0))
    stored = store.read(_COPIES, *touched)
    of_batch = F.col("batch_id") == batch_id
    difference = now.unionByName(stored.where(of_batch).withColumn("copies", -F.col("copies"))).groupBy(*_KEYS).agg(
        F.sum("copies").alias("copies")
    )
    changed = [r["bucket"] for r in difference.where("copies <> 0").select(bucket).distinct().collect()]
    if changed:
        inside = _bucket(buckets).isin(*changed)
        kept = store.read(_COPIES, *changed).where(~of_batch)
        store.replace(_COPIES, kept.unionByName(now.where(inside)), _bucket(buckets), changed)
    return _by_awb(store.read(_COPIES, *touched))
