"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then a full hash.

The first scan keeps length and prefix hash of every text, which are a few bytes each. Lengths that occur once are
done; so are pairs of length and prefix hash that occur once. Only the rest has its whole text hashed, in a second
scan that finds them by a table of marked buckets. That table is bounded by its number of buckets. Where there are
far more documents than buckets, every bucket is marked and every text is hashed: the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.session import written

#: Characters behind the prefix hash, and buckets of (length, prefix hash): the most rows that are broadcast.
PREFIX, BUCKETS = 128, 1 << 20


def squeezed(text: Column) -> Column:
    """Text with each run of white space as one blank; null as empty. Single blanks are left where they are."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _keys(docs: DataFrame, *columns: Column) -> DataFrame:
    plain = docs.select(*columns, squeezed(F.col("text")).alias("plain"))
    return plain.select(
        "*", F.length("plain").alias("length"), F.xxhash64(F.substring("plain", 1, PREFIX)).alias("prefix")
    ).withColumn("bucket", F.pmod(F.xxhash64("length", "prefix"), F.lit(BUCKETS)).cast("int"))


def _marked(docs: DataFrame) -> DataFrame:
    """Buckets of the texts that share length and prefix hash with another one."""
    keys = written(_keys(docs).drop("plain"), "text-keys")
    # Written, so that Spark may split the rows of a length that very many texts have.
    lengths = written(keys.groupBy("length").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("length"), "lengths")
    shared = (
        keys.join(lengths, "length", "left_semi")
        .groupBy("length", "prefix", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return written(shared.select(F.col("bucket").alias("marked")).distinct(), "marked-buckets")


def _hashed(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` with the full hash of the squeezed text, null for texts that are known to be unique."""
    full = F.when(F.col("marked").isNotNull(), F.sha2("plain", 256))
    rows = _keys(docs, *columns).join(F.broadcast(_marked(docs)), F.col("bucket") == F.col("marked"), "left")
    return rows.withColumn("full", full).drop("length", "prefix", "bucket", "marked")


def mark_copies(docs: DataFrame, **more: Column) -> DataFrame:
    """One row per document (columns ``doc_id`` and ``text``) with its group of equal texts.

    Returns ``doc_id``, ``keep_id`` (smallest doc_id of the group; null if none of its rows has one),
    ``group_size``, ``kept`` and the columns ``more``, which may refer to ``plain``, the squeezed text. A null text
    counts as empty, and empty texts equal each other. Rows that repeat the kept doc_id come back as often as they
    are given, and one of them is kept.
    """
    rows = _hashed(docs, F.col("doc_id"))
    hashed = written(rows.select("doc_id", "full", *[c.alias(name) for name, c in more.items()]), "hashed")
    alone = hashed.filter(F.col("full").isNull()).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *more
    )
    shared = hashed.filter(F.col("full").isNotNull())
    # Written, so that the copies of one text may be split over tasks when they are joined with their group.
    groups = written(
        shared.groupBy("full").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    members = (
        shared.groupBy("doc_id", "full", *more).agg(F.count(F.lit(1)).alias("rows")).join(groups, "full")
        .withColumn("number", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("number") == 1))
    )
    return alone.unionByName(members.select("doc_id", "keep_id", "group_size", "kept", *more))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents (any columns) with one row of each group of equal texts, that with the smallest doc_id.

    Of rows that repeat this doc_id, the least by all columns in order stays. Texts that are known to be unique are
    not shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # The whole row travels beside the two columns that the operator reads, whatever its other columns are called.
    rows = _hashed(docs.select(row, F.col("text")), F.col("row")).select("row", "full", F.col("row.doc_id").alias("doc_id"))
    alone = rows.filter(F.col("full").isNull()).select("row.*")
    shared = rows.filter(F.col("full").isNotNull())
    keep = shared.groupBy("full").agg(F.min("doc_id").alias("keep_id"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (shared.full == keep.full)
    least = shared.join(keep, same, "left_semi").groupBy("doc_id", "full").agg(F.min("row").alias("row"))
    return alone.unionAll(least.select("row.*"))
