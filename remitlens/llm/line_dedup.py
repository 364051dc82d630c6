"""Lines that an earlier document holds, by levelled runs of line hashes.

Documents come in batches. A run holds the hashes of lines that were new in its batch, each with the document that owns the
line, as a table of buckets that are sorted by hash. A batch is dealt into the same buckets and merge-anti-joined with the
runs bucket by bucket, so runs are read in their order, neither shuffled nor sorted again. What none of them holds is new,
belongs to the batch's smallest document with the line, and becomes a run of level 0. Once a level has ``fanout`` runs they
are compacted into one of the next, so a batch meets a number of runs that grows with the logarithm of the batches.

Runs lie in a folder and are named by their batches, so a later job can open the folder and add its batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import LOWER, texts
from remitlens.session import names_in, new_folder, remove_folder, written

SPACES = b" \t\n\x0b\x0c\r"
#: Code points of the shortest line that counts.
LEAST = 10
PAIRS = "doc_id long, part long, key binary"


def line_hash(line: bytes, least: int = LEAST) -> bytes | None:
    """128 bits of a line stripped of white space at both ends and with A-Z lower-cased; None if it is too short."""
    key = line.strip(SPACES).translate(LOWER)
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Distinct line hashes of each row: ``doc_id``, ``part`` and ``key``.

    ``part`` tells the texts without a doc_id apart, so that no list of their lines is longer than one text's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, keys = [], []
            for number, text in enumerate(texts(batch.column(2))):
                found = {line_hash(line, least) for line in text.split(b"\n")} - {None}
                numbers += [number] * len(found)
                keys += found
            rows = pa.array(numbers, pa.int64())
            arrays = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "part", "key"])

    return docs.select("doc_id", part_of(F.col("doc_id"), F.col("text")).alias("part"), "text").mapInArrow(run, PAIRS)


def part_of(doc_id: Column, text: Column) -> Column:
    return F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(0)


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Plans made inside take a sorted bucket of one file as sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Run(NamedTuple):
    """A run of a level, of the batches from a first to a last one."""

    level: int
    first: int
    last: int

    def __str__(self) -> str:
        return f"level={self.level},batches={self.first}-{self.last}"

    def within(self, other: Run) -> bool:
        return self.level < other.level and other.first <= self.first and self.last <= other.last


class LineRuns:
    """Line hashes of all batches so far, with their owners, as runs in a folder; one writer at a time.

    ``buckets`` should be so many that one of all lines suits a task; a folder keeps the number that it was begun with.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 3, buckets: int = 64):
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.path = (path or new_folder(spark, "line-runs")).rstrip("/")

    @property
    def runs(self) -> list[Run]:
        """Whole runs that no compacted one holds, the oldest first."""
        names = [re.fullmatch(r"level=(\d+),batches=(\d+)-(\d+)", name) for name in names_in(self.spark, self.path)]
        found = [Run(*map(int, m.groups())) for m in names if m and "_SUCCESS" in names_in(self.spark, f"{self.path}/{m[0]}")]
        return sorted((r for r in found if not any(r.within(other) for other in found)), key=lambda r: r.first)

    @property
    def levels(self) -> list[list[Run]]:
        runs = self.runs
        return [[r for r in runs if r.level == level] for level in range(max((r.level for r in runs), default=-1) + 1)]

    def _name(self, run: Run) -> str:
        folder = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        return f"line_run_{folder}_{run.level}_{run.first}_{run.last}"

    def read(self, run: Run) -> DataFrame:
        """``key`` and ``owner``, known to Spark as a table in sorted buckets."""
        where = self.path.replace("'", "\\'")
        self.spark.sql(
            f"create table if not exists {self._name(run)} (key binary, owner bigint) using parquet "
            f"clustered by (key) sorted by (key) into {self.buckets} buckets location '{where}/{run}'"
        )
        return self.spark.table(self._name(run))

    def _write(self, rows: DataFrame, run: Run) -> DataFrame:
        # By the bucket's number, as Spark gives it: a bucket is one task's, and so one file, however many tasks there are.
        bucket = F.pmod(F.hash("key"), F.lit(self.buckets))
        dealt = rows.select("key", "owner").repartition(self.buckets, bucket)
        writer = dealt.write.mode("overwrite").bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", f"{self.path}/{run}").saveAsTable(self._name(run))
        return self.read(run)

    def _remove(self, run: Run) -> None:
        self.spark.sql(f"drop table if exists {self._name(run)}")
        remove_folder(self.spark, f"{self.path}/{run}")

    def _compact(self) -> None:
        """Merge the runs of a level that has enough of them; what was merged goes once the new run is whole."""
        for runs in self.levels:
            if len(runs) >= self.fanout:
                rows = reduce(DataFrame.unionAll, [self.read(r) for r in runs])
                self._write(rows, Run(runs[0].level + 1, runs[0].first, runs[-1].last))
                for run in runs:
                    self._remove(run)
                return self._compact()

    def new_lines(self, pairs: DataFrame) -> DataFrame:
        """Lines that no run holds: ``key`` and ``owner``, the smallest document of the batch with the line."""
        new = pairs.groupBy("key").agg(F.min("doc_id").alias("owner")).repartition(self.buckets, "key")
        for run in self.runs:
            new = new.join(self.read(run).select("key").hint("merge"), "key", "left_anti")
        return new

    def add(self, pairs: DataFrame) -> DataFrame:
        """Add a batch (as of :func:`line_keys`; a written table); returns its pairs whose line is another document's.

        A document without an id comes last, and all such rows count as one document.
        """
        runs = self.runs
        number = runs[-1].last + 1 if runs else 0
        with _in_order(self.spark):
            run = self._write(self.new_lines(pairs), Run(0, number, number))
        # Joined by line and document, so that a line of very many documents is spread over tasks.
        owns = run.select(F.col("key").alias("own_key"), "owner")
        mine = (F.col("key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("owner"))
        drops = written(pairs.join(owns, mine, "left_anti"), "line-drops")
        self._compact()
        return drops


def drop_lines(text: Column, keys: Column, least: int = LEAST) -> Column:
    """A struct of ``n_lines``, ``n_dropped`` and ``text`` without the lines whose hash is in the array ``keys``."""

    @F.arrow_udf("n_lines long, n_dropped long, text string")
    def of(column: pa.Array, gone: pa.Array) -> pa.Array:
        totals, dropped, kept = [], [], []
        for value, hashes in zip(texts(column), gone, strict=True):
            lines = value.split(b"\n")
            stay = lines
            if hashes.is_valid and len(hashes):
                found = set(hashes.as_py())
                stay = [line for line in lines if line_hash(line, least) not in found]
            totals.append(len(lines))
            dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay))
        return pa.StructArray.from_arrays(
            [pa.array(totals, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_lines", "n_dropped", "text"],
        )

    return of(text, keys)


def dedup_lines(docs: DataFrame, batches: int = 4, fanout: int = 3, least: int = LEAST, runs: LineRuns | None = None) -> DataFrame:
    """Documents (``doc_id``, ``text``, any others) without the lines that a smaller doc_id holds.

    Batches are ranges of doc_id, so that an earlier batch has the smaller ones; how many changes the work, not the result.
    With ``runs`` of earlier jobs, their documents come before all of these, and these are added to them. Returns the given
    columns with the shortened ``text``, and ``n_lines`` (before) and ``n_dropped``, which replace columns of these names. A
    null text is one empty line. Rows that share a doc_id are one document: they drop the same lines, and a line that only
    they hold stays in all of them; rows without one are one document that comes last. A text that loses every line becomes
    empty.
    """
    spark = docs.sparkSession
    shares = F.array(*[F.lit(n / batches) for n in range(batches)])
    bounds = (docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("i")).first()["i"] or [])[1:]
    number = F.coalesce(sum([(F.col("doc_id") > b).cast("int") for b in bounds], F.lit(0)), F.lit(batches - 1))
    path = new_folder(spark, "line-keys")
    line_keys(docs, least).withColumn("batch", number).write.partitionBy("batch").parquet(path)
    pairs = spark.read.schema(f"{PAIRS}, batch int").parquet(path)
    runs = runs or LineRuns(spark, fanout=fanout)
    drops = [runs.add(pairs.filter(F.col("batch") == batch).drop("batch")) for batch in range(batches)]
    gone = reduce(DataFrame.unionAll, drops).groupBy("doc_id", "part").agg(F.collect_set("key").alias("keys"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("row_id"),
        part_of(F.col("doc_id"), F.col("text")).alias("row_part"),
    )
    joined = rows.join(gone, F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_part") == F.col("part")), "left")
    out = joined.select("row", drop_lines(F.col("row.text"), F.col("keys"), least).alias("cut"))
    own = {"text", "n_lines", "n_dropped"}
    return out.select(
        *[F.col(f"cut.{c}") if c in own else F.col("row").getField(c).alias(c) for c in docs.columns],
        *[F.col(f"cut.{c}") for c in ("n_lines", "n_dropped") if c not in docs.columns],
    )
