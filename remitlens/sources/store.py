"""Parquet tables in one folder, whole ones by version and parts of them by partition.

A whole table is written to a version folder of its own, which readers take once Spark has marked its end; a write that
fails leaves the version before. Rows of one value, such as a batch's, are replaced inside of the version by Spark's
overwrite of single partitions: it moves them in when all tasks have ended, and touches no other partition. Between the
old rows' leaving and the new ones' coming lies that move alone; a writer that dies in it runs the value again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.session import names_in, remove_folder, setting

SPLIT, HELD = "_split", "_held"
#: Partition values that a task writes at once.
WRITERS = 16


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table.

    Rows are gathered by partition value first, or every task would write a file into every partition;
    the rebalance splits a value that holds many rows over several tasks.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)


def write_in_place(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table, each task writing its own rows of every partition value: nothing is moved or sorted for it.

    For a large table with few values, of which most tasks hold rows anyway. A task that meets more values than ``WRITERS``
    sorts the rows of the others, as Spark does.
    """
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", WRITERS):
        writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written table without looking at its files' schema, columns in the given order."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _split_of(value: Column) -> Column:
    """A partition name that is never empty nor taken for a number: Spark itself escapes what a path must not hold."""
    return F.coalesce(F.concat(F.lit("x"), value.cast("string")), F.lit("none"))


def _split_name(value: object) -> str:
    return "none" if value is None else f"x{value}"


class TableStore:
    """Named tables below one folder that all executors share; one writer at a time.

    Values by which a table is split (``split_by``, a column's name or an expression) should be a bounded number, each
    with many rows: batches, months, hash buckets.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _versions(self, name: str) -> list[int]:
        """Versions whose write has ended."""
        found = [f for f in names_in(self.spark, self.path(name)) if f.startswith("version=")]
        return sorted(int(f[8:]) for f in found if "_SUCCESS" in names_in(self.spark, f"{self.path(name)}/{f}"))

    def _last(self, name: str) -> str:
        versions = self._versions(name)
        if not versions:
            raise FileNotFoundError(f"no version of {name} in {self.folder}")
        return f"{self.path(name)}/version={versions[-1]}"

    def _split(self, df: DataFrame, split_by: str | Column, names: Iterable[str]) -> DataFrame:
        """The rows with their partition, and a row that holds nothing for each named one, so that it is there if empty."""
        value = F.col(split_by) if isinstance(split_by, str) else split_by
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        marks = self.spark.range(1).select(*blank, F.explode(F.array(*map(F.lit, names))).alias(SPLIT), F.lit(False).alias(HELD))
        return df.withColumns({SPLIT: _split_of(value), HELD: F.lit(True)}).unionByName(marks)

    def write(self, name: str, df: DataFrame, split_by: str | Column | None = None) -> None:
        """Replace the whole table. The version before stays until the next."""
        versions = self._versions(name)
        path = f"{self.path(name)}/version={versions[-1] + 1 if versions else 1}"
        if split_by is None:
            write_table(df, path)
        else:
            write_table(self._split(df, split_by, ["none"]), path, SPLIT)
        for old in versions[:-1]:
            remove_folder(self.spark, f"{self.path(name)}/version={old}")

    def replace(self, name: str, df: DataFrame, split_by: str | Column, values: Iterable[object]) -> None:
        """Replace the rows of some of the table's values by ``df``, which may read the table.

        ``df`` holds rows of these values only. A value of which it has no row has none afterwards.
        """
        rows = self._split(df, split_by, sorted({_split_name(v) for v in values}))
        writer = rows.hint("rebalance", SPLIT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(SPLIT).parquet(self._last(name))

    def read(self, name: str, *values: object) -> DataFrame:
        """The table, or its rows of some values, whose other folders are then not read."""
        rows = self.spark.read.parquet(self._last(name))
        if SPLIT not in rows.columns:
            return rows
        if values:
            rows = rows.where(F.col(SPLIT).isin(*[_split_name(v) for v in values]))
        return rows.where(HELD).drop(SPLIT, HELD)

    def write_outcomes(self, outcome_rows: DataFrame, batch_id: str | None = None) -> None:
        """Replace all outcomes, or those of one batch; a batch that lost its rows keeps none."""
        if batch_id is None:
            self.write("outcomes", outcome_rows, "batch_id")
        else:
            self.replace("outcomes", outcome_rows, "batch_id", [batch_id])

    def register_views(self, *names: str) -> None:
        """Make stored tables known to ``spark.sql``."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)
