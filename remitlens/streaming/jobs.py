"""Sources, sinks and runs shared by the streaming jobs."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.session import names_in, remove_folder

EPOCH, BUCKET = "epoch", "bucket"
#: Buckets of a stream's keys, and micro-batches after which a bucket's files are written as one.
BUCKETS, GENERATION = 64, 32
#: Rows of a file that arrives.
FILE_ROWS = 250_000


def table_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 files_per_trigger: int | None = None) -> DataFrame:
    """Rows of a folder as they arrive; folders below it that name a partition add its column.

    ``files_per_trigger`` bounds a micro-batch, as for a backfill that must not be one.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def cut_into_files(rows: DataFrame, path: str, batches: int, by: Column, most: int = FILE_ROWS, mode: str = "append") -> int:
    """Write rows in files of about ``most`` rows or fewer, cut by a column's hash; returns the files of a micro-batch.

    That many files at a time are read in ``batches`` micro-batches. A task writes one file, so it holds no more rows with
    more data, and a micro-batch is read by as many tasks as it has files.
    """
    each = max(1, math.ceil(rows.count() / (batches * most)))
    rows.repartition(batches * each, by).write.mode(mode).parquet(path)
    return each


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


class EpochTable:
    """Rows that micro-batches leave, a folder each.

    A micro-batch that is tried again overwrites its folder and reads those before it only, so a retry changes nothing.
    Where each micro-batch writes the whole result anew, ``keep`` says how many of the last ones stay.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keep: int | None = None):
        self.path, self.schema, self.keep = path, _schema(schema), keep
        # The folder of no micro-batch makes the table readable before the first one.
        self.write(no_rows(spark, self.schema), -1)

    def write(self, rows: DataFrame, epoch: int) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/{EPOCH}={epoch}")
        if self.keep is not None and epoch >= self.keep:
            remove_folder(rows.sparkSession, f"{self.path}/{EPOCH}={epoch - self.keep}")

    def read(self, spark: SparkSession, before: int | None = None, only: int | None = None) -> DataFrame:
        """All rows, those of micro-batches before one, or those of one."""
        if only is not None:
            return spark.read.schema(self.schema).parquet(f"{self.path}/{EPOCH}={only}")
        wide = T.StructType([*self.schema.fields, T.StructField(EPOCH, T.IntegerType())])
        rows = spark.read.schema(wide).parquet(self.path)
        if before is not None:
            rows = rows.where(F.col(EPOCH) < before)
        return rows.drop(EPOCH)

    def read_last(self, spark: SparkSession) -> DataFrame:
        """Rows of the last micro-batch, where each writes the whole result anew."""
        epochs = [int(name.partition("=")[2]) for name in names_in(spark, self.path) if name.startswith(EPOCH)]
        return self.read(spark, only=max(epochs))


class KeyedTable:
    """Rows that micro-batches leave, in folders by the hash bucket of their key and then by micro-batch.

    A micro-batch lists and opens the buckets of its own keys only, so it costs what these hold and not what ever came.
    ``buckets`` should be so many that one of them suits a task, and that a micro-batch's keys fall into few; a batch with
    keys in all of them reads them all.

    Every ``generation`` micro-batches, the rows go on in a new folder as one micro-batch, after ``fold`` (of the rows and
    the number of the last micro-batch in them) where what rows say can be said by fewer. A bucket thus never has more files than a generation has micro-batches. A generation is one
    sequential pass over what it still holds. The one before stays, for a first micro-batch that has to be tried again.

    Micro-batches have rising numbers; each calls ``begin`` before it reads or writes.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str, buckets: int = BUCKETS,
                 generation: int = GENERATION, fold: Callable[[DataFrame, int], DataFrame] | None = None):
        self.path, self.schema, self.key = path, _schema(schema), key
        self.buckets, self.generation, self.fold = buckets, generation, fold
        if not names_in(spark, path):
            self._write(no_rows(spark, self.schema), 0, -1, "static")

    def _folder(self, number: int) -> str:
        return f"{self.path}/generation={number}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, number: int, epoch: int, replace: str = "dynamic") -> None:
        rows = rows.select(*self.schema.fieldNames()).withColumns({BUCKET: self._bucket(), EPOCH: F.lit(epoch)})
        # A task writes few buckets, and a bucket that holds a heavy key is split over several tasks. A micro-batch replaces
        # its own folders only, so writing it again changes nothing; a new generation replaces all and leaves a mark.
        writer = rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", replace)
        writer.partitionBy(BUCKET, EPOCH).parquet(self._folder(number))

    def begin(self, spark: SparkSession, epoch: int) -> None:
        """Start a new generation if this is its first micro-batch."""
        number, whole = epoch // self.generation, self._generations(spark)
        if number not in whole:
            held = self._rows(spark, whole[-1], None)
            self._write(held if self.fold is None else self.fold(held, epoch - 1), number, epoch - 1, "static")
            for old in whole[:-1]:
                remove_folder(spark, self._folder(old))

    def _generations(self, spark: SparkSession) -> list[int]:
        """Those whose first write has ended."""
        numbers = sorted(int(name.partition("=")[2]) for name in names_in(spark, self.path))
        return [n for n in numbers if "_SUCCESS" in names_in(spark, self._folder(n))]

    def write(self, rows: DataFrame, epoch: int) -> None:
        self._write(rows, epoch // self.generation, epoch)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of a frame's keys: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())

    def _rows(self, spark: SparkSession, number: int, buckets: list[int] | None) -> DataFrame:
        folder = self._folder(number)
        there = {name for name in names_in(spark, folder) if name.startswith(BUCKET)}
        wanted = sorted(there if buckets is None else there & {f"{BUCKET}={b}" for b in buckets})
        wide = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(EPOCH, T.IntegerType())])
        if not wanted:
            return no_rows(spark, wide)
        return spark.read.schema(wide).option("basePath", folder).parquet(*[f"{folder}/{name}" for name in wanted])

    def read(self, spark: SparkSession, epoch: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the micro-batches before one that has begun; of all buckets or of some."""
        return self._read(spark, epoch, buckets, F.col(EPOCH) < epoch)

    def read_through(self, spark: SparkSession, epoch: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the micro-batches up to one that has written."""
        return self._read(spark, epoch, buckets, F.col(EPOCH) <= epoch)

    def read_own(self, spark: SparkSession, epoch: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows that a micro-batch has written."""
        return self._read(spark, epoch, buckets, F.col(EPOCH) == epoch)

    def _read(self, spark: SparkSession, epoch: int, buckets: list[int] | None, when: Column) -> DataFrame:
        return self._rows(spark, epoch // self.generation, buckets).where(when).select(*self.schema.fieldNames())

    def read_last(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """All rows there are, also for a job that has not written them."""
        return self._rows(spark, self._generations(spark)[-1], buckets).select(*self.schema.fieldNames())


def each_batch(df: DataFrame, act: Callable[[DataFrame, int], None], progress: str, mode: str = "append") -> None:
    """Process everything that is there now, a micro-batch at a time."""
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(act)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
