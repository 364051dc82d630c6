"""Typed CSV loads of the warehouse and the marketplace tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.functions.text import basic_plane_only
from remitlens.schema import MARKET_TABLES, WAREHOUSE_TABLES

CORRUPT = "_corrupt_record"


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


#: Files whose first lines are read at a time.
READERS = 16


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, compressed or not; None if it is empty. Only its first bytes are read."""
    jvm = spark._jvm
    path, settings = jvm.org.apache.hadoop.fs.Path(file), spark._jsc.hadoopConfiguration()
    stream = path.getFileSystem(settings).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
        text = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()


def by_header(spark: SparkSession, path: str, **options: object) -> list[DataFrame]:
    """The text columns of CSV files, one frame for each distinct header, since Spark reads all files by the first one's.

    The files' names and first lines come to the driver, as the names do for any read; no file is read twice. Quoted line
    breaks in column names are not supported.
    """
    options = {"header": True, **options}
    # Spark names files as escaped addresses.
    unescaped = lambda address: spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(address)).toString()
    names = sorted(map(unescaped, spark.read.text(path).inputFiles()))
    with ThreadPoolExecutor(READERS) as readers:
        headers = list(readers.map(lambda name: first_line(spark, name), names))
    files: dict[str, list[str]] = {}
    for name, header in zip(names, headers, strict=True):
        if header is not None:
            files.setdefault(header.removeprefix("\ufeff"), []).append(name)
    return [spark.read.options(**options).csv(group) for _, group in sorted(files.items())]


def _named(frames: list[DataFrame], columns: Callable[[], list[Column]], schema: T.StructType, spark: SparkSession) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], _nullable(schema))
    return reduce(DataFrame.unionByName, [frame.select(*columns()) for frame in frames])


def read_named(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose header names the columns in any order, in each file its own; empty text is null.

    Text is cast under the schema, and a value that does not fit raises.
    """
    cast = lambda: [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return _named(by_header(spark, path, nullValue=""), cast, schema, spark)


def read_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV in schema column order; the header line is skipped, not read."""
    return spark.read.schema(_nullable(schema)).options(
        header=True, enforceSchema=True, nullValue="", mode="FAILFAST"
    ).csv(path)


def split_bad_rows(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw text of those that do not."""
    wide = T.StructType([*_nullable(schema).fields, T.StructField(CORRUPT, T.StringType(), True)])
    rows = spark.read.schema(wide).options(
        header=True, nullValue="", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    ).csv(path)
    # Columns the good rows do not need would be pruned and left unparsed, so both sides keep them all.
    missing = F.lit(False)
    for field in schema.fields:
        if not field.nullable:
            missing = missing | F.col(field.name).isNull()
    bad = F.col(CORRUPT).isNotNull() | missing
    text = F.coalesce(CORRUPT, F.to_csv(F.struct(*schema.fieldNames())))
    return rows.where(~bad).drop(CORRUPT), rows.where(bad).select(text.alias("bad_row"), *schema.fieldNames())


def load_warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five warehouse tables from ``<folder>/<table>.csv``."""
    return {name: read_named(spark, f"{folder}/{name}.csv", schema) for name, schema in WAREHOUSE_TABLES.items()}


def coerce(text: Column, data_type: T.DataType) -> Column:
    """Lenient conversion: what cannot be read becomes null."""
    if isinstance(data_type, T.TimestampNTZType):
        return text.try_cast("timestamp_ntz")
    if isinstance(data_type, T.IntegerType):
        return text.try_cast("double").try_cast("int")
    if isinstance(data_type, T.StringType):
        return basic_plane_only(text)
    return text.try_cast(data_type)


def read_coerced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lenient read by each file's own header.

    Review texts hold line breaks, and a file with quoted breaks cannot be split: each is one task, so a large load of
    reviews should come as many files. The other tables are read line by line.
    """
    free_text = "review_comment_message" in schema.fieldNames()
    frames = by_header(spark, path, multiLine=free_text, quote='"', escape='"')
    return _named(frames, lambda: [coerce(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields], schema, spark)


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """Keep one row per review: the last by creation date, where a missing date counts as last.

    The winner is an aggregate, not a window, so a review id of any size folds before the shuffle.
    """
    rest = [c for c in reviews.columns if c not in ("review_id", "review_creation_date")]
    order = F.struct(
        F.col("review_creation_date").isNull().alias("undated"), "review_creation_date", *sorted(rest)
    )
    best = reviews.groupBy("review_id").agg(F.max(order).alias("best"))
    return best.select("review_id", "best.*").select(*reviews.columns)


def load_marketplace(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The marketplace tables from one CSV path each; reviews come out without repeats."""
    tables = {name: read_coerced(spark, paths[name], schema) for name, schema in MARKET_TABLES.items() if name in paths}
    if "reviews" in tables:
        tables["reviews"] = latest_reviews(tables["reviews"])
    return tables
