"""Session defaults and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "16g", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("remitlens")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a new one on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="remitlens-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """Where this application writes below the shared folder."""
    return f"{shared_folder(spark)}/remitlens/{spark.sparkContext.applicationId}"


_scratch: list[str] = []


def new_folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh path below the shared folder, unique to this call; inside of :func:`scratch` one that goes, unless to keep."""
    base = own_folder(spark) if keep or not _scratch else _scratch[-1]
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is written inside when it ends, as for a query whose result has been read or stored by then."""
    folder = new_folder(spark, "scratch", keep=True)
    _scratch.append(folder)
    try:
        yield
    finally:
        _scratch.remove(folder)
        remove_folder(spark, folder)


def _folder(spark: SparkSession, path: str):
    """A path of the cluster's file system, and that file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, if it is there."""
    found, system = _folder(spark, path)
    system.delete(found, True)


def names_in(spark: SparkSession, path: str) -> set[str]:
    """Names of the files and folders of a folder; none if it is not there."""
    found, system = _folder(spark, path)
    return {status.getPath().getName() for status in system.listStatus(found)} if system.exists(found) else set()


def remove_written(spark: SparkSession) -> None:
    """Delete all that this application has written below the shared folder, once its results are no longer read."""
    remove_folder(spark, own_folder(spark))


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A session setting that holds for what runs inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write a frame once to the shared folder and go on from the files.

    What is read more than once is then computed once, and a lost executor costs no recomputation.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
