"""The tables that the analyst queries read."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.functions.calendar import is_festival, month_id, week_start
from remitlens.operators.reconcile import list_discrepancies, outcomes
from remitlens.operators.upsert import insert_missing
from remitlens.session import new_folder
from remitlens.sources.benchmark_tables import AS_OF, BenchmarkTables
from remitlens.sources.store import read_table, write_in_place


def derive_dates(orders: DataFrame, as_of: datetime.date, week_mode: str = "sunday") -> DataFrame:
    """Calendar of the distinct order dates."""
    day = F.col("date_id")
    return (
        orders.select(F.col("order_date").alias("date_id"))
        .distinct()
        .select(
            "date_id",
            week_start(day, week_mode).cast("string").alias("week_id"),
            month_id(day).alias("month_id"),
            is_festival(day, as_of).alias("is_festival"),
        )
    )


def extend_dates(dates: DataFrame, orders: DataFrame, as_of: datetime.date) -> DataFrame:
    """Add missing days; days already there keep the flag they were loaded with."""
    return insert_missing(dates, derive_dates(orders, as_of), ["date_id"])


class Warehouse:
    """Dimensions, orders and outcomes; what else the queries need derives from them."""

    couriers: DataFrame
    geography: DataFrame
    merchants: DataFrame
    dates: DataFrame
    orders: DataFrame
    outcomes: DataFrame
    #: Orders with their folded discrepancies, where these have been written for several queries to read.
    disputed: DataFrame | None = None

    @property
    def discrepancies(self) -> DataFrame:
        return list_discrepancies(self.outcomes.where(F.col("dispute_count") > 0))

    def named_courier(self, df: DataFrame, key: str = "courier_id") -> DataFrame:
        """Add courier_name; rows of unknown couriers drop out."""
        names = self.couriers.select(F.col("courier_id").alias(key), "courier_name")
        return df.join(names, key)

    def with_tier(self, df: DataFrame) -> DataFrame:
        return df.join(self.geography.select("geo_id", "tier"), "geo_id")


@dataclass(frozen=True)
class LoadedWarehouse(Warehouse):
    """A warehouse over frames at hand."""

    couriers: DataFrame
    geography: DataFrame
    merchants: DataFrame
    dates: DataFrame
    orders: DataFrame
    outcomes: DataFrame
    disputed: DataFrame | None = None


def from_tables(tables: dict[str, DataFrame], as_of: datetime.date) -> LoadedWarehouse:
    """A warehouse over loaded tables; outcomes are planned, not yet computed."""
    orders = tables["fact_orders"]
    return LoadedWarehouse(
        tables["dim_courier"],
        tables["dim_geography"],
        tables["dim_merchant"],
        derive_dates(orders, as_of),
        orders,
        outcomes(tables["fact_settlements"], orders),
    )


_staged: dict[tuple, tuple[str, T.StructType]] = {}


def _files(tables: BenchmarkTables, names: tuple[str, ...]) -> tuple:
    """The given files with their sizes and times, so that changed files are staged anew."""
    paths = [f"{tables.folder}/{name}.parquet" for name in names]
    rows = tables.spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return tuple(sorted(tuple(r) for r in rows.collect()))


def _stage(spark: SparkSession, key: tuple, name: str, build: Callable[[], DataFrame],
           partition_by: str | None = None) -> DataFrame:
    """Write a derived table once per application and state of the given files, and read it from there."""
    key = (*key, name)
    if key not in _staged:
        df, path = build(), new_folder(spark, name, keep=True)
        write_in_place(df, path, partition_by)
        _staged[key] = (path, df.schema)
    return read_table(spark, *_staged[key])


class BenchmarkWarehouse(Warehouse):
    """The warehouse derived from the given tables of one scale, loaded table by table when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.tables = BenchmarkTables(spark, folder)

    @cached_property
    def _key(self) -> tuple:
        files = _files(self.tables, ("orders", "lineitem", "customer", "region"))
        return (self.spark.sparkContext.applicationId, self.folder, files)

    @cached_property
    def couriers(self) -> DataFrame:
        return self.tables.couriers()

    @cached_property
    def geography(self) -> DataFrame:
        return self.tables.geography()

    @cached_property
    def merchants(self) -> DataFrame:
        return self.tables.merchants()

    @cached_property
    def dates(self) -> DataFrame:
        return derive_dates(self.orders, AS_OF)

    @cached_property
    def _keyed_orders(self) -> DataFrame:
        return _stage(self.spark, self._key, "orders", self.tables.orders)

    @cached_property
    def orders(self) -> DataFrame:
        return self._keyed_orders.drop("order_key")

    @cached_property
    def settlements(self) -> DataFrame:
        def build() -> DataFrame:
            return self.tables.settlements(self._keyed_orders)

        return _stage(self.spark, self._key, "settlements", build, "batch_id")

    @cached_property
    def outcomes(self) -> DataFrame:
        def build() -> DataFrame:
            return outcomes(self.settlements, self.orders)

        return _stage(self.spark, self._key, "outcomes", build, "batch_id")

    def written_folder(self, name: str) -> str:
        """Where the orders, settlements or outcomes were written, for a stream to read."""
        getattr(self, name)
        return _staged[*self._key, name][0]


def unstaged_warehouse(spark: SparkSession, folder: str) -> LoadedWarehouse:
    """The benchmark's warehouse as one plan from the given files, with nothing written in between."""
    t = BenchmarkTables(spark, folder)
    keyed = t.orders()
    orders = keyed.drop("order_key")
    return LoadedWarehouse(
        t.couriers(), t.geography(), t.merchants(), derive_dates(orders, AS_OF), orders,
        outcomes(t.settlements(keyed), orders),
    )
