"""Registered queries: names, their Spark plans over one folder of given tables, and their SQL twins."""

from __future__ import annotations

import datetime
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

import oracle_queries  # noqa: E402
from remitlens.functions.numbers import half_even  # noqa: E402
from remitlens.operators import cubes, multisets, quality, reconcile as rec, upsert  # noqa: E402
from remitlens.plans import (  # noqa: E402
    cycle,
    forecast,
    hypotheses,
    integrity,
    kpis,
    marketplace,
    marts,
    measures,
    periods,
    segments,
    sketches,
)
from remitlens.plans.warehouse import (  # noqa: E402
    BenchmarkWarehouse,
    LoadedWarehouse,
    Warehouse,
    derive_dates,
    extend_dates,
    unstaged_warehouse,
)
from remitlens.schema import DIM_COURIER, DIM_GEOGRAPHY, FACT_ORDERS, MARKET_REVIEWS, WAREHOUSE_TABLES  # noqa: E402
from remitlens.session import new_folder, written  # noqa: E402
from remitlens.settings import DISCREPANCY_TYPES  # noqa: E402
from remitlens.sources import csv_tables, events, exports  # noqa: E402
from remitlens.sources.benchmark_tables import AS_OF, BenchmarkTables  # noqa: E402
from remitlens.sources.store import TableStore  # noqa: E402
from remitlens.streaming import bursts, event_feed, jobs, leakage_windows, settlement_feed  # noqa: E402

# The text operators and their pipeline are one part of the library that may be taken out, and then only the rest is
# registered. If they are there but need a module that is not, that is an error and not a smaller library.
try:
    import corpus_pipeline
    from remitlens.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "remitlens.llm"):
        raise
    corpus_pipeline = text_queries = None

DETECTED_AT = datetime.datetime(2026, 1, 31, 6, 30)


def plain(df: DataFrame) -> DataFrame:
    """Results in types every engine prints alike: bigint, double to six digits, text."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            column = column.cast("long")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def entry(spark: SparkSession) -> DataFrame:
    """Cases and leakage by discrepancy type, as one plan from the given tables."""
    wh = unstaged_warehouse(spark, "/root/testdata/sf0.001")
    return plain(rec.summarise(wh.discrepancies))


# -- query families ----------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(BenchmarkWarehouse(spark, folder)))


def _on_facts(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Queries over settlements and orders, before reconciliation."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        facts = BenchmarkWarehouse(spark, folder)
        return plain(build(facts.settlements, facts.orders))

    return run


def _on_market(build: Callable[[marketplace.Marketplace], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(marketplace.BenchmarkMarketplace(spark, folder)))


def _one_rule(kind: str) -> Query:
    return _on_facts(lambda s, o: rec.reconcile(s, o, names=(kind,)))


def _by_batch_and_type(found: DataFrame) -> DataFrame:
    return plain(
        found.groupBy("batch_id", "discrepancy_type").agg(
            F.count(F.lit(1)).alias("cases"), F.sum("variance_rs").alias("leakage_rs")
        )
    )


def _batch_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Reconcile everything, then one batch again: the stored table must not change."""
    facts = BenchmarkWarehouse(spark, folder)
    store = TableStore(spark, new_folder(spark, "store"))
    for batch in (None, "RUN-1997"):
        cycle.reconcile_into(store, facts.settlements, facts.orders, batch)
    return _by_batch_and_type(rec.list_discrepancies(store.read("outcomes")))


#: Batch ids that paths, type inference or patterns might take for something else.
ODD_BATCHES = {"RUN-1995": "A+B (1)/%=x", "RUN-1996": "0096", "RUN-1997": "1997-01-06", "RUN-1998": "\u0936\u094d\u0930\u0940 8"}


def _batch_rerun_changed(spark: SparkSession, folder: str) -> DataFrame:
    """A first run on wrong rows, then each odd batch again: one lost all rows, one some, the others changed."""
    facts = BenchmarkWarehouse(spark, folder)
    odd = F.create_map(*[F.lit(x) for pair in ODD_BATCHES.items() for x in pair])
    right = facts.settlements.withColumn("batch_id", F.coalesce(odd[F.col("batch_id")], F.col("batch_id")))
    lost, fewer, *_ = ODD_BATCHES.values()
    right = right.where(F.col("batch_id") != lost)
    gone = facts.settlements.where(F.col("batch_id") == "RUN-1995").withColumn("batch_id", F.lit(lost))
    wrong = right.withColumn("rto_charge", (F.col("rto_charge") + 7).cast("decimal(10,2)")).unionByName(gone)
    right = right.where((F.col("batch_id") != fewer) | (F.col("courier_id") != 1))
    wrong = wrong.where(F.col("batch_id").isin(*ODD_BATCHES.values())).unionByName(
        right.where(~F.col("batch_id").isin(*ODD_BATCHES.values()))
    )
    store = TableStore(spark, new_folder(spark, "store"))
    cycle.reconcile_into(store, wrong, facts.orders)
    for batch in ODD_BATCHES.values():
        cycle.reconcile_into(store, right, facts.orders, batch)
    # Copies are those of all batches as they are then, so batches that were not run again keep those of the first run.
    return _by_batch_and_type(rec.list_discrepancies(store.read("outcomes")))


def _attached_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The daily trend from a discrepancy list joined back to the settlements."""
    wh = BenchmarkWarehouse(spark, folder)
    joined = rec.attach_discrepancies(wh.settlements, wh.orders, wh.discrepancies)
    return plain(
        kpis.daily_trend(LoadedWarehouse(wh.couriers, wh.geography, wh.merchants, wh.dates, wh.orders, joined))
    )


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    wh = BenchmarkWarehouse(spark, folder)
    frames = (wh.couriers, wh.geography, wh.merchants, wh.orders, wh.settlements)
    return dict(zip(WAREHOUSE_TABLES, frames, strict=True))


def _dq(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.warehouse_violations(_tables(spark, folder), WAREHOUSE_TABLES))


def _orders_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "orders-csv")
    BenchmarkWarehouse(spark, folder).orders.write.option("header", True).csv(path)
    loaded = csv_tables.read_named(spark, path, FACT_ORDERS)
    sums = ("cod_amount", "declared_weight", "order_value", "actual_eta_hrs")
    return plain(
        loaded.groupBy("order_status", "payment_mode").agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("actual_eta_hrs").alias("timed"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )


def _reviews_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "reviews-csv")
    reviews = BenchmarkTables(spark, folder).market_reviews()
    blank = {f.name: F.lit("") for f in MARKET_REVIEWS.fields if f.name not in reviews.columns}
    # Of repeats on one date the load keeps the greatest by the columns after the date, in order of their names.
    reviews.withColumns(blank).write.options(header=True, quote='"', escape='"').csv(path)
    loaded = csv_tables.load_marketplace(spark, {"reviews": path})["reviews"]
    return plain(
        loaded.groupBy("review_score").agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count_distinct("order_id").alias("orders"),
            F.count("review_comment_title").alias("titled"),
            F.count("review_comment_message").alias("told"),
            F.sum(F.length("review_comment_message")).alias("message_chars"),
        )
    )


def _analyst_sql(spark: SparkSession, folder: str) -> DataFrame:
    BenchmarkWarehouse(spark, folder).discrepancies.createOrReplaceTempView("fact_discrepancies")
    return plain(
        spark.sql(
            """SELECT batch_id, severity, count(*) AS cases, sum(variance_rs) AS leakage_rs
            FROM fact_discrepancies WHERE discrepancy_type = :kind AND variance_rs > :floor
            GROUP BY batch_id, severity""",
            args={"kind": "OVERDUE_REMITTANCE", "floor": 1000},
        )
    )


def _events(batch_id: str | None = None) -> Query:
    """Events as written and read back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_folder(spark, "events")
        found = BenchmarkWarehouse(spark, folder).discrepancies
        events.write_events(events.event_rows(found, DETECTED_AT, batch_id), path)
        return plain(events.parse_messages(spark.read.text(path)))

    return run


def _mart_upsert(wh: Warehouse) -> DataFrame:
    """Refresh a stored mart that holds a stale day and outdated figures."""
    fresh = marts.daily_kpis(wh)
    outdated = fresh.withColumns({"orders": F.lit(0).cast("long"), "leakage_rs": F.lit(0).cast("decimal(24,2)")})
    stale = wh.couriers.select(
        F.lit(datetime.date(1990, 1, 1)).alias("kpi_date"),
        "courier_id",
        F.lit(0).alias("geo_id"),
        F.lit(1).alias("orders"),
        F.lit(0).alias("disputed_awbs"),
        F.lit(0).cast("decimal(24,2)").alias("leakage_rs"),
        F.lit(5).cast("decimal(8,2)").alias("avg_dso_days"),
    )
    return marts.upsert_daily_kpis(outdated.unionByName(stale), fresh)


def _settlement_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """The mart after a full run on wrong rows of one batch and a second run of that batch."""
    tables, store = _tables(spark, folder), TableStore(spark, new_folder(spark, "cycle"))
    settled = tables["fact_settlements"]
    dearer = F.col("rto_charge") + F.when(F.col("batch_id") == "RUN-2000", 90).otherwise(0)
    wrong = settled.withColumn("rto_charge", dearer.cast("decimal(10,2)"))
    cycle.run_cycle(store, {**tables, "fact_settlements": wrong}, AS_OF, DETECTED_AT, 1)
    cycle.run_cycle(store, tables, AS_OF, DETECTED_AT, 2, "RUN-2000")
    return plain(store.read("daily_kpis"))


def _serving_bundle(spark: SparkSession, folder: str) -> DataFrame:
    frames = exports.serving_frames(BenchmarkWarehouse(spark, folder))
    path = new_folder(spark, "serving")
    exports.write_json(frames, path)
    return plain(exports.bundle_sizes(spark, path, list(frames), "json"))


def _csv_of(frames: Callable[[SparkSession, str], exports.Builders], name: str) -> Query:
    """One export written as CSV and read back under its own column types."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path, build = new_folder(spark, "report"), frames(spark, folder)[name]
        exports.write_csv({name: build}, path)
        schema = build().schema
        rows = spark.read.options(header=True, quote='"', escape='"').csv(f"{path}/{name}")
        return plain(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]))

    return run


def _report_frames(spark: SparkSession, folder: str) -> exports.Builders:
    wh = BenchmarkWarehouse(spark, folder)
    return exports.report_frames(wh, marts.daily_kpis(wh))


def _market_frames(spark: SparkSession, folder: str) -> exports.Builders:
    return exports.market_frames(marketplace.BenchmarkMarketplace(spark, folder))


def _json_of(name: str) -> Query:
    """One serving export written as JSON and read back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path, build = new_folder(spark, "serving"), exports.serving_frames(BenchmarkWarehouse(spark, folder))[name]
        exports.write_json({name: build}, path)
        return plain(spark.read.schema(build().schema).json(f"{path}/{name}"))

    return run


def _positional_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Couriers from a CSV whose header is wrong, read by position."""
    path, couriers = new_folder(spark, "positional"), BenchmarkWarehouse(spark, folder).couriers
    couriers.toDF("w", "x", "y", "z").write.option("header", True).csv(path)
    return plain(csv_tables.read_positional(spark, path, DIM_COURIER))


def _bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as CSV with text in the key of every seventh order: good and bad rows."""
    path, merchants = new_folder(spark, "bad-rows"), BenchmarkWarehouse(spark, folder).merchants
    number = F.substring("merchant_id", 3, 20).cast("long")
    broken = F.when(number % 7 == 0, "x").otherwise(number.cast("string"))
    merchants.select(broken.alias("geo_id"), F.col("merchant_name").alias("city"), F.lit("Tier-1").alias("tier"), F.col("category").alias("zone")).write.option(
        "header", True
    ).csv(path)
    good, bad = csv_tables.split_bad_rows(spark, path, DIM_GEOGRAPHY)
    counted = [rows.agg(F.count(F.lit(1)).alias("found")).select(F.lit(kind).alias("kind"), "found") for kind, rows in (("good", good), ("bad", bad))]
    return plain(counted[0].unionByName(counted[1]))


def _calendar_growth(spark: SparkSession, folder: str) -> DataFrame:
    """A calendar of the first year's orders, loaded a year after them, that then grows by all others."""
    wh = BenchmarkWarehouse(spark, folder)
    first = derive_dates(wh.orders.where("order_date < date '1996-01-01'"), datetime.date(1996, 1, 1))
    return plain(extend_dates(first, wh.orders, AS_OF))


def _result_checks(spark: SparkSession, folder: str) -> DataFrame:
    wh = BenchmarkWarehouse(spark, folder)
    return plain(quality.result_violations(wh.discrepancies, marts.daily_kpis(wh), _tables(spark, folder)))


def _whole_run(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files in, exports out; the mart as the report export has it."""
    source, out = new_folder(spark, "source"), new_folder(spark, "run")
    for name, table in _tables(spark, folder).items():
        table.write.options(header=True, quote='"', escape='"').csv(f"{source}/{name}.csv")
    cycle.run_all(spark, source, out, AS_OF, DETECTED_AT)
    rows = spark.read.option("header", True).csv(f"{out}/report/kpi_daily")
    wide = {"orders": "long", "disputed_awbs": "long", "leakage_rs": "decimal(24,2)", "avg_dso_days": "decimal(8,2)"}
    return plain(rows.withColumns({c: F.col(c).cast(kind) for c, kind in wide.items()}))


def _whole_run_results(spark: SparkSession, folder: str) -> DataFrame:
    """What a run from CSV files leaves beside its exports: its events as read back, its summary and its violations."""
    source, out = new_folder(spark, "source"), new_folder(spark, "run")
    for name, table in _tables(spark, folder).items():
        table.write.options(header=True, quote='"', escape='"').csv(f"{source}/{name}.csv")
    run = cycle.run_all(spark, source, out, AS_OF, DETECTED_AT)
    lines = spark.read.text(f"{out}/events/version=1")
    sent = events.parse_messages(lines, "discrepancy_type", "variance_rs").groupBy("discrepancy_type").agg(
        F.count(F.lit(1)).alias("found"), F.sum("variance_rs").alias("amount")
    )
    listed = lambda df, part, name, found, amount: df.select(
        F.lit(part).alias("part"), F.col(name).alias("name"), F.col(found).alias("found"), amount.cast("double").alias("amount")
    )
    parts = [
        listed(sent, "events", "discrepancy_type", "found", F.round("amount", 2)),
        listed(run["summary"], "summary", "discrepancy_type", "cases", F.col("leakage_rs")),
        listed(run["violations"], "violations", "check_name", "violations", F.lit(None)),
    ]
    return plain(parts[0].unionAll(parts[1]).unionAll(parts[2]))


def _run_difference(spark: SparkSession, folder: str) -> DataFrame:
    """The discrepancies of a batch before and after a correction: a courier left out, another charged less, one copy twice."""
    facts = BenchmarkWarehouse(spark, folder)
    right = rec.reconcile(facts.settlements, facts.orders, "RUN-1996")
    kept = right.where(F.col("courier_id") != 1)
    dearer = F.when(F.col("courier_id") == 2, F.col("variance_rs") + 10).otherwise(F.col("variance_rs")).cast("decimal(12,2)")
    before = kept.withColumn("variance_rs", dearer).unionByName(kept.where(F.col("courier_id") == 3))
    return plain(multisets.difference(before, right, ["discrepancy_id"]))


def _discrepancy_cube(wh: Warehouse) -> DataFrame:
    found = wh.with_tier(wh.named_courier(wh.discrepancies))
    dims = ["courier_name", "tier", "discrepancy_type", "severity"]
    return cubes.grouped(found, dims, "awb_number", {"leakage_rs": F.sum("variance_rs")}).select(
        "grouping_id", *dims, F.col("rows_n").alias("cases"), F.col("distinct_n").alias("awbs"), "leakage_rs"
    )


def _sketches(spark: SparkSession, folder: str) -> DataFrame:
    """From a written mart of sketches, for some years."""
    wh = BenchmarkWarehouse(spark, folder)
    mart = written(sketches.sketch_mart(wh), "sketch-mart")
    return plain(sketches.sketch_check(wh, mart, datetime.date(1994, 3, 1), datetime.date(1997, 10, 31)))


def _nested_treemap(wh: Warehouse) -> DataFrame:
    """The children of each type as text, in order."""
    return kpis.nested_treemap(wh).select(
        "discrepancy_type", "type_total",
        F.concat_ws(",", F.transform("children", lambda c: F.concat_ws(":", c["tier"], c["size"].cast("long")))).alias("children"),
    )


# -- streams -----------------------------------------------------------------------------------------


def _arriving(wh: BenchmarkWarehouse, name: str, files: int | None = None) -> DataFrame:
    """A table as a stream of files: as it is stored, or cut by hash into micro-batches that each hold rows of all days."""
    if files is None:
        return jobs.table_stream(wh.spark, wh.written_folder(name), getattr(wh, name).schema)
    path, rows = new_folder(wh.spark, f"arriving-{name}"), getattr(wh, name)
    each = jobs.cut_into_files(rows, path, files, F.xxhash64("awb_number", F.lit(7)))
    return jobs.table_stream(wh.spark, path, rows.schema, files_per_trigger=each)


#: Micro-batches of the streams over facts, and the buckets of what they keep.
ARRIVALS, STREAM_BUCKETS = 20, 16


def _stream_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the orders are stored at first; the others come when half of the settlements have been checked."""
    facts, out, path = BenchmarkWarehouse(spark, folder), new_folder(spark, "stream-reconcile"), new_folder(spark, "arriving-settlements")
    book = settlement_feed.order_book(spark, f"{out}/orders", STREAM_BUCKETS)
    half = lambda key, n: F.pmod(F.xxhash64(key, F.lit(3)), F.lit(2)) == n
    for load in range(2):
        settlement_feed.add_orders(book, facts.orders.where(half("awb_number", load)), load)
        rows = facts.settlements.where(half("settlement_id", load))
        each = jobs.cut_into_files(rows, path, ARRIVALS // 2, F.xxhash64("awb_number", F.lit(7)))
        settled = jobs.table_stream(spark, path, rows.schema, files_per_trigger=each)
        tables = settlement_feed.check_against_table(settled, book, spark, f"{out}/checked")
    return plain(tables["found"].read(spark))


def _stream_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and settlements come in files of random AWBs and days, one of each to a micro-batch."""
    facts = BenchmarkWarehouse(spark, folder)
    settled, orders = _arriving(facts, "settlements", ARRIVALS), _arriving(facts, "orders", ARRIVALS - 3)
    out = new_folder(spark, "stream-join")
    tables = settlement_feed.check_against_stream(settled, orders, spark, out, STREAM_BUCKETS, ARRIVALS // 2)
    return plain(tables["found"].read(spark))


def _stream_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    facts = BenchmarkWarehouse(spark, folder)
    path, rows = new_folder(spark, "arriving-copies"), facts.settlements
    # Cut by id, so that the copies of an AWB come in several micro-batches.
    each = jobs.cut_into_files(rows, path, ARRIVALS, F.xxhash64("settlement_id"))
    arriving = jobs.table_stream(spark, path, rows.schema, files_per_trigger=each)
    tables = settlement_feed.keep_touched(arriving, spark, new_folder(spark, "copies"), STREAM_BUCKETS, ARRIVALS // 2)
    return plain(settlement_feed.duplicate_findings(facts.settlements, facts.orders, tables["touched"].read(spark)))


def _published(spark: SparkSession, folder: str) -> str:
    messages = event_feed.outgoing_messages(_arriving(BenchmarkWarehouse(spark, folder), "outcomes"), DETECTED_AT)
    path = new_folder(spark, "published")
    event_feed.publish_stream(messages, event_feed.FolderSink(path), f"{path}-progress")
    return path


def _event_publication(spark: SparkSession, folder: str) -> DataFrame:
    messages = spark.read.schema("key string, value string").json(_published(spark, folder))
    return plain(events.parse_messages(messages))


def _stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, each kept once, over several micro-batches."""
    sent = spark.read.schema("key string, value string").json(_published(spark, folder))
    twice = new_folder(spark, "delivered-twice")
    each = jobs.cut_into_files(sent.unionByName(sent), twice, ARRIVALS, F.rand(5))
    taken = event_feed.consumed(spark, new_folder(spark, "consumed"), STREAM_BUCKETS)
    event_feed.consume_once(jobs.table_stream(spark, twice, sent.schema, files_per_trigger=each), taken)
    return plain(taken.read_last(spark))


def _windows(build: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        arriving = _arriving(BenchmarkWarehouse(spark, folder), "outcomes", 4)
        return plain(leakage_windows.keep_windows(build(arriving), spark, new_folder(spark, "windows")).read_last(spark))

    return run


def _bursts(spark: SparkSession, folder: str) -> DataFrame:
    """Files of random days, so that sessions grow at both ends and meet."""
    arriving = _arriving(BenchmarkWarehouse(spark, folder), "outcomes", 6)
    return plain(leakage_windows.keep_windows(bursts.bursts(arriving), spark, new_folder(spark, "bursts")).read_last(spark))


def warehouse_queries() -> dict[str, Query]:
    on, facts, market = _on_warehouse, _on_facts, _on_market
    found: dict[str, Query] = {
        # Reconciliation and loads.
        "reconcile_rows": facts(rec.reconcile),
        "reconcile_summary": facts(lambda s, o: rec.summarise(rec.reconcile(s, o))),
        "reconcile_one_batch": facts(lambda s, o: rec.reconcile(s, o, "RUN-1998")),
        "batch_rerun": _batch_rerun,
        "batch_rerun_changed": _batch_rerun_changed,
        "attached_trend": _attached_trend,
        "unsettled_orders": facts(
            lambda s, o: rec.unsettled_orders(s, o).select(
                "order_id", "awb_number", "courier_id", "merchant_id", "order_date", "order_status"
            )
        ),
        "same_batch_copies": lambda spark, folder: plain(rec.same_batch_copies(BenchmarkTables(spark, folder).bookings())),
        "dq_violations": _dq,
        "dim_date": on(lambda wh: wh.dates),
        "load_orders_csv": _orders_csv,
        "load_reviews_csv": _reviews_csv,
        "load_positional_csv": _positional_csv,
        "split_bad_rows_csv": _bad_rows,
        "calendar_growth": _calendar_growth,
        "dq_results": _result_checks,
        "whole_run": _whole_run,
        "whole_run_results": _whole_run_results,
        "run_difference": _run_difference,
        "analyst_sql": _analyst_sql,
        "discrepancy_events": _events(),
        "batch_events": _events("RUN-1996"),
        # Headline figures and trends.
        "header_kpis": on(lambda wh: kpis.header_kpis(wh).drop("avg_dso_days")),
        "header_kpis_dso": on(kpis.header_kpis),
        "glossary": on(kpis.glossary),
        "daily_trend": on(kpis.daily_trend),
        "daily_trend_settlement_grain": on(lambda wh: kpis.daily_trend(wh, "settlement")),
        "weekly_trend": on(kpis.weekly_trend),
        "weekly_wow": on(kpis.weekly_wow),
        "weekly_wow_iso": on(lambda wh: kpis.weekly_wow(wh, "iso")),
        "dso_by_courier": on(kpis.dso_by_courier),
        "funnel": on(kpis.funnel),
        "festival_vs_normal": on(kpis.festival_vs_normal),
        # Scorecards and tiers.
        "courier_scorecard": on(kpis.courier_scorecard),
        "courier_scorecard_order_grain": on(lambda wh: kpis.courier_scorecard(wh, "order")),
        "courier_scorecard_frame": on(kpis.courier_scorecard_frame),
        "scorecard_export": on(lambda wh: kpis.courier_scorecard_frame(wh, 1)),
        "dispute_share_by_courier": on(kpis.dispute_share_by_courier),
        "radar": on(kpis.radar_long),
        "tier_entry": on(lambda wh: kpis.tier_entry(wh).drop("delay")),
        "tier_entry_export": on(lambda wh: kpis.tier_entry(wh).drop("leakage_pct_of_gmv", "avg_delay_hrs")),
        "tier_entry_order_grain": on(lambda wh: kpis.tier_entry(wh, "order").drop("delay")),
        "tier_leakage_share": on(lambda wh: kpis.tier_entry(wh).select("tier", "leakage_pct_of_gmv")),
        # Drill-down.
        "rca_cells": on(kpis.rca_cells),
        "rca_cells_export": on(lambda wh: kpis.rca_cells(wh, 60, rounded=half_even)),
        "rca_workbench": on(lambda wh: kpis.rca_workbench(wh, tier="Tier-3")),
        "rca_workbench_courier": on(lambda wh: kpis.rca_workbench(wh, courier="ASIA")),
        "rca_rollup": on(kpis.rca_rollup),
        "discrepancy_cube": on(_discrepancy_cube),
        "sketch_check": _sketches,
        "leakage_by_type": on(lambda wh: kpis.leakage_by(wh, "discrepancy_type")),
        "leakage_by_courier": on(lambda wh: kpis.leakage_by(wh, "courier_name")),
        "leakage_by_tier": on(lambda wh: kpis.leakage_by(wh, "tier")),
        "average_loss_by_type": on(kpis.average_loss_by_type),
        "severity_mix": on(kpis.severity_mix),
        "worst_courier_per_tier": on(kpis.worst_courier_per_tier),
        "pareto_couriers": on(kpis.pareto_couriers),
        "pareto_export": on(lambda wh: kpis.pareto_couriers(wh, rounded=half_even)),
        "treemap": on(kpis.treemap),
        "treemap_nested": on(_nested_treemap),
        "scatter": on(kpis.scatter),
        # Lists.
        "duplicate_awbs": on(integrity.duplicate_awbs),
        "overdue_list": on(integrity.overdue_list),
        "cod_short_list": on(integrity.cod_short_list),
        "weight_list": on(integrity.weight_list),
        "eta_adherence": on(integrity.eta_adherence),
        # Merchants.
        "merchant_segments": on(segments.merchant_segments),
        "merchant_segments_order_grain": on(lambda wh: segments.merchant_segments(wh, grain="order")),
        "merchant_quartiles": on(segments.merchant_quartiles),
        "merchant_health": on(segments.merchant_health),
        "merchant_retention": on(segments.merchant_retention),
        # Mart, exports and measures.
        "daily_kpis_mart": on(marts.daily_kpis),
        "mart_upsert": on(_mart_upsert),
        "settlement_cycle": _settlement_cycle,
        "export_kpi_daily": on(lambda wh: marts.kpi_daily_export(wh, marts.daily_kpis(wh))),
        "export_discrepancies": on(marts.discrepancies_export),
        "serving_bundle": _serving_bundle,
        "csv_kpi_daily": _csv_of(_report_frames, "kpi_daily"),
        "csv_discrepancies": _csv_of(_report_frames, "discrepancies"),
        "csv_review_impact": _csv_of(_market_frames, "review_impact"),
        "csv_monthly": _csv_of(_market_frames, "monthly"),
        "csv_seller_late": _csv_of(_market_frames, "seller_late"),
        "json_trend": _json_of("trend"),
        "json_scorecard": _json_of("scorecard"),
        "json_rca_cells": _json_of("rca_cells"),
        "json_kpis": _json_of("kpis"),
        "json_pareto": _json_of("pareto"),
        "json_funnel": _json_of("funnel"),
        "json_merchants": _json_of("merchants"),
        "json_tier_entry": _json_of("tier_entry"),
        "json_forecast": _json_of("forecast"),
        "csv_courier_scorecard": _csv_of(_report_frames, "courier_scorecard"),
        "csv_merchant_health": _csv_of(_report_frames, "merchant_health"),
        "measures_overview": on(lambda wh: measures.measures_overview(wh, marts.daily_kpis(wh))),
        "measures_sliced": on(
            lambda wh: measures.measures_overview(wh, marts.daily_kpis(wh), "AMERICA", "Tier-3", "LOW")
        ),
        "leakage_vs_week_before": on(lambda wh: measures.leakage_vs_week_before(marts.daily_kpis(wh))),
        # What was in force, and seasons.
        "tariff_in_force": lambda spark, folder: plain(
            periods.charged_and_agreed(BenchmarkWarehouse(spark, folder).settlements, BenchmarkTables(spark, folder).tariffs())
        ),
        "season_kpis": lambda spark, folder: plain(
            periods.seasons_kpis(BenchmarkWarehouse(spark, folder).outcomes, BenchmarkTables(spark, folder).seasons())
        ),
        "trailing_leakage": on(lambda wh: periods.trailing_leakage(wh.outcomes)),
        "booked_and_settled": facts(lambda s, o: periods.booked_and_settled(o, s)),
        "overdue_intervals": facts(periods.overdue_settlements),
        # Statistics.
        "welch_weight": on(
            lambda wh: hypotheses.weight_inflation_test(wh, "AMERICA", "Tier-3")
            .drop("p_value", "decision")
            .withColumn("df", F.round("df", 4))
        ),
        "chi2_festival": on(lambda wh: hypotheses.festival_dispute_test(wh).drop("p_value", "decision")),
        "chi2_cod_short": on(lambda wh: hypotheses.cod_short_test(wh, "AFRICA").drop("p_value", "decision")),
        "weekly_series": on(forecast.weekly_series),
        "ridge_fit": on(
            lambda wh: forecast.ridge_fit(forecast.weekly_series(wh)).withColumns(
                {c: F.round(c, 3) for c in ("intercept", "coef_t", "coef_fest")}
            )
        ),
        "ridge_forecast": on(lambda wh: forecast.ridge_forecast(forecast.weekly_series(wh))),
        "actual_and_forecast": on(lambda wh: forecast.actual_and_forecast(forecast.weekly_series(wh))),
        # Marketplace.
        "late_rate": market(marketplace.late_rate),
        "payment_mismatch": market(lambda m: marketplace.payment_mismatch(marketplace.billed_and_paid(m))),
        "freight_outliers": market(
            lambda m: marketplace.freight_outliers(written(marketplace.billed_and_paid(m), "bills"))
        ),
        "review_impact_first": market(lambda m: marketplace.review_impact_first(m).drop("p_value")),
        "review_impact_latest": market(marketplace.review_impact_latest),
        "review_pivot": market(marketplace.review_pivot),
        "review_mix": market(marketplace.review_mix),
        "seller_late": market(marketplace.seller_late),
        "worst_sellers": market(marketplace.worst_sellers),
        "monthly_late": market(marketplace.monthly_late),
        "validation_summary": market(lambda m: marketplace.validation_summary(m).drop("chi2_p")),
        "market_measures": market(marketplace.market_measures),
        # Streams.
        "stream_reconcile": _stream_reconcile,
        "stream_join": _stream_join,
        "stream_duplicates": _stream_duplicates,
        "stream_dedup": _stream_dedup,
        "event_publication": _event_publication,
        "stream_daily": _windows(leakage_windows.daily_leakage),
        "stream_weekly": _windows(leakage_windows.weekly_leakage),
        "stream_sliding": _windows(leakage_windows.sliding_leakage),
        "stream_bursts": _bursts,
    }
    for kind in DISCREPANCY_TYPES:
        found[f"rule_{kind.lower()}"] = _one_rule(kind)
    return found


def _importable(query: Query) -> Query:
    """The query, with this folder on the path of the Python processes beside the executors too."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        own = spark.sparkContext.environment
        if HERE not in own.get("PYTHONPATH", "").split(os.pathsep):
            own["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, own.get("PYTHONPATH")]))
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    found = warehouse_queries()
    if text_queries:
        text = text_queries.queries() | {"pipeline": corpus_pipeline.run}
        found |= {name: _importable(query) for name, query in text.items()}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if text_queries:
        found |= text_queries.oracle_sql() | ({"pipeline": sql} if (sql := corpus_pipeline.ORACLE_SQL) else {})
    return found
