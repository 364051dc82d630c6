import datetime
import re
from functools import reduce

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.operators.reconcile import outcomes, reconcile
from remitlens.plans import kpis
from remitlens.plans.warehouse import BenchmarkWarehouse
from remitlens.session import names_in, new_folder
from remitlens.sources import events
from remitlens.streaming import bursts, event_feed, jobs, leakage_windows, settlement_feed
from tests.conftest import SMALL, day


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def arriving(spark, name, *parts):
    """Files in the order of ``parts``, one to a micro-batch."""
    path = new_folder(spark, name)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return jobs.table_stream(spark, path, parts[0].schema, files_per_trigger=1)


NOT_COPIES = "discrepancy_type <> 'DUPLICATE_SETTLEMENT'"


def files_of(df) -> set[str]:
    """The buckets that a frame's files lie in."""
    return {path.partition("/bucket=")[2].partition("/")[0] for path in df.inputFiles()}


def test_numbers_may_be_left_out(spark):
    table = jobs.KeyedTable(spark, new_folder(spark, "keyed"), "k string, n int", "k", 2, 3)
    for epoch in (0, 1, 5, 13, 14, 40):
        table.begin(spark, epoch)
        assert table.read(spark, epoch).count() == {0: 0, 1: 1, 5: 2, 13: 3, 14: 4, 40: 5}[epoch]
        table.write(numbers(spark, epoch), epoch)
    assert sorted(r.n for r in table.read_last(spark).collect()) == [0, 1, 5, 13, 14, 40]


def test_per_row_rules_equal_the_batch(spark, orders_of, settlements_of):
    orders = orders_of(*[dict(awb_number=f"A{i}") for i in range(5)])
    first = settlements_of(dict(awb_number="A0", rto_charge=150), dict(awb_number="A1"), dict(awb_number="X"))
    second = settlements_of(dict(awb_number="A2", settlement_date=day(20)), dict(awb_number="A0", batch_id="B2"))
    book = settlement_feed.order_book(spark, new_folder(spark, "orders"))
    settlement_feed.add_orders(book, orders, 0)
    tables = settlement_feed.check_against_table(arriving(spark, "arriving", first, second), book, spark, new_folder(spark, "found"))
    batch = reconcile(first.unionByName(second), orders).where(NOT_COPIES)
    assert rows_of(tables["found"].read(spark)) == rows_of(batch)
    assert [r.awb_number for r in tables["waiting"].read_last(spark).collect()] == ["X"]


def test_settlements_before_their_order_are_found_once_it_is_stored(spark, orders_of, settlements_of):
    book, folder, path = (settlement_feed.order_book(spark, new_folder(spark, "orders"), 4), new_folder(spark, "found"), new_folder(spark, "arriving"))
    parts = [
        (orders_of(dict(awb_number="A0")), settlements_of(dict(awb_number="A0", rto_charge=150), dict(awb_number="A1", rto_charge=90))),
        (orders_of(dict(awb_number="A0", cod_amount=9000)), settlements_of(dict(awb_number="A1", batch_id="B2", rto_charge=70))),
        (orders_of(dict(awb_number="A1"), dict(awb_number="A2")), settlements_of(dict(awb_number="A3", rto_charge=5))),
    ]
    waiting = []
    for number, (orders, settled) in enumerate(parts):
        settlement_feed.add_orders(book, orders, number)
        settled.coalesce(1).write.mode("append").parquet(path)
        tables = settlement_feed.check_against_table(jobs.table_stream(spark, path, settled.schema), book, spark, folder)
        waiting.append(sorted(str(r.awb_number) for r in tables["waiting"].read_last(spark).collect()))
    # An order that comes again does not change what was found, nor repeat it.
    orders = parts[0][0].unionByName(parts[2][0])
    whole = reduce(DataFrame.unionByName, [settled for _, settled in parts])
    assert rows_of(tables["found"].read(spark)) == rows_of(reconcile(whole, orders).where(NOT_COPIES))
    assert waiting == [["A1"], ["A1", "A1"], ["A3"]]


@pytest.mark.parametrize("generation", [2, 32])
def test_orders_and_settlements_in_any_order(spark, orders_of, settlements_of, generation):
    orders = [
        orders_of(dict(awb_number="A0")), orders_of(dict(awb_number="A2"), dict(awb_number="A4")), orders_of(dict(awb_number="A1")),
        orders_of(dict(awb_number="A0", cod_amount=5000), dict(awb_number="A9")), orders_of(dict(awb_number="A7")),
    ]
    settled = [
        settlements_of(dict(awb_number="A1", rto_charge=150), dict(awb_number="A2", settlement_date=day(900))),
        settlements_of(dict(awb_number="A0", settlement_date=day(-3), rto_charge=90), dict(awb_number="A3", rto_charge=5)),
        settlements_of(dict(awb_number="A1", batch_id="B2", rto_charge=70)),
        settlements_of(dict(awb_number="A4", rto_charge=10), dict(awb_number="A7", rto_charge=20)),
        settlements_of(dict(awb_number="A4", batch_id="B7", rto_charge=10)),
    ]
    folder = new_folder(spark, "joined")
    tables = settlement_feed.check_against_stream(
        arriving(spark, "settled", *settled), arriving(spark, "orders", *orders), spark, folder, 4, generation
    )
    first = [parts.where("cod_amount = 1000") for parts in orders]
    batch = reconcile(*[reduce(DataFrame.unionByName, parts) for parts in (settled, first)]).where(NOT_COPIES)
    # A settlement before its order, one years after it, one that waited and one whose order came twice: each found once.
    assert rows_of(tables["found"].read(spark)) == rows_of(batch)
    assert [r.awb_number for r in settlement_feed.still_waiting(tables, spark).collect()] == ["A3"]
    # A generation keeps only what still waits.
    if generation == 2:
        tables["late"].begin(spark, 6)
        tables["orders"].begin(spark, 6)
        assert [r.awb_number for r in tables["late"].read_last(spark).collect()] == ["A3"]


def numbers(spark, *keys):
    return spark.createDataFrame([(f"K{k}", k) for k in keys], "k string, n int")


def test_a_micro_batch_opens_its_own_buckets_only(spark):
    table = jobs.KeyedTable(spark, new_folder(spark, "keyed"), "k string, n int", "k", 32)
    for epoch in range(3):
        table.begin(spark, epoch)
        table.write(numbers(spark, *range(300)), epoch)
    few = table.buckets_of(numbers(spark, 5, 9))
    rows = table.read(spark, 3, few)
    assert 1 <= len(few) <= 2 and files_of(rows) == {str(b) for b in few}
    assert rows.where("k = 'K5'").count() == 3 and len(files_of(table.read(spark, 3))) == 32
    # The scan is of these folders, and of the micro-batches before by their folders too.
    plan = table.read(spark, 2, few)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(epoch#\d+\), \(epoch#\d+ < 2\)\]", plan)
    assert table.read(spark, 3, [b for b in range(32) if b not in table.buckets_of(numbers(spark, *range(300)))]).count() == 0


def test_later_micro_batches_open_no_more_files(spark):
    """Keys that come once: what a micro-batch opens depends on its keys, not on how many came before."""
    table, opened = jobs.KeyedTable(spark, new_folder(spark, "keyed"), "k string, n int", "k", 64, 5), []
    for epoch in range(20):
        fresh = numbers(spark, epoch, epoch + 100)
        table.begin(spark, epoch)
        opened.append(len(table.read(spark, epoch, table.buckets_of(fresh)).inputFiles()))
        table.write(fresh, epoch)
    assert max(opened) <= 6 and table.read_last(spark).count() == 40


def test_generations_bound_the_files_and_may_be_tried_again(spark):
    add_up = lambda rows, last: rows.groupBy("k").agg(F.sum("n").cast("int").alias("n"))
    table = jobs.KeyedTable(spark, new_folder(spark, "keyed"), "k string, n int", "k", 2, 3, add_up)
    for epoch in range(8):
        for _ in range(2):  # every micro-batch is tried twice
            table.begin(spark, epoch)
            before = table.read(spark, epoch).agg(F.sum("n")).first()[0]
            table.write(numbers(spark, 1, 2), epoch)
        assert (before or 0) == 3 * epoch
    assert sorted(map(tuple, add_up(table.read_last(spark), 0).collect())) == [("K1", 8), ("K2", 16)]
    again = jobs.KeyedTable(spark, table.path, "k string, n int", "k", 2, 3, add_up)
    assert again.read_last(spark).agg(F.sum("n")).first()[0] == 24
    assert names_in(spark, table.path) == {"generation=1", "generation=2"}
    assert len(table.read_last(spark).inputFiles()) <= 2 * 3


def test_a_late_copy_flags_the_earlier_one(spark, orders_of, settlements_of):
    orders = orders_of(*[dict(awb_number=f"A{i}") for i in range(4)])
    parts = [
        settlements_of(dict(awb_number="A0"), dict(awb_number="A1"), dict(awb_number="A2", settlement_id="T0")),
        settlements_of(dict(awb_number="A0", batch_id="B2", settlement_id="T1")),
        settlements_of(dict(awb_number="A0", batch_id="B3", settlement_id="T2"),
                       dict(awb_number="A1", batch_id="B3", settlement_id="T3")),
    ]
    path, folder, seen = new_folder(spark, "arriving"), new_folder(spark, "copies"), None
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = jobs.table_stream(spark, path, part.schema)
        touched = settlement_feed.keep_touched(stream, spark, folder, 4, 2)["touched"].read(spark)
        seen = part if seen is None else seen.unionByName(part)
        now = settlement_feed.duplicate_findings(seen, orders, touched)
        assert rows_of(now) == rows_of(reconcile(seen, orders).where("discrepancy_type = 'DUPLICATE_SETTLEMENT'"))
    assert touched.where("awb_number = 'A0'").count() == 2
    assert now.count() == 5


def test_touched_awbs_meet_no_whole_fact(spark, orders_of, settlements_of):
    touched = spark.createDataFrame([("A0", 2)], "awb_number string, copies long")
    settled, orders = settlements_of(dict(awb_number="A0")), orders_of(dict(awb_number="A0"))
    plan = settlement_feed.duplicate_findings(settled, orders, touched)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2


def test_events_are_taken_once_however_late(spark, orders_of, settlements_of):
    at = datetime.datetime(2026, 9, 14, 12)

    def messages(awb, when):
        found = reconcile(settlements_of(dict(awb_number=awb, rto_charge=150)), orders_of(dict(awb_number=awb)))
        return events.event_messages(events.event_rows(found, when))

    parts = [
        messages("A", at), messages("A", at + datetime.timedelta(minutes=5)), messages("B", at - datetime.timedelta(days=30)),
        messages("A", at + datetime.timedelta(days=400)), messages("C", at).unionByName(messages("C", at)), messages("B", at),
    ]
    taken = event_feed.consumed(spark, new_folder(spark, "taken"))
    event_feed.consume_once(arriving(spark, "delivered", *parts), taken)
    got = taken.read_last(spark).collect()
    assert sorted(r.idempotency_key for r in got) == [f"{a}|B1|PHANTOM_RTO_CHARGE" for a in "ABC"]


def test_published_messages_carry_every_discrepancy(spark):
    wh = BenchmarkWarehouse(spark, SMALL)
    path = new_folder(spark, "outcomes")
    wh.outcomes.write.parquet(path)
    messages = event_feed.outgoing_messages(
        jobs.table_stream(spark, path, wh.outcomes.schema), datetime.datetime(2026, 1, 1)
    )
    sent_to = new_folder(spark, "sent")
    event_feed.publish_stream(messages, event_feed.FolderSink(sent_to), f"{sent_to}-progress")
    sent = spark.read.json(sent_to)
    assert rows_of(sent.select("key")) == rows_of(wh.discrepancies.select("discrepancy_id"))


@pytest.mark.parametrize("build, batch", [
    (leakage_windows.daily_leakage, kpis.daily_trend), (leakage_windows.weekly_leakage, kpis.weekly_trend),
])
def test_windows_equal_the_batch_trend(spark, build, batch):
    wh = BenchmarkWarehouse(spark, SMALL)
    parts = [wh.outcomes.where(f"pmod(hash(settlement_id), 3) = {n}") for n in range(3)]
    windows = leakage_windows.keep_windows(build(arriving(spark, "outcomes", *parts)), spark, new_folder(spark, "w"))
    assert rows_of(windows.read_last(spark)) == rows_of(batch(wh))


class FailingSink:
    """Writes and then fails, as a broker that took some messages before it was lost."""

    def __init__(self, path, failures):
        self.inner, self.failures, self.sends = event_feed.FolderSink(path), failures, 0

    def send(self, messages):
        self.sends += 1
        if self.sends <= self.failures:
            self.inner.send(messages.limit(1))
            raise ConnectionError("no broker")
        self.inner.send(messages)


def keyed_messages(spark, *keys):
    return spark.createDataFrame([(k, f'{{"discrepancy_id": "{k}", "idempotency_key": "{k}"}}') for k in keys], "key string, value string")


def test_every_message_is_delivered_at_least_once(spark):
    stream = lambda: arriving(spark, "outgoing", keyed_messages(spark, "a", "b"), keyed_messages(spark, "c"))
    path, sink = new_folder(spark, "sent"), None
    sink = FailingSink(path, event_feed.ATTEMPTS - 1)
    event_feed.publish_stream(stream(), sink, f"{path}-progress")
    sent = spark.read.schema("key string, value string").json(path)
    assert {r.key for r in sent.collect()} == {"a", "b", "c"} and sink.sends == event_feed.ATTEMPTS + 1
    # Key and value belong together, and a consumer takes each once although some came twice.
    assert sent.where("key <> get_json_object(value, '$.discrepancy_id')").count() == 0 and sent.count() > 3
    taken = event_feed.consumed(spark, new_folder(spark, "taken"))
    event_feed.consume_once(jobs.table_stream(spark, path, sent.schema, "json"), taken)
    assert sorted(r.idempotency_key for r in taken.read_last(spark).collect()) == ["a", "b", "c"]


def test_a_stream_that_gave_up_goes_on_where_it_stopped(spark):
    out, messages = new_folder(spark, "outgoing"), [keyed_messages(spark, "a"), keyed_messages(spark, "b")]
    for part in messages:
        part.coalesce(1).write.mode("append").parquet(out)
    path = new_folder(spark, "sent")
    stream = lambda: jobs.table_stream(spark, out, messages[0].schema, files_per_trigger=1)
    with pytest.raises(StreamingQueryException, match="no broker"):
        event_feed.publish_stream(stream(), FailingSink(path, 99), f"{path}-progress", attempts=2)
    sink = FailingSink(path, 0)
    event_feed.publish_stream(stream(), sink, f"{path}-progress")
    assert sink.sends == 2 and {r.key for r in spark.read.json(path).collect()} == {"a", "b"}


def test_a_topic_gets_the_fixed_options():
    sink = event_feed.TopicSink("broker:9092")
    assert sink.options() == {
        "kafka.acks": "all", "kafka.retries": "3", "kafka.bootstrap.servers": "broker:9092", "topic": "discrepancy.events",
    }


def plain_bursts(days, gap):
    found = []
    for d in sorted(days):
        if found and d - found[-1][1] <= gap:
            found[-1] = (found[-1][0], d, found[-1][2] + 1)
        else:
            found.append((d, d, 1))
    return [(day(a), day(b), n) for a, b, n in found]


def test_late_settlements_join_two_bursts(spark, orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A"))
    days = [[0, 20, 3], [14, 40], [9, 60, 46], [65, 71, 5]]
    parts = [outcomes(settlements_of(*[dict(awb_number="A", settlement_date=day(n), rto_charge=9000) for n in part]), orders) for part in days]
    small = outcomes(settlements_of(dict(awb_number="A", settlement_date=day(30), rto_charge=10)), orders)
    built = bursts.bursts(arriving(spark, "arriving", *parts, small))
    table = leakage_windows.keep_windows(built, spark, new_folder(spark, "bursts"))
    got = sorted((r.burst_start, r.burst_end, r.settlements) for r in table.read_last(spark).collect())
    assert got == plain_bursts([n for part in days for n in part], 5)
    # The same from a table at once, and only the last micro-batches' results stay.
    batch = bursts.bursts(reduce(DataFrame.unionByName, parts))
    assert sorted((r.burst_start, r.burst_end, r.settlements) for r in batch.collect()) == got
    assert len([n for n in names_in(spark, table.path) if n.startswith("epoch=")]) <= 3


def test_late_rows_count_in_their_window(spark, orders_of, settlements_of):
    orders = orders_of(dict(awb_number="A"))
    parts = [outcomes(settlements_of(dict(awb_number="A", settlement_date=day(n))), orders) for n in (9, 5, 20, 5)]
    windows = leakage_windows.daily_leakage(arriving(spark, "arriving", *parts))
    table = leakage_windows.keep_windows(windows, spark, new_folder(spark, "w"))
    assert {r.kpi_date: r.settlements for r in table.read_last(spark).collect()} == {day(5): 2, day(9): 1, day(20): 1}


def test_a_repeated_micro_batch_changes_nothing(spark):
    table = jobs.EpochTable(spark, new_folder(spark, "epochs"), "x int")
    one = lambda x: spark.createDataFrame([(x,)], "x int")
    for epoch, x in ((0, 1), (1, 2), (1, 3)):
        table.write(one(x), epoch)
    assert sorted(r.x for r in table.read(spark).collect()) == [1, 3]
    assert [r.x for r in table.read(spark, before=1).collect()] == [1] and table.read(spark, only=1).first().x == 3
