"""Publishing and consuming discrepancy events."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.operators.marks import may_meet
from remitlens.operators.reconcile import list_discrepancies
from remitlens.sources.events import EVENT_SCHEMA, PRODUCER_OPTIONS, TOPIC, event_messages, event_rows, parse_messages
from remitlens.streaming.jobs import BUCKETS, KeyedTable, each_batch

#: Fixed value: a first attempt and as many retries as producers are given.
ATTEMPTS = 1 + int(PRODUCER_OPTIONS["kafka.retries"])


def outgoing_messages(outcome_rows: DataFrame, detected_at: datetime.datetime) -> DataFrame:
    """Keyed messages for every discrepancy of the arriving outcomes."""
    return event_messages(event_rows(list_discrepancies(outcome_rows), detected_at))


class EventSink(Protocol):
    """Where messages (``key``, ``value``) go. A send that is tried again may deliver some of them twice."""

    def send(self, messages: DataFrame) -> None: ...


@dataclass(frozen=True)
class FolderSink:
    """JSON lines of key and value below a folder, for consumers that read files."""

    path: str

    def send(self, messages: DataFrame) -> None:
        messages.write.mode("append").json(self.path)


@dataclass(frozen=True)
class TopicSink:
    """A topic; needs the Kafka connector on the class path, which does all the work under these options."""

    bootstrap_servers: str
    topic: str = TOPIC

    def options(self) -> dict[str, str]:
        return {**PRODUCER_OPTIONS, "kafka.bootstrap.servers": self.bootstrap_servers, "topic": self.topic}

    def send(self, messages: DataFrame) -> None:
        messages.write.format("kafka").options(**self.options()).save()


def publish_stream(messages: DataFrame, sink: EventSink, progress: str, attempts: int = ATTEMPTS) -> None:
    """Deliver every message at least once: all that is there now, a micro-batch at a time.

    A send that fails is tried again, with the whole micro-batch. After the last attempt the stream fails too, and a later
    run with the same ``progress`` goes on with that micro-batch. Consumers tell repeats by the key.
    """

    def deliver(batch: DataFrame, epoch: int) -> None:
        for left in reversed(range(attempts)):
            try:
                sink.send(batch.select("key", "value"))
                return
            except Exception:
                if not left:
                    raise

    each_batch(messages, deliver, progress)


def consumed(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> KeyedTable:
    """The events taken so far."""
    return KeyedTable(spark, folder, EVENT_SCHEMA, "idempotency_key", buckets)


def consume_once(messages: DataFrame, taken: KeyedTable) -> None:
    """Take each event at its first delivery, however late that or a repeat of it comes.

    A micro-batch is folded by key and compared with the stored events of its own buckets. Nothing is kept in memory
    between micro-batches, and no first delivery is too old.
    """

    def take(batch: DataFrame, epoch: int) -> None:
        session, sent = batch.sparkSession, parse_messages(batch)
        taken.begin(session, epoch)
        fresh = sent.dropDuplicates(["idempotency_key"])
        key = ["idempotency_key"]
        stored = may_meet(taken.read(session, epoch, taken.buckets_of(sent)).select(*key), sent, key)
        taken.write(fresh.join(stored, key, "left_anti"), epoch)

    each_batch(messages, take, f"{taken.path}-progress")
