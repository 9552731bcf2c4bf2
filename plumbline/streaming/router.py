"""Streaming job: de-duplicate messages, judge them, and route them to four sinks that are committed together per micro-batch."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from plumbline.streaming import contract
from plumbline.streaming.epochs import Entry, EpochLog, Manifest

# How long an id is remembered after its message arrived; the message retention.
DEDUP_HORIZON = "7 days"


def with_dedup_id(messages: DataFrame) -> DataFrame:
    """The ``event_id`` attribute, or the message id where it is absent.

    A message with neither repeats nothing that could be told, so it gets an id of its own.
    """
    own = F.concat(F.lit("none:"), F.uuid())
    return messages.withColumn("dedup_id", F.coalesce(F.col("attributes").getItem("event_id"), "message_id", own))


def deduplicated_stream(messages: DataFrame, horizon: str = DEDUP_HORIZON) -> DataFrame:
    """First message per de-dup id within the horizon of its arrival.

    The watermark is on the arrival time, the time of the micro-batch. It never runs ahead of a message, so however
    long ago a message was published, by a lagging partition or a replay, none is refused; and ids leave the state a
    horizon after they came in. One keyed step on the id alone: repeats find the id in the state and go no further.
    """
    arrived = with_dedup_id(messages).withColumn("__arrived", F.current_timestamp())
    unique = arrived.withWatermark("__arrived", horizon).dropDuplicatesWithinWatermark(["dedup_id"])
    return unique.drop("dedup_id", "__arrived")


def deduplicated_table(messages: DataFrame) -> DataFrame:
    """The batch form: the earliest published message per id. The limit to one row also holds before the shuffle."""
    first = Window.partitionBy("dedup_id").orderBy("publish_time", "message_id", "value")
    placed = with_dedup_id(messages).withColumn("__place", F.row_number().over(first))
    return placed.filter("__place = 1").select(*messages.columns)


SCHEMAS = {
    "raw": contract.RAW_SCHEMA,
    "typed": contract.TYPED_SCHEMA,
    "quarantine": contract.QUARANTINE_SCHEMA,
    "dead_letter": "value string",
}


def _at_once(spark: SparkSession, tasks: list[Callable]) -> list:
    """The results of a few tasks that each start Spark jobs; small jobs of several sinks then share the cores."""
    with ThreadPoolExecutor(len(SCHEMAS)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]


@dataclass(frozen=True)
class Committed:
    """The four outputs as of one version of the manifest: of every epoch all rows or none."""

    spark: SparkSession
    base: str
    manifest: Manifest

    def read(self, name: str, folders: list[str] | None = None) -> DataFrame:
        paths = [f"{self.base}/{f}" for f in (self.manifest.folders(name) if folders is None else folders)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.format(_format(name)).schema(SCHEMAS[name]).load(paths)


def _format(name: str) -> str:
    return "text" if name == "dead_letter" else "parquet"


@dataclass(frozen=True)
class RouteSinks:
    """Folders of the raw, typed, quarantine and dead-letter outputs, and the manifest of committed epochs."""

    base: str

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def log(self, spark: SparkSession) -> EpochLog:
        return EpochLog(spark, self.base)

    def committed(self, spark: SparkSession) -> Committed:
        """The outputs as they are now, all of one version."""
        return Committed(spark, self.base, self.log(spark).current())

    def write(self, name: str, epoch: int, rows: DataFrame) -> str:
        """Write rows to a folder of this attempt, which does not count before the epoch is committed."""
        folder = f"{name}/_epoch={epoch}/_try={uuid.uuid4().hex}"
        # The state has as many partitions as the cluster needs; files should have the size of the data.
        rows.hint("rebalance").write.format(_format(name)).save(f"{self.base}/{folder}")
        return folder

    def raw(self, spark: SparkSession) -> DataFrame:
        return self.committed(spark).read("raw")

    def typed(self, spark: SparkSession) -> DataFrame:
        return self.committed(spark).read("typed")

    def rejected(self, spark: SparkSession) -> DataFrame:
        return self.committed(spark).read("quarantine")

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        return self.committed(spark).read("dead_letter")

    def compact(self, spark: SparkSession, before: dt.date | None = None) -> list[Entry]:
        """Rewrite the epochs of each day (all, or those before a day) into one folder for each sink; returns the new ones.

        All new folders are put in the place of the old ones by one commit, while the stream goes on and readers read;
        the old ones stay on disk until ``vacuum``. Days of one folder are left alone, so what is written again and
        again is only the day that still grows, and what counts is a folder for each sink and day at most. If another
        run rewrote some of the folders first, nothing is changed.
        """
        log, now = self.log(spark), self.committed(spark)
        days: dict[tuple[str, str], list[Entry]] = {}
        for e in now.manifest.entries:
            if before is None or e.day < before.isoformat():
                days.setdefault((e.sink, e.day), []).append(e)
        many = {key: entries for key, entries in days.items() if len(entries) > 1}

        def rewritten(sink: str, day: str, entries: list[Entry]) -> Entry:
            last = max(e.last for e in entries)
            folder = self.write(sink, last, now.read(sink, [e.folder for e in entries]))
            return Entry(sink, folder, min(e.first for e in entries), last, day)

        new = _at_once(spark, [lambda key=key, entries=entries: rewritten(*key, entries) for key, entries in many.items()])
        return new if log.swap([e for entries in many.values() for e in entries], new) else []

    def vacuum(self, spark: SparkSession, **limits) -> list[str]:
        """Delete what no longer counts; see :meth:`EpochLog.vacuum`."""
        return self.log(spark).vacuum(list(SCHEMAS), **limits)


def deliver(judged: DataFrame, epoch: int, sinks: RouteSinks, received_at: Column | dt.datetime | None = None) -> None:
    """Write the judged rows of an epoch to each sink and commit it last; ``judged`` should be stored or persisted."""
    log = sinks.log(judged.sparkSession)
    if epoch <= log.current().epoch:
        return
    now = received_at if isinstance(received_at, dt.datetime) else dt.datetime.now(dt.timezone.utc)
    received = received_at if isinstance(received_at, Column) else F.lit(now)
    rejected = contract.rejected_rows(judged, received)
    outputs = {
        "raw": contract.raw_rows(judged, received),
        "typed": contract.typed_rows(judged, received),
        "quarantine": rejected,
        "dead_letter": contract.dead_letters(rejected),
    }
    writes = [lambda name=name, rows=rows: sinks.write(name, epoch, rows) for name, rows in outputs.items()]
    folders = dict(zip(outputs, _at_once(judged.sparkSession, writes)))
    log.commit(epoch, now.astimezone(dt.timezone.utc).date(), folders)


def route_batch(batch: DataFrame, epoch: int, sinks: RouteSinks, received_at: Column | dt.datetime | None = None) -> None:
    """Judge one micro-batch, write it to each sink and commit the epoch last.

    A batch that stopped half-way left nothing that counts, and one replayed after its commit changes nothing, so every
    message is in its sinks once. Epochs come in ascending order, as the engine numbers them.
    """
    if epoch <= sinks.log(batch.sparkSession).current().epoch:
        return
    judged = contract.judge(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Batches without data only move the watermark.
        if not judged.isEmpty():
            deliver(judged, epoch, sinks, received_at)
    finally:
        judged.unpersist()


def start_router(
    messages: DataFrame,
    sinks: RouteSinks,
    checkpoint: str,
    drain: bool = False,
    interval: str = "10 seconds",
    horizon: str = DEDUP_HORIZON,
) -> StreamingQuery:
    """Start the job. ``drain`` processes what is queued and stops; otherwise it runs on a fixed trigger."""

    def route(batch: DataFrame, epoch: int) -> None:
        # The session is the stream's own. Bodies and ids hardly repeat: trying to compress them costs a quarter of judging and caching.
        batch.sparkSession.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")
        route_batch(batch, epoch, sinks)

    writer = (
        deduplicated_stream(messages, horizon)
        .writeStream.queryName("event-router")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(route)
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()
