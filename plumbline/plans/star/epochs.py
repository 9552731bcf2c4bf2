"""The stream's sinks over time: an epoch that stops and is repeated, and the rewriting of many epochs into days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.quality import union_all
from plumbline.plans.star.base import Query
from plumbline.plans.star.events import VERDICT_SQL, event_messages
from plumbline.session import fresh_path
from plumbline.sources import files
from plumbline.sources.messages import file_messages
from plumbline.streaming import contract
from plumbline.streaming.router import SCHEMAS, Committed, RouteSinks, deliver, start_router

EPOCHS, PER_DAY = 50, 10
FIRST_DAY = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc)


class StoppingSinks(RouteSinks):
    """Loses its place between the second and the third sink."""

    def write(self, name: str, epoch: int, rows: DataFrame) -> str:
        if name == "quarantine":
            raise OSError("stopped between two sinks")
        return super().write(name, epoch, rows)


def _of_message(rows: DataFrame, name: str) -> DataFrame:
    """(run, id) of the messages in one of the outputs."""
    if name == "dead_letter":
        rows = rows.select(F.from_json("value", SCHEMAS["quarantine"]).alias("r")).select("r.*")
    return rows.select(F.col("simulation_run_id").alias("run"), F.col("pubsub_message_id").alias("id") if name != "typed" else F.col("event_id").alias("id"))


def _seen(now: Committed, moment: str) -> DataFrame:
    counts = F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_messages")
    return union_all(_of_message(now.read(name), name).groupBy("run").agg(*counts).withColumns({"output": F.lit(name), "moment": F.lit(moment)}) for name in SCHEMAS)


def epoch_commit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and messages in each output while an epoch is half written, and after it was repeated and another one came.

    The stream is drained three times over a growing folder. The second time it stops between two sinks; it then starts
    again from its checkpoint, which repeats that epoch. The third part brings the second part's messages once more.
    """
    folder = fresh_path(spark, "epoch-commit")
    messages, part = event_messages(spark, sf), F.col("message_id").cast("long") % 3
    sinks = RouteSinks(f"{folder}/out")

    def arrive(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{folder}/in")

    def drain(to: RouteSinks) -> bool:
        query = start_router(file_messages(spark, f"{folder}/in"), to, f"{folder}/checkpoint", drain=True)
        try:
            query.awaitTermination()
        except Exception as e:
            if "stopped between two sinks" not in str(e):
                raise
            return False
        return True

    arrive(messages.where(part == 0))
    drain(sinks)
    arrive(messages.where(part == 1))
    if drain(StoppingSinks(sinks.base)):
        raise AssertionError("the stream was to stop")
    stopped = sinks.committed(spark)
    drain(sinks)
    arrive(messages.where(part > 0))
    drain(sinks)
    return _seen(stopped, "stopped").unionByName(_seen(sinks.committed(spark), "repeated"))


_COMMIT_PART = """SELECT run, count(*) AS n, count(*) AS n_messages, '{output}' AS output, '{moment}' AS moment FROM verdict WHERE {which} GROUP BY 1"""
_OUTPUTS = {"raw": "true", "typed": "error_code IS NULL", "quarantine": "error_code IS NOT NULL", "dead_letter": "error_code IS NOT NULL"}
COMMIT_SQL = f"WITH {VERDICT_SQL}\n" + "\nUNION ALL ".join(
    _COMMIT_PART.format(output=output, moment=moment, which=f"{which} AND {part}")
    for output, which in _OUTPUTS.items()
    for moment, part in (("stopped", "event_id % 3 = 0"), ("repeated", "true"))
)


def _content(rows: DataFrame) -> DataFrame:
    """The number of rows, and a sum of their hashes, which no order or place changes."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("content"))


def epoch_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty epochs over five days before and after they were rewritten into days, and for a reader that had opened them.

    The old folders are cleared at the end; the reader that opened them looks before.
    """
    folder = fresh_path(spark, "epoch-compaction")
    judged = contract.judge(event_messages(spark, sf))
    judged.withColumn("epoch", F.col("message_id").cast("long") % EPOCHS).hint("rebalance", "epoch").write.partitionBy("epoch").parquet(f"{folder}/in")
    sinks = RouteSinks(f"{folder}/out")
    for epoch in range(EPOCHS):
        rows = spark.read.schema(judged.schema).parquet(f"{folder}/in/epoch={epoch}")
        deliver(rows, epoch, sinks, FIRST_DAY + dt.timedelta(days=epoch // PER_DAY))
    opened = sinks.committed(spark)
    before = {name: _content(opened.read(name)).first() for name in SCHEMAS}
    sinks.compact(spark)
    kept_open = {name: _content(opened.read(name)).first() for name in SCHEMAS}
    now = sinks.committed(spark)
    sinks.vacuum(spark, older_than=dt.timedelta(0), kept=1)
    out = []
    for name in SCHEMAS:
        on_disk = sum(len(files.listed(spark, f"{sinks.path(name)}/{e}")) for e in files.listed(spark, sinks.path(name)))
        after = _content(now.read(name)).select(
            F.lit(name).alias("output"), F.col("n").alias("n_after"), F.lit(before[name].n).alias("n_before"), F.lit(kept_open[name].n).alias("n_open"),
            (F.col("content") == F.lit(before[name].content)).alias("same_rows"), F.lit(len(opened.manifest.folders(name))).alias("folders_before"),
            F.lit(len(now.manifest.folders(name))).alias("folders_after"), F.lit(on_disk).alias("folders_on_disk"),
        )
        out.append(after)
    return union_all(out)


COMPACTION_SQL = f"WITH {VERDICT_SQL}\n" + "\nUNION ALL ".join(
    f"""SELECT '{output}' AS output, count(*) AS n_after, count(*) AS n_before, count(*) AS n_open, true AS same_rows, {EPOCHS} AS folders_before,
  {EPOCHS // PER_DAY} AS folders_after, {EPOCHS // PER_DAY} AS folders_on_disk FROM verdict WHERE {which}"""
    for output, which in _OUTPUTS.items()
)

QUERIES: dict[str, Query] = {
    "epoch_commit": Query(epoch_commit, COMMIT_SQL),
    "epoch_compaction": Query(epoch_compaction, COMPACTION_SQL),
}
