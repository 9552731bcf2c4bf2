"""Observability over check rows, event tables and job logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import col
from plumbline.operators.checks import OK
from plumbline.operators.dedup import latest_per_key
from plumbline.operators.quality import union_all

# Fixed output values.
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
UNKNOWN_STATEMENT = "UNKNOWN"
USAGE_DAYS = 180

HEALTH_KEYS = ["pipeline_name", "run_id", "executed_at"]


def stamped_id(prefix: str, at: Column | str) -> Column:
    """``prefix_YYYYMMDDTHHMMSSZ`` in the (UTC) session zone."""
    return F.concat(F.lit(prefix + "_"), F.date_format(col(at), "yyyyMMdd'T'HHmmss'Z'"))


def health_of(checks: DataFrame, pipeline: str, collected_at: Column, run: str | None = None) -> DataFrame:
    """Health rows of one pipeline: per run, or one global row named after its newest check time."""
    failed = F.count_if(F.col("status") != OK)
    numbers = [
        F.max("executed_at").alias("executed_at"),
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if(F.col("status") == OK).alias("checks_ok"),
        failed.alias("checks_failed"),
        F.when(failed == 0, SUCCEEDED).otherwise(FAILED).alias("pipeline_status"),
    ]
    if run is None:
        # A global aggregate yields one row even without checks; its run id is then NULL.
        out = checks.agg(*numbers).withColumn("run_id", stamped_id("gold", "executed_at"))
    else:
        out = checks.groupBy(F.col(run).alias("run_id")).agg(*numbers)
    return out.select(
        F.lit(pipeline).alias("pipeline_name"),
        "run_id",
        "executed_at",
        "checks_total",
        "checks_ok",
        "checks_failed",
        "pipeline_status",
        collected_at.alias("collected_at"),
    )


def latest_health(history: DataFrame) -> DataFrame:
    return latest_per_key(history, ["pipeline_name"], ["executed_at", "collected_at"])


def failure_feed(histories: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Failed checks of several histories: ``{layer: (history, run id)}``."""
    return union_all(
        history.filter(F.col("status") != OK).select(
            F.lit(layer).alias("pipeline_layer"),
            run.alias("run_id"),
            "check_type",
            "object_name",
            "expected_value",
            "actual_value",
            "status",
            "executed_at",
        )
        for layer, (history, run) in histories.items()
    )


def millis_between(start: str, end: str) -> Column:
    """Whole milliseconds from start to end, truncated towards zero."""
    return F.timestamp_diff("MILLISECOND", F.col(start), F.col(end))


def latency_summary(
    typed: DataFrame, raw: DataFrame, collected_at: Column, run: str = "simulation_run_id", publish: str = "pubsub_publish_time"
) -> DataFrame:
    """End-to-end and processing latency per run and event type.

    The raw side is reduced to the earliest publish time per event first, so redelivered messages do not
    multiply rows. The percentile is a mergeable sketch (rank error 1/10000) that returns an observed value.
    """
    published = (
        raw.filter(F.col(run).isNotNull() & F.col("event_id").isNotNull())
        .groupBy(run, "event_id")
        .agg(F.min(publish).alias(publish))
    )
    timed = typed.select(run, "event_id", "event_type", "event_time", "processing_timestamp").join(
        published, [run, "event_id"], "left"
    )
    timed = timed.withColumns(
        {
            "__total": millis_between("event_time", "processing_timestamp"),
            "__processing": millis_between(publish, "processing_timestamp"),
        }
    )
    return timed.groupBy(run, "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count(publish).alias("events_with_publish_time"),
        F.count_if(F.col(publish).isNull()).alias("events_without_publish_time"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
        F.round(F.avg("__total") / 1000, 3).alias("avg_end_to_end_latency_seconds"),
        F.round(F.percentile_approx("__total", 0.95, 10000) / 1000, 3).alias("p95_end_to_end_latency_seconds"),
        F.round(F.max("__total") / 1000, 3).alias("max_end_to_end_latency_seconds"),
        F.round(F.avg("__processing") / 1000, 3).alias("avg_processing_latency_seconds"),
        F.first(collected_at).alias("collected_at"),
    )


def _binary_unit(bytes_column: Column, power: int, digits: int) -> Column:
    return F.round(bytes_column / F.pow(F.lit(1024.0), F.lit(power)), digits)


def usage_daily(jobs: DataFrame, as_of: Column, collected_at: Column) -> DataFrame:
    """Finished query jobs of the last 180 days rolled up by day, user and statement type; scripts excluded."""
    kept = jobs.filter(
        (F.col("creation_time") >= as_of - F.expr(f"interval {USAGE_DAYS} days"))
        & (F.col("job_type") == "QUERY")
        & (F.col("state") == "DONE")
        & (F.col("statement_type").isNull() | (F.col("statement_type") != "SCRIPT"))
    )

    def total(name: str) -> Column:
        return F.sum(F.coalesce(F.col(name), F.lit(0)))

    return kept.groupBy(
        F.to_date("creation_time").alias("usage_date"),
        "user_email",
        F.coalesce("statement_type", F.lit(UNKNOWN_STATEMENT)).alias("statement_type"),
    ).agg(
        F.count(F.lit(1)).alias("query_jobs"),
        F.count_if(F.col("error_result").isNotNull()).alias("failed_jobs"),
        total("total_bytes_processed").alias("total_bytes_processed"),
        total("total_bytes_billed").alias("total_bytes_billed"),
        _binary_unit(total("total_bytes_billed"), 4, 8).alias("total_tib_billed"),
        total("total_slot_ms").alias("total_slot_ms"),
        F.count_if(F.coalesce("cache_hit", F.lit(False))).alias("cache_hit_jobs"),
        F.first(collected_at).alias("collected_at"),
    )


_USAGE_SUMS = ["query_jobs", "failed_jobs", "total_bytes_processed", "total_bytes_billed", "total_slot_ms", "cache_hit_jobs"]


def usage_summary(daily: DataFrame) -> DataFrame:
    """The whole usage table in one row; NULL sums when it is empty."""
    return daily.agg(
        F.min("usage_date").alias("first_usage_date"),
        F.max("usage_date").alias("last_usage_date"),
        *[F.sum(c).alias(c) for c in _USAGE_SUMS],
        _binary_unit(F.sum("total_bytes_billed"), 4, 8).alias("total_tib_billed"),
    )


def usage_by_day(daily: DataFrame) -> DataFrame:
    return daily.groupBy("usage_date").agg(
        *[F.sum(c).alias(c) for c in _USAGE_SUMS],
        _binary_unit(F.sum("total_bytes_billed"), 3, 4).alias("total_gib_billed"),
        _binary_unit(F.sum("total_bytes_billed"), 4, 8).alias("total_tib_billed"),
    )


def empty_health(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "pipeline_name string, run_id string, executed_at timestamp, checks_total long, checks_ok long,"
        " checks_failed long, pipeline_status string, collected_at timestamp",
    )
