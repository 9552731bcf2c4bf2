"""Batch run: snapshots -> cleaned tables and quarantine -> integrations -> products -> checks -> history."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import observe
from plumbline.operators.checks import gate
from plumbline.operators.quality import union_all
from plumbline.plans.literacy import schemas as s
from plumbline.plans.literacy import suites
from plumbline.plans.literacy.gold import PRODUCTS
from plumbline.plans.literacy.silver import INTEGRATIONS, QUARANTINE, SOURCE_PLANS, Product, quarantine
from plumbline.session import stage
from plumbline.sources.snapshots import read_snapshot, write_snapshot
from plumbline.sources.tables import Store, append_if_absent


def ingest(
    spark: SparkSession, sources: Mapping[str, DataFrame], bronze: str, at: dt.datetime, batch_id: str, origin: str
) -> None:
    """Snapshot every source under one batch id."""
    for name, df in sources.items():
        write_snapshot(df, bronze, name, at, batch_id, f"{origin}.{name}")


def read_sources(spark: SparkSession, bronze: str, date: dt.date, batch_id: str) -> dict[str, DataFrame]:
    return {name: read_snapshot(spark, bronze, name, date, batch_id, schema) for name, schema in s.SOURCES.items()}


def literal_time(at: dt.datetime):
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def build_silver(store: Store, sources: Mapping[str, DataFrame], as_of: dt.datetime) -> dict[str, DataFrame]:
    """Each source is tagged once into a staged table that feeds both its clean rows and the quarantine."""
    at = literal_time(as_of)
    tables: dict[str, DataFrame] = {}
    tagged: dict[str, DataFrame] = {}
    codes = None
    for name, plan in SOURCE_PLANS.items():
        tagged[name] = stage(plan.tagged(sources[name], codes), f"tagged-{name}")
        tables[plan.table] = store.replace(plan.table, plan.clean(tagged[name], at), plan.partition, plan.cluster)
        if name == "dicionario":
            codes = tables[plan.table]
    tables[QUARANTINE] = store.replace(
        QUARANTINE, quarantine(tagged, at), ["ingestion_date"], ["source_table", "batch_id"]
    )
    return _build(store, INTEGRATIONS, tables, as_of)


def build_gold(store: Store, tables: Mapping[str, DataFrame], as_of: dt.datetime) -> dict[str, DataFrame]:
    return _build(store, PRODUCTS, tables, as_of)


def _build(store: Store, products: Mapping[str, Product], tables: Mapping[str, DataFrame], as_of: dt.datetime):
    at = literal_time(as_of)
    out = dict(tables)
    for name, product in products.items():
        out[name] = store.replace(name, product.build(out, at), product.partition, product.cluster)
    return out


def run_batch(
    spark: SparkSession, bronze: str, warehouse: str, date: dt.date, batch_id: str, as_of: dt.datetime
) -> dict[str, DataFrame]:
    """Build all layers of one batch into a new run folder, check them, and publish when every check holds.

    The folder's name ends with an attempt of its own, so that a run that broke off can be repeated as it was.
    """
    store = Store(spark, warehouse, f"{batch_id}-{as_of:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")
    sources = read_sources(spark, bronze, date, batch_id)
    tables = build_silver(store, sources, as_of)
    at = literal_time(as_of)
    tables["latest_silver_validation"] = store.replace(
        "latest_silver_validation", suites.silver_checks(spark, sources, tables, date, batch_id, at)
    )
    gate(tables["latest_silver_validation"])
    tables = build_gold(store, tables, as_of)
    tables["latest_gold_validation"] = store.replace(
        "latest_gold_validation", suites.gold_checks(spark, tables, at)
    )
    gate(tables["latest_gold_validation"])
    store.publish()
    return tables


SILVER_KEYS = ["batch_id", "check_type", "object_name", "executed_at"]
GOLD_KEYS = ["check_type", "object_name", "executed_at"]
STREAMING_KEYS = ["simulation_run_id", "check_type", "object_name", "executed_at"]


def record_operations(
    spark: SparkSession, ops: str, silver: DataFrame, gold: DataFrame, streaming: DataFrame,
    raw: DataFrame, typed: DataFrame, jobs: DataFrame, collected_at: dt.datetime,
) -> dict[str, DataFrame]:
    """Append check histories and health, then derive failures, latency and usage."""
    at = literal_time(collected_at)

    def history(name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        return append_if_absent(spark, f"{ops}/{name}", rows, keys, "executed_at")

    silver_h = history("silver_validation_history", silver, SILVER_KEYS)
    gold_h = history("gold_validation_history", gold, GOLD_KEYS)
    streaming_h = history("streaming_validation_history", streaming, STREAMING_KEYS)
    health = union_all(
        [
            observe.health_of(silver, "silver_batch", at, "batch_id"),
            observe.health_of(gold, "gold_batch", at),
            observe.health_of(streaming, "streaming", at, "simulation_run_id"),
        ]
    )
    health_h = history("pipeline_health_history", health, observe.HEALTH_KEYS)
    daily = observe.usage_daily(jobs, at, at)
    return {
        "silver_validation_history": silver_h,
        "gold_validation_history": gold_h,
        "streaming_validation_history": streaming_h,
        "pipeline_health_history": health_h,
        "pipeline_health_latest": observe.latest_health(health_h),
        "quality_failures": observe.failure_feed(
            {
                "silver": (silver_h, F.col("batch_id")),
                "gold": (gold_h, observe.stamped_id("gold", "executed_at")),
                "streaming": (streaming_h, F.col("simulation_run_id")),
            }
        ),
        "streaming_latency_summary": observe.latency_summary(typed, raw, at),
        "bigquery_usage_daily": daily,
        "bigquery_usage_summary": observe.usage_summary(daily),
    }
