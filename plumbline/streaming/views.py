"""Event summary and latest events, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.dedup import latest_per_key

_ENTITY = ["event_type", "entity_type", "entity_id"]


def _means() -> list:
    return [
        F.avg(c).alias(f"media_{c}") for c in ("taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao")
    ]


def event_summary(typed: DataFrame) -> DataFrame:
    """Events, distinct entities, mean measures and last update per day, run, event type and entity type."""
    return typed.groupBy(
        F.to_date("event_time").alias("data_evento"), "simulation_run_id", "event_type", "entity_type"
    ).agg(
        F.count(F.lit(1)).alias("quantidade_eventos"),
        F.countDistinct("entity_id").alias("quantidade_entidades"),
        *_means(),
        F.max("processing_timestamp").alias("ultima_atualizacao"),
    )


def latest_events(typed: DataFrame) -> DataFrame:
    """Newest event per type and entity, by event time, then processing time, then the remaining columns."""
    return latest_per_key(typed, _ENTITY, ["event_time", "processing_timestamp"])


def event_summary_stream(typed: DataFrame, delay: str = "1 day") -> DataFrame:
    """The summary over daily event-time windows; distinct entities are estimated, as streams cannot count them."""
    return (
        typed.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day").alias("w"), "simulation_run_id", "event_type", "entity_type")
        .agg(
            F.count(F.lit(1)).alias("quantidade_eventos"),
            F.approx_count_distinct("entity_id").alias("quantidade_entidades"),
            *_means(),
            F.max("processing_timestamp").alias("ultima_atualizacao"),
        )
        .select(F.to_date("w.start").alias("data_evento"), "*")
        .drop("w")
    )


def latest_events_stream(typed: DataFrame) -> DataFrame:
    """Newest event per entity as running state (update mode); partial aggregation thins hot entities first."""
    rest = [c for c in typed.columns if c not in _ENTITY]
    newest = F.max_by(F.struct(*rest), F.struct("event_time", "processing_timestamp", "event_id")).alias("e")
    return typed.groupBy(*_ENTITY).agg(newest).select(*_ENTITY, "e.*")
