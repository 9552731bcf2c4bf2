"""Sustained threshold alerts over metric samples ``(series, ts, value)``; one plan for tables and streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlertPolicy:
    """Fires when the per-minute maximum stays above ``threshold`` for ``minutes`` minutes in a row."""

    name: str
    threshold: float
    minutes: int = 5


# The shipped policies.
POLICIES = (
    AlertPolicy("backlog", 100),
    AlertPolicy("oldest_unacked_message_age", 300),
    AlertPolicy("system_lag", 300),
)


def aligned(samples: DataFrame, delay: str | None = None) -> DataFrame:
    """Per-minute maximum of each series (combined map-side, so a chatty series sends one row per task)."""
    source = samples.withWatermark("ts", delay) if delay else samples
    return source.groupBy(F.window("ts", "1 minute"), "series").agg(F.max("value").alias("peak"))


def sustained_breaches(samples: DataFrame, policy: AlertPolicy, delay: str | None = None) -> DataFrame:
    """Every window of ``policy.minutes`` minutes whose minutes all have samples and all exceed the threshold."""
    minutes = aligned(samples, delay)
    windows = minutes.groupBy(
        F.window(F.window_time("window"), f"{policy.minutes} minutes", "1 minute").alias("span"), "series"
    ).agg(F.min("peak").alias("lowest_peak"), F.count(F.lit(1)).alias("minutes_seen"))
    return windows.filter(
        (F.col("lowest_peak") > policy.threshold) & (F.col("minutes_seen") == policy.minutes)
    ).select(
        F.lit(policy.name).alias("policy"), "series", F.col("span.start").alias("breach_start"),
        F.col("span.end").alias("breach_end"), "lowest_peak",
    )


def alert_episodes(samples: DataFrame, policy: AlertPolicy, delay: str | None = None) -> DataFrame:
    """One row for each stretch of minutes above the threshold, in a row and at least ``policy.minutes`` long.

    ``opened_at`` is the start of its first minute, ``closed_at`` the end of its last, ``peak`` its highest value. A
    minute without samples or at most at the threshold ends it. Minutes above it are joined by session windows, in
    tables and streams alike; a stream gives an episode out once the watermark has passed its end.
    """
    above = aligned(samples, delay).filter(F.col("peak") > policy.threshold)
    # Minutes in a row are sixty seconds apart, others at least twice that.
    stretch = F.session_window(F.window_time("window"), "90 seconds").alias("stretch")
    episodes = above.groupBy(stretch, "series").agg(
        F.min("window.start").alias("opened_at"), F.max("window.end").alias("closed_at"), F.max("peak").alias("peak"), F.count(F.lit(1)).alias("minutes")
    )
    long_enough = episodes.filter(F.col("minutes") >= policy.minutes)
    return long_enough.select(F.lit(policy.name).alias("policy"), "series", "opened_at", "closed_at", "minutes", "peak")
