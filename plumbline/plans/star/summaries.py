"""Counts and quantiles of long spans from summaries stored for short ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.bitmaps import bitmaps, distinct_from_bitmaps
from plumbline.operators.observe import millis_between
from plumbline.operators.quality import union_all
from plumbline.operators.sketches import summarised, united
from plumbline.plans.star.base import Query, table
from plumbline.plans.star.events import TIMED, VERDICT_SQL, judged_events, typed_events
from plumbline.session import stage

PERIODS = ("week", "month")
QUANTILES = (0.5, 0.95, 0.99)


def entities_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Events and distinct entities per type, week and month, put together from daily summaries.

    The estimates are held against exact counts: ``within`` says that they are off by 2 % at most.
    """
    read = ["event_id", "event_type", "event_time", "entity_id"]
    typed = typed_events(judged_events(spark, sf, typed=read), [*read, "processing_timestamp"])
    daily = stage(summarised(typed, [F.to_date("event_time").alias("day"), "event_type"], {"entities": "entity_id"}), "daily-summaries")
    out = []
    for period in PERIODS:
        of = lambda c: F.date_format(F.date_trunc(period, c), "yyyy-MM-dd").alias("start")  # noqa: B023, E731
        estimated = united(daily, [of("day"), "event_type"], ["entities"])
        exact = typed.groupBy(of("event_time"), "event_type").agg(F.countDistinct("entity_id").alias("exact"))
        within = F.abs(F.col("entities") - F.col("exact")) <= 0.02 * F.col("exact")
        both = estimated.join(exact, ["start", "event_type"])
        out.append(both.select(F.lit(period).alias("period"), "start", "event_type", F.col("n").alias("n_events"), within.alias("within")))
    return union_all(out)


PERIODS_SQL = f"WITH {VERDICT_SQL}\n" + "\nUNION ALL ".join(
    f"""SELECT '{p}' AS period, strftime(date_trunc('{p}', event_time), '%Y-%m-%d') AS start, kind AS event_type, count(*) AS n_events, true AS within
FROM valid GROUP BY ALL""" for p in PERIODS
)


def latency_from_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Latency quantiles per event type over all days, put together from hourly summaries per run.

    Each is held against the rows: the share of events at or below it is off by one point in a hundred at most.
    """
    typed = typed_events(judged_events(spark, sf, typed=TIMED), TIMED)
    timed = typed.select("simulation_run_id", "event_type", "event_time", millis_between("event_time", "processing_timestamp").alias("total"))
    hour = F.date_trunc("hour", "event_time").alias("hour")
    hourly = stage(summarised(timed, ["simulation_run_id", hour, "event_type"], quantiles={"total": "total"}), "hourly-summaries")
    names = [f"total_p{round(q * 100)}" for q in QUANTILES]
    estimated = united(hourly, ["event_type"], quantiles={"total": QUANTILES})
    rows = timed.join(estimated.select(F.col("event_type").alias("of"), *names), F.col("event_type") == F.col("of"))
    shares = [F.avg((F.col("total") <= F.col(n)).cast("double")).alias(f"{n}_upto") for n in names]
    shares += [F.avg((F.col("total") < F.col(n)).cast("double")).alias(f"{n}_below") for n in names]
    held = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), *shares)
    near = [((F.col(f"{n}_upto") >= q - 0.01) & (F.col(f"{n}_below") <= q + 0.01)).alias(f"p{round(q * 100)}_within") for n, q in zip(names, QUANTILES)]
    return held.select("event_type", "n", *near)


HOURS_SQL = f"""WITH {VERDICT_SQL}
SELECT kind AS event_type, count(*) AS n, true AS p50_within, true AS p95_within, true AS p99_within FROM valid GROUP BY 1"""

COUNTED = ("l_orderkey", "l_partkey", "l_suppkey")


def ids_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct orders, parts and suppliers of the line items per quarter and year, from one set of monthly bitmaps; exact."""
    month = F.trunc("l_shipdate", "month").alias("month")
    monthly = stage(bitmaps(table(spark, sf, "lineitem"), [month], COUNTED), "monthly-bitmaps")
    out = []
    for period in ("quarter", "year"):
        start = F.date_format(F.date_trunc(period, "month"), "yyyy-MM-dd").alias("start")
        out.append(distinct_from_bitmaps(monthly, [start]).select(F.lit(period).alias("period"), "start", "counted", "n", "n_distinct"))
    return union_all(out)


IDS_SQL = "\nUNION ALL ".join(
    f"""SELECT '{p}' AS period, strftime(date_trunc('{p}', l_shipdate), '%Y-%m-%d') AS start, '{c}' AS counted, count(*) AS n, count(DISTINCT {c}) AS n_distinct
FROM lineitem GROUP BY ALL""" for p in ("quarter", "year") for c in COUNTED
)

QUERIES: dict[str, Query] = {
    "ids_by_period": Query(ids_by_period, IDS_SQL),
    "entities_by_period": Query(entities_by_period, PERIODS_SQL),
    "latency_from_hours": Query(latency_from_hours, HOURS_SQL),
}
