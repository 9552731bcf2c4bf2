"""The operations path: histories, health, failures, usage, their checks, and the dashboard views and checks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from literacy_data import AT, BATCH, clean_sources
from plumbline.operators import observe
from plumbline.operators.checks import CheckFailure, gate
from plumbline.plans.literacy import dashboards, runner, suites
from plumbline.sources.tables import register_views
from plumbline.streaming import router
from plumbline.streaming.views import event_summary
from test_streaming import BROKEN, MESSAGE_SCHEMA, RECEIVED, RUN, RUN_MESSAGES, VALID, at

LATER = RECEIVED + dt.timedelta(hours=1)
JOB_SCHEMA = (
    "creation_time timestamp, user_email string, statement_type string, job_type string, state string, error_result string,"
    " total_bytes_processed long, total_bytes_billed long, total_slot_ms long, cache_hit boolean"
)
JOBS = [
    (RECEIVED - dt.timedelta(days=1), "a@x", "SELECT", "QUERY", "DONE", None, 10, 20, 30, True),
    (RECEIVED - dt.timedelta(days=1), "a@x", "SELECT", "QUERY", "DONE", "bad", None, 5, 1, False),
    (RECEIVED - dt.timedelta(days=400), "a@x", "SELECT", "QUERY", "DONE", None, 1, 1, 1, False),
    (RECEIVED, "b@x", "SCRIPT", "QUERY", "DONE", None, 1, 1, 1, False),
]


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("operations"))
    runner.ingest(spark, clean_sources(spark), f"{base}/bronze", AT, BATCH, "origin")
    tables = runner.run_batch(spark, f"{base}/bronze", f"{base}/wh", AT.date(), BATCH, AT)
    sinks = router.RouteSinks(f"{base}/stream")
    router.route_batch(spark.createDataFrame(RUN_MESSAGES, MESSAGE_SCHEMA), 0, sinks, at())
    return base, tables, sinks


def record(spark, layers, folder, streaming_total=VALID + BROKEN, collected_at=RECEIVED):
    base, tables, sinks = layers
    raw, typed = sinks.raw(spark), sinks.typed(spark)
    streaming = suites.streaming_checks(spark, raw, typed, sinks.rejected(spark), RUN, (streaming_total, VALID, BROKEN), at())
    return runner.record_operations(
        spark, f"{base}/{folder}", tables["latest_silver_validation"], tables["latest_gold_validation"], streaming, raw, typed,
        spark.createDataFrame(JOBS, JOB_SCHEMA), collected_at,
    )


def by_name(rows):
    return {(r.check_type, r.object_name): r.status for r in rows.collect()}


def test_operations_recorded_twice_are_recorded_once(spark, layers):
    first = {name: df.count() for name, df in record(spark, layers, "ops").items()}
    tables = record(spark, layers, "ops", collected_at=LATER)
    again = {name: df.count() for name, df in tables.items()}
    assert again["silver_validation_history"] == first["silver_validation_history"] == 13
    assert again["gold_validation_history"] == first["gold_validation_history"] == 19
    assert again["streaming_validation_history"] == first["streaming_validation_history"] == 8
    assert again["pipeline_health_latest"] == 3 and again["quality_failures"] == 0
    usage = tables["bigquery_usage_daily"].collect()
    assert [(r.query_jobs, r.failed_jobs, r.total_bytes_billed, r.cache_hit_jobs) for r in usage] == [(2, 1, 25, 1)]
    checks = by_name(suites.operation_checks(spark, tables, at()))
    assert len(checks) == 11 and set(checks.values()) == {"OK"}


def test_a_failed_check_shows_in_health_failures_and_checks(spark, layers):
    tables = record(spark, layers, "broken", streaming_total=1)
    health = {r.pipeline_name: (r.pipeline_status, r.checks_failed) for r in tables["pipeline_health_latest"].collect()}
    assert sorted(n for _, n in health.values()) == [0, 0, 1]
    assert [r.object_name for r in tables["quality_failures"].collect()] == ["bronze_total_eventos"]
    checks = by_name(suites.operation_checks(spark, tables, at()))
    assert {k[1] for k, status in checks.items() if status == "FAIL"} == {"latest_pipeline_failures", "quality_failures"}
    with pytest.raises(CheckFailure):
        gate(suites.operation_checks(spark, tables, at()))


def test_dashboards_and_their_checks(spark, layers):
    _, products, sinks = layers
    raw, typed, rejected = sinks.raw(spark), sinks.typed(spark), sinks.rejected(spark)
    tables = {
        **products, **record(spark, layers, "shown"), "streaming_resumo": event_summary(typed),
        "streaming_raw": raw, "streaming_eventos": typed, "streaming_quarentena": rejected,
    }
    views = dashboards.dashboard_views(tables)
    assert len(views) == 6
    register_views(views)
    shown = spark.table("vw_dashboard_streaming").collect()
    assert {r.eventos_bronze_total_run for r in shown} == {VALID + BROKEN}
    assert {r.eventos_invalidos_total_run for r in shown} == {BROKEN} and sum(r.quantidade_eventos for r in shown) == VALID
    names = {r.pipeline_nome_exibicao for r in spark.table("vw_dashboard_operacao").collect()}
    assert len(names) == 3 and None not in names
    checks = by_name(suites.dashboard_checks(spark, tables, views, at()))
    assert len(checks) == 12 and set(checks.values()) == {"OK"}
    fewer = {**views, dashboards.DASHBOARDS["uf"]: views[dashboards.DASHBOARDS["uf"]].filter(F.lit(False))}
    failed = {k[1] for k, status in by_name(suites.dashboard_checks(spark, tables, fewer, at())).items() if status == "FAIL"}
    assert failed == {"vw_dashboard_uf"}


def test_empty_health_has_the_columns_of_health(spark):
    checks = spark.createDataFrame([("A", "x", 1, 1, "OK", RECEIVED)], "check_type string, object_name string, expected_value long, actual_value long, status string, executed_at timestamp")
    empty = observe.empty_health(spark)
    assert empty.count() == 0 and empty.columns == observe.health_of(checks, "p", at()).columns
