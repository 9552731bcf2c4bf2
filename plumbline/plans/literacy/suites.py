"""The check suites of the cleaned, product, streaming, operation and dashboard layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numeric import outside
from plumbline.operators.checks import (
    Check, count_where, distinct_count, has_rows, repeated_keys, row_count, suite, surplus_rows,
)
from plumbline.operators.observe import SUCCEEDED
from plumbline.plans.literacy import schemas as s
from plumbline.plans.literacy.dashboards import DASHBOARDS
from plumbline.plans.literacy.gold import GAP, RESULT, TARGET
from plumbline.plans.literacy.silver import QUARANTINE, SOURCE_PLANS, public_state_results
from plumbline.streaming.contract import EVENT_TYPES

Tables = Mapping[str, DataFrame]
RECONCILIATION, UNIQUENESS, VALIDITY, CONSISTENCY = "RECONCILIATION", "UNIQUENESS", "VALIDITY", "CONSISTENCY"


def silver_checks(
    spark: SparkSession, sources: Tables, t: Tables, date, batch_id: str, executed_at: Column
) -> DataFrame:
    """Source rows × expansion = clean + quarantined rows; unique keys; rates and targets in range."""
    checks = []
    rejected = t[QUARANTINE].filter((F.col("ingestion_date") == F.lit(date)) & (F.col("batch_id") == batch_id))
    for name, plan in SOURCE_PLANS.items():
        checks.append(
            Check(
                RECONCILIATION, name, [row_count(sources[name], plan.expansion)],
                [row_count(t[plan.table]), count_where(rejected, F.col("source_table") == name)],
            )
        )
    for table in ("alunos", "resultado_municipio", "resultado_uf"):
        key = next(p.key for p in SOURCE_PLANS.values() if p.table == table)
        checks.append(Check(UNIQUENESS, table, [0], [repeated_keys(t[table], key)]))
    for table in ("resultado_municipio", "resultado_uf"):
        bad = outside("taxa_alfabetizacao", 0, 100)
        checks.append(Check(VALIDITY, f"taxas_{table}", [0], [count_where(t[table], bad)]))
    targets = [count_where(t[n], outside("meta_alfabetizacao", 0, 100)) for n in ("meta_brasil", "meta_uf", "meta_municipio")]
    checks.append(Check(VALIDITY, "metas", [0], targets))
    return suite(
        spark, checks, executed_at, {"ingestion_date": F.lit(date).cast("date"), "batch_id": F.lit(batch_id)}
    )


def _contradicts_status() -> Column:
    """A target status that disagrees with the numbers beside it."""
    no_result, no_target, reached, missed = s.STATUS_LABELS
    status = F.col("status_meta")
    return (
        ((status == reached) & (F.col(GAP) < 0))
        | ((status == missed) & (F.col(GAP) >= 0))
        | ((status == no_result) & F.col(RESULT).isNotNull())
        | ((status == no_target) & F.col(TARGET).isNotNull())
    )


def gold_checks(spark: SparkSession, t: Tables, executed_at: Column) -> DataFrame:
    kpis = ("kpi_brasil", "kpi_uf", "kpi_municipio")
    years = reduce(lambda a, b: a.union(b), (t[k].select("ano") for k in kpis)).distinct()
    statuses = [row_count(t[n].select("ano", "integration_status").distinct()) for n in ("int_municipio_meta", "int_uf_meta")]
    cells = t["cobertura_integracao"]
    uneven = (
        cells.groupBy("nivel_territorial", "ano")
        .agg(F.sum("percentual_cobertura").alias("total"))
        .filter(F.abs(F.col("total") - 100) > 0.0001)
    )
    checks = [
        Check(RECONCILIATION, "kpi_brasil", [row_count(t["meta_brasil"].select("ano", "rede_normalizada").distinct())],
              [row_count(t["kpi_brasil"])]),
        Check(RECONCILIATION, "kpi_uf", [row_count(t["int_uf_meta"])], [row_count(t["kpi_uf"])]),
        Check(RECONCILIATION, "kpi_municipio", [row_count(t["int_municipio_meta"])], [row_count(t["kpi_municipio"])]),
        Check(RECONCILIATION, "cobertura_integracao", statuses, [row_count(cells)]),
        Check(RECONCILIATION, "distribuicao_niveis_uf",
              [row_count(public_state_results(t), len(s.LEVEL_COLUMNS))], [row_count(t["distribuicao_niveis_uf"])]),
        Check(RECONCILIATION, "resumo_executivo", [row_count(years)], [row_count(t["resumo_executivo"])]),
        Check(RECONCILIATION, "features_modelo_municipio", [row_count(t["kpi_municipio"])],
              [row_count(t["features_modelo_municipio"])]),
        Check(UNIQUENESS, "kpi_brasil", [0], [repeated_keys(t["kpi_brasil"], ["ano", "rede_normalizada"])]),
        Check(UNIQUENESS, "kpi_uf", [0], [repeated_keys(t["kpi_uf"], ["ano", "sigla_uf"])]),
        Check(UNIQUENESS, "kpi_municipio", [0], [repeated_keys(t["kpi_municipio"], ["ano", "id_municipio"])]),
        Check(UNIQUENESS, "cobertura_integracao", [0],
              [repeated_keys(cells, ["nivel_territorial", "ano", "integration_status"])]),
        Check(VALIDITY, "taxas_gold", [0], [count_where(t[k], outside(RESULT, 0, 100)) for k in kpis]),
        Check(VALIDITY, "participacao_gold", [0],
              [count_where(t[k], outside("percentual_participacao", 0, 100)) for k in kpis]),
        Check(VALIDITY, "percentual_cobertura", [0], [count_where(cells, outside("percentual_cobertura", 0, 100))]),
        Check(CONSISTENCY, "soma_percentual_cobertura", [0], [row_count(uneven)]),
        Check(CONSISTENCY, "features_target_ano", [0],
              [count_where(t["features_modelo_municipio"],
                           F.col("possui_target_ano_seguinte") & (F.col("target_ano") != F.col("ano") + 1))]),
    ]
    checks += [
        Check(CONSISTENCY, f"status_meta_{k.removeprefix('kpi_')}", [0], [count_where(t[k], _contradicts_status())])
        for k in kpis
    ]
    return suite(spark, checks, executed_at)


def streaming_checks(
    spark: SparkSession, raw: DataFrame, typed: DataFrame, rejected: DataFrame, run_id: str,
    expected: tuple[int, int, int], executed_at: Column,
) -> DataFrame:
    """Checks of one run; ``expected`` is (total, valid, invalid)."""
    raw, typed, rejected = (df.filter(F.col("simulation_run_id") == run_id) for df in (raw, typed, rejected))
    required = ["event_id", "event_type", "event_time", "entity_type", "entity_id", "source"]
    percentages = ["taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao"]

    def any_of(conditions: Iterable[Column]) -> Column:
        return reduce(lambda a, b: a | b, (F.coalesce(x, F.lit(False)) for x in conditions))

    total, valid, invalid = expected
    checks = [
        Check(RECONCILIATION, "bronze_total_eventos", [total], [row_count(raw)]),
        Check(RECONCILIATION, "silver_eventos_validos", [valid], [distinct_count(typed, "event_id")]),
        Check(RECONCILIATION, "quarentena_eventos_invalidos", [invalid], [distinct_count(rejected, "event_id")]),
        Check(UNIQUENESS, "silver_event_id", [0], [surplus_rows(typed, "event_id")]),
        Check(VALIDITY, "silver_campos_obrigatorios", [0], [count_where(typed, any_of(F.col(n).isNull() for n in required))]),
        Check(VALIDITY, "silver_tipos_evento", [0], [count_where(typed, ~F.col("event_type").isin(list(EVENT_TYPES)))]),
        Check(VALIDITY, "silver_percentuais", [0], [count_where(typed, any_of(outside(p, 0, 100) for p in percentages))]),
        Check(CONSISTENCY, "quarentena_com_motivo", [0],
              [count_where(rejected, F.col("error_code").isNull() | F.col("error_message").isNull())]),
    ]
    return suite(spark, checks, executed_at, {"simulation_run_id": F.lit(run_id)})


def _negatives(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns))


def operation_checks(spark: SparkSession, t: Tables, executed_at: Column) -> DataFrame:
    latency, usage, health = t["streaming_latency_summary"], t["bigquery_usage_daily"], t["pipeline_health_latest"]
    checks = [
        Check(RECONCILIATION, name, [1], [has_rows(t[name])])
        for name in (
            "silver_validation_history", "gold_validation_history", "streaming_validation_history",
            "streaming_latency_summary", "bigquery_usage_daily",
        )
    ]
    checks += [
        Check(RECONCILIATION, "pipeline_health_latest", [3], [row_count(health)]),
        Check(CONSISTENCY, "latest_pipeline_failures", [0], [count_where(health, F.col("pipeline_status") != SUCCEEDED)]),
        Check(CONSISTENCY, "quality_failures", [0], [row_count(t["quality_failures"])]),
        Check(VALIDITY, "negative_streaming_latency", [0],
              [count_where(latency, _negatives(["avg_end_to_end_latency_seconds", "p95_end_to_end_latency_seconds",
                                                "max_end_to_end_latency_seconds", "avg_processing_latency_seconds"]))]),
        Check(CONSISTENCY, "streaming_publish_time_match", [0],
              [latency.agg(F.coalesce(F.sum("events_without_publish_time"), F.lit(0)).alias("n"))]),
        Check(VALIDITY, "bigquery_negative_usage", [0],
              [count_where(usage, _negatives(["query_jobs", "failed_jobs", "total_bytes_processed", "total_bytes_billed",
                                              "total_slot_ms", "cache_hit_jobs"]))]),
    ]
    return suite(spark, checks, executed_at)


def dashboard_checks(spark: SparkSession, t: Tables, views: Tables, executed_at: Column) -> DataFrame:
    v = {short: views[full] for short, full in DASHBOARDS.items() if full in views}
    checks = [Check(RECONCILIATION, "dashboard_views", [len(DASHBOARDS)], [len(v)])]
    checks += [
        Check(RECONCILIATION, DASHBOARDS[short], [row_count(t[table])], [row_count(v[short])])
        for short, table in (("resumo_nacional", "resumo_executivo"), ("uf", "kpi_uf"), ("municipio", "kpi_municipio"))
    ]
    checks.append(Check(RECONCILIATION, DASHBOARDS["operacao"], [3], [row_count(v["operacao"])]))
    failing = (F.col("pipeline_status") != SUCCEEDED) | (F.col("checks_failed") != 0)
    checks.append(Check(CONSISTENCY, "dashboard_operacao_sem_falhas", [0], [count_where(v["operacao"], failing)]))
    for short, label, other in (("resumo_nacional", "resumo", "ano_referencia"), ("uf", "uf", "sigla_uf"),
                                ("municipio", "municipio", "id_municipio")):
        no_key = F.col("ano").isNull() | F.col(other).isNull()
        checks.append(Check(VALIDITY, f"dashboard_{label}_chaves", [0], [count_where(v[short], no_key)]))
    measures = ["total_bytes_processed", "total_bytes_billed", "total_tib_billed", "query_jobs", "failed_jobs"]
    checks += [
        Check(VALIDITY, "dashboard_streaming_disponivel", [1], [has_rows(v["streaming"])]),
        Check(VALIDITY, "dashboard_bigquery_uso_disponivel", [1], [has_rows(v["uso_diario"])]),
        Check(VALIDITY, "dashboard_metricas_nao_negativas", [0], [count_where(v["uso_diario"], _negatives(measures))]),
    ]
    return suite(spark, checks, executed_at)
