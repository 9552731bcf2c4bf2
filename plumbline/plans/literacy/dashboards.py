"""Consumption views: rounded indicators, streaming overview, operation and usage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.indicators import value_label
from plumbline.operators.observe import usage_by_day
from plumbline.plans.literacy import schemas as s

# Fixed output values: display names of the pipelines.
PIPELINE_NAMES = {"silver_batch": "Batch — Silver", "gold_batch": "Batch — Gold", "streaming": "Streaming"}


def _rounded(df: DataFrame, names: Iterable[str], digits: int = 2) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def national_view(summary: DataFrame) -> DataFrame:
    percentages = [
        "taxa_alfabetizacao_brasil", "meta_brasil", "gap_meta_brasil_pp", "participacao_brasil",
        "percentual_ufs_atingiram_meta", "media_taxa_ufs", "menor_taxa_uf", "maior_taxa_uf",
        "percentual_municipios_atingiram_meta", "media_taxa_municipios", "menor_taxa_municipio",
        "maior_taxa_municipio", "media_taxa_presenca_alunos",
    ]
    _, no_target, reached, missed = s.STATUS_LABELS
    status: Column = (
        F.when(F.col("meta_brasil").isNull(), no_target)
        .when(F.col("gap_meta_brasil_pp") >= 0, reached)
        .otherwise(missed)
    )
    # The status looks at the exact gap, so it is added before rounding.
    out = _rounded(summary.withColumn("status_meta_brasil", status), percentages)
    return out.select(*[c for c in summary.columns if c != "gold_processed_at"], "status_meta_brasil", "gold_processed_at")


def _kpi_view(kpi: DataFrame, percentages: list[str]) -> DataFrame:
    scaled = kpi.withColumn("percentil_desempenho", F.col("percentil_desempenho") * 100)
    return _rounded(scaled, [*percentages, "percentil_desempenho"])


def state_view(kpi: DataFrame) -> DataFrame:
    return _kpi_view(
        kpi,
        ["taxa_alfabetizacao_resultado", "media_portugues", "meta_alfabetizacao", "gap_meta_pontos_percentuais",
         "variacao_pp_ano_anterior", "percentual_participacao", "taxa_alfabetizacao_brasil",
         "gap_brasil_pontos_percentuais"],
    )


def city_view(kpi: DataFrame) -> DataFrame:
    return _kpi_view(
        kpi,
        ["taxa_alfabetizacao_resultado", "media_portugues", "meta_alfabetizacao", "percentual_participacao",
         "gap_meta_pontos_percentuais", "variacao_pp_ano_anterior", "taxa_presenca", "taxa_preenchimento",
         "taxa_alfabetizacao_calculada", "proficiencia_media", "proficiencia_media_ponderada",
         "divergencia_microdados_publicado_pp"],
    )


def streaming_view(
    summary: DataFrame, latency: DataFrame, raw: DataFrame, typed: DataFrame, rejected: DataFrame
) -> DataFrame:
    """Valid events per day and type with latency and run totals.

    Latency is per (run, type), so its figures repeat when a run spans several days.
    """
    run = "simulation_run_id"

    def per_run(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col(run).isNotNull()).groupBy(run).agg(F.count(F.lit(1)).alias(name))

    figures = [
        "event_count", "events_with_publish_time", "events_without_publish_time", "avg_end_to_end_latency_seconds",
        "p95_end_to_end_latency_seconds", "max_end_to_end_latency_seconds", "avg_processing_latency_seconds",
    ]
    means = ["media_taxa_alfabetizacao", "media_meta_alfabetizacao", "media_percentual_participacao"]
    return (
        _rounded(summary, means)
        .join(latency.select(run, "event_type", *figures), [run, "event_type"], "left")
        .join(per_run(raw, "eventos_bronze_total_run"), [run], "left")
        .join(per_run(typed, "eventos_validos_total_run"), [run], "left")
        .join(per_run(rejected, "eventos_invalidos_total_run"), [run], "left")
        .select(
            *summary.columns, *figures, "eventos_bronze_total_run", "eventos_validos_total_run",
            F.coalesce("eventos_invalidos_total_run", F.lit(0)).alias("eventos_invalidos_total_run"),
        )
    )


def operation_view(latest_health: DataFrame) -> DataFrame:
    shown = value_label("pipeline_name", PIPELINE_NAMES, F.col("pipeline_name")).alias("pipeline_nome_exibicao")
    rest = [c for c in latest_health.columns if c != "pipeline_name"]
    return latest_health.select("pipeline_name", shown, *rest)


def usage_view(daily: DataFrame) -> DataFrame:
    return usage_by_day(daily)


DASHBOARDS = {
    "resumo_nacional": "vw_dashboard_resumo_nacional",
    "uf": "vw_dashboard_uf",
    "municipio": "vw_dashboard_municipio",
    "streaming": "vw_dashboard_streaming",
    "operacao": "vw_dashboard_operacao",
    "uso_diario": "vw_dashboard_bigquery_uso_diario",
}


def dashboard_views(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All six views from the product, streaming and operation tables."""
    return {
        DASHBOARDS["resumo_nacional"]: national_view(t["resumo_executivo"]),
        DASHBOARDS["uf"]: state_view(t["kpi_uf"]),
        DASHBOARDS["municipio"]: city_view(t["kpi_municipio"]),
        DASHBOARDS["streaming"]: streaming_view(
            t["streaming_resumo"], t["streaming_latency_summary"], t["streaming_raw"], t["streaming_eventos"],
            t["streaming_quarentena"],
        ),
        DASHBOARDS["operacao"]: operation_view(t["pipeline_health_latest"]),
        DASHBOARDS["uso_diario"]: usage_view(t["bigquery_usage_daily"]),
    }
