"""Indicator products over the cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import banded, safe_percent
from plumbline.operators.dedup import latest_per_key
from plumbline.operators.indicators import (
    change_from_previous, next_period, rank_block, share_of_total, target_status, value_label,
)
from plumbline.operators.quality import union_all
from plumbline.operators.reshape import wide_to_long
from plumbline.plans.literacy import schemas as s
from plumbline.plans.literacy.silver import Product, Tables, municipal_results, public_state_results
from plumbline.session import stage

RESULT, TARGET, GAP = "taxa_alfabetizacao_resultado", "meta_alfabetizacao", "gap_meta_pontos_percentuais"
CHANGE = "variacao_pp_ano_anterior"


def _status() -> Column:
    return target_status(RESULT, TARGET, GAP, s.STATUS_LABELS).alias("status_meta")


def _participation_band() -> Column:
    band = banded("percentual_participacao", s.PARTICIPATION_STEPS, s.PARTICIPATION_TOP, s.PARTICIPATION_MISSING)
    return band.alias("faixa_participacao")


def _performance_band() -> Column:
    return value_label("quartil_desempenho", s.QUARTILE_LABELS, s.NO_RANKING).alias("faixa_desempenho")


def national_kpi(t: Tables, as_of: Column) -> DataFrame:
    """National rate, same-year target, gap and change.

    Distinct results keep conflicting rates of one year as separate rows; the uniqueness check reports them.
    """
    long = t["meta_brasil"]
    results = long.select(
        "ano", "ano_referencia", "rede_normalizada", F.col("taxa_alfabetizacao").alias(RESULT),
        "percentual_participacao", "source_batch_id",
    ).distinct()
    same_year = latest_per_key(
        long.filter(F.col("ano_meta") == F.col("ano")).select("ano", "rede_normalizada", TARGET, "silver_processed_at"),
        ["ano", "rede_normalizada"],
        ["silver_processed_at"],
    ).drop("silver_processed_at")
    joined = results.join(same_year, ["ano", "rede_normalizada"], "left").withColumn(GAP, F.col(RESULT) - F.col(TARGET))
    changed = change_from_previous(joined, ["rede_normalizada"], "ano", RESULT, CHANGE)
    return changed.select(
        "ano", "ano_referencia", "rede_normalizada", RESULT, TARGET, GAP, CHANGE, "percentual_participacao",
        _status(), _participation_band(), "source_batch_id", as_of.alias("gold_processed_at"),
    )


def _history(results: DataFrame, place: str) -> DataFrame:
    rates = results.select("ano", place, "taxa_alfabetizacao")
    return change_from_previous(rates, [place], "ano", "taxa_alfabetizacao", CHANGE).select("ano", place, CHANGE)


def state_kpi(t: Tables, as_of: Column) -> DataFrame:
    national = t["kpi_brasil"].filter(F.col("rede_normalizada") == s.PUBLIC).select(
        "ano", F.col(RESULT).alias("taxa_alfabetizacao_brasil")
    )
    base = (
        t["int_uf_meta"]
        .drop("silver_processed_at")
        .join(_history(public_state_results(t), "sigla_uf"), ["ano", "sigla_uf"], "left")
        .join(national, ["ano"], "left")
        .withColumn("gap_brasil_pontos_percentuais", F.col(RESULT) - F.col("taxa_alfabetizacao_brasil"))
    )
    base = stage(base, "kpi-uf-base")
    ranked = rank_block(base, ["ano"], RESULT, ["sigla_uf"], "posicao_uf", "percentil_desempenho", "quartil_desempenho")
    return ranked.select(
        "ano", "ano_referencia", "sigla_uf", RESULT, "media_portugues", TARGET, GAP, CHANGE,
        "percentual_participacao", "taxa_alfabetizacao_brasil", "gap_brasil_pontos_percentuais", "posicao_uf",
        "percentil_desempenho", "quartil_desempenho", _performance_band(), _status(), "integration_status",
        as_of.alias("gold_processed_at"),
    )


PUPIL_MEASURES = [
    "quantidade_alunos", "quantidade_presentes", "quantidade_provas_preenchidas", "quantidade_alfabetizados",
    "taxa_presenca", "taxa_preenchimento", "taxa_alfabetizacao_calculada", "proficiencia_media",
    "proficiencia_media_ponderada", "quantidade_registros_com_alerta",
]


def city_kpi(t: Tables, as_of: Column) -> DataFrame:
    pupils = t["agg_alunos_municipio"].filter(F.col("rede_nome") == s.MUNICIPAL).select(
        "ano", "id_municipio", *PUPIL_MEASURES
    )
    base = (
        t["int_municipio_meta"]
        .drop("silver_processed_at")
        .join(_history(municipal_results(t), "id_municipio"), ["ano", "id_municipio"], "left")
        .join(pupils, ["ano", "id_municipio"], "left")
        .withColumn("divergencia_microdados_publicado_pp", F.col("taxa_alfabetizacao_calculada") - F.col(RESULT))
    )
    base = stage(base, "kpi-municipio-base")
    ranked = rank_block(
        base, ["ano"], RESULT, ["id_municipio"], "posicao_nacional_municipio", "percentil_desempenho", "quartil_desempenho"
    )
    gap_band = banded(GAP, s.GAP_STEPS, s.GAP_TOP, s.GAP_MISSING).alias("faixa_gap_meta")
    return ranked.select(
        "ano", "ano_referencia", "id_municipio", RESULT, "media_portugues", TARGET, "percentual_participacao",
        "nivel_alfabetizacao", GAP, "integration_status", CHANGE, *PUPIL_MEASURES,
        "divergencia_microdados_publicado_pp", "posicao_nacional_municipio", "percentil_desempenho",
        "quartil_desempenho", _performance_band(), _status(), gap_band, _participation_band(),
        as_of.alias("gold_processed_at"),
    )


def coverage(t: Tables, as_of: Column) -> DataFrame:
    counted = union_all(
        t[table]
        .groupBy("ano", "ano_referencia", "integration_status")
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .withColumn("nivel_territorial", F.lit(level))
        for level, table in ((s.CITY_LEVEL, "int_municipio_meta"), (s.STATE_LEVEL, "int_uf_meta"))
    )
    shared = share_of_total(counted, ["nivel_territorial", "ano"], "quantidade", "percentual_cobertura")
    return shared.select(
        "nivel_territorial", "ano", "ano_referencia", "integration_status", "quantidade", "percentual_cobertura",
        as_of.alias("gold_processed_at"),
    )


def level_distribution(t: Tables, as_of: Column) -> DataFrame:
    wide = public_state_results(t).select(
        "ano", "ano_referencia", "sigla_uf", "rede_nome", "source_batch_id", *s.LEVEL_COLUMNS.values()
    )
    long = wide_to_long(wide, s.LEVEL_COLUMNS, "nivel_proficiencia", "proporcao_alunos")
    return long.select(
        "ano", "ano_referencia", "sigla_uf", "rede_nome", "nivel_proficiencia", "proporcao_alunos",
        F.col("proporcao_alunos").isNotNull().alias("dado_disponivel"), "source_batch_id",
        as_of.alias("gold_processed_at"),
    )


def _place_summary(kpi: DataFrame, plural: str, singular: str, extra: list[Column]) -> DataFrame:
    compared = F.col(TARGET).isNotNull() & F.col(RESULT).isNotNull()
    return kpi.groupBy("ano").agg(
        F.count(RESULT).alias(f"{plural}_com_resultado"),
        F.count_if(compared).alias(f"{plural}_comparaveis"),
        F.count_if(F.col("status_meta") == s.STATUS_LABELS[2]).alias(f"{plural}_atingiram_meta"),
        F.avg(RESULT).alias(f"media_taxa_{plural}"),
        F.min(RESULT).alias(f"menor_taxa_{singular}"),
        F.max(RESULT).alias(f"maior_taxa_{singular}"),
        *extra,
    )


def executive_summary(t: Tables, as_of: Column) -> DataFrame:
    years = t["kpi_brasil"].select("ano", "ano_referencia")
    for name in ("kpi_uf", "kpi_municipio"):
        years = years.union(t[name].select("ano", "ano_referencia"))
    # MIN instead of "any value": one row per year in practice, repeatable when there are more.
    national = t["kpi_brasil"].filter(F.col("rede_normalizada") == s.PUBLIC).groupBy("ano").agg(
        F.min(RESULT).alias("taxa_alfabetizacao_brasil"),
        F.min(TARGET).alias("meta_brasil"),
        F.min(GAP).alias("gap_meta_brasil_pp"),
        F.min("percentual_participacao").alias("participacao_brasil"),
    )
    states = _place_summary(t["kpi_uf"], "ufs", "uf", [])
    cities = _place_summary(
        t["kpi_municipio"], "municipios", "municipio", [F.avg("taxa_presenca").alias("media_taxa_presenca_alunos")]
    )
    joined = years.distinct()
    for side in (national, states, cities):
        joined = joined.join(side, ["ano"], "left")

    def reached(plural: str) -> Column:
        return safe_percent(f"{plural}_atingiram_meta", f"{plural}_comparaveis").alias(f"percentual_{plural}_atingiram_meta")

    def block(plural: str, singular: str) -> list[Column | str]:
        return [
            f"{plural}_com_resultado", f"{plural}_comparaveis", f"{plural}_atingiram_meta", reached(plural),
            f"media_taxa_{plural}", f"menor_taxa_{singular}", f"maior_taxa_{singular}",
        ]

    return joined.select(
        "ano", "ano_referencia", "taxa_alfabetizacao_brasil", "meta_brasil", "gap_meta_brasil_pp",
        "participacao_brasil", *block("ufs", "uf"), *block("municipios", "municipio"), "media_taxa_presenca_alunos",
        as_of.alias("gold_processed_at"),
    )


FEATURES = [
    "ano", "ano_referencia", "id_municipio", RESULT, "media_portugues", TARGET, GAP, "percentual_participacao",
    "nivel_alfabetizacao", CHANGE, "quantidade_alunos", "quantidade_presentes", "quantidade_alfabetizados",
    "taxa_presenca", "taxa_preenchimento", "taxa_alfabetizacao_calculada", "proficiencia_media",
    "proficiencia_media_ponderada", "integration_status", "status_meta",
]


def city_features(t: Tables, as_of: Column) -> DataFrame:
    """City rows with next row's rate and status as targets; the flag tells whether that is the next year."""
    ahead = next_period(
        t["kpi_municipio"].select(*FEATURES),
        ["id_municipio"],
        "ano",
        {
            "target_ano": "ano",
            "target_taxa_alfabetizacao_proximo_ano": RESULT,
            "target_status_meta_proximo_ano": "status_meta",
        },
    )
    follows = (F.col("target_ano") == F.col("ano") + 1) & F.col("target_taxa_alfabetizacao_proximo_ano").isNotNull()
    return ahead.withColumns({"possui_target_ano_seguinte": follows, "gold_processed_at": as_of})


PRODUCTS: dict[str, Product] = {
    "kpi_brasil": Product(national_kpi, ("rede_normalizada",)),
    "kpi_uf": Product(state_kpi, ("sigla_uf", "integration_status")),
    "kpi_municipio": Product(city_kpi, ("id_municipio", "integration_status")),
    "cobertura_integracao": Product(coverage, ("nivel_territorial", "integration_status")),
    "distribuicao_niveis_uf": Product(level_distribution, ("sigla_uf", "nivel_proficiencia")),
    "resumo_executivo": Product(executive_summary),
    "features_modelo_municipio": Product(city_features, ("id_municipio",)),
}
