"""Cleaned tables, quarantine, pupil aggregate and result/target integrations."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import mean_where, present_count, present_sum, safe_percent, weighted_mean_where
from plumbline.functions.text import joined_key, strip
from plumbline.operators.decode import decode_columns, grouped_label
from plumbline.operators.dedup import drop_repeats, mark_repeats
from plumbline.operators.indicators import value_label
from plumbline.operators.quality import ALERT_STATUS, RuleBook, clean_rows, quarantine_rows, union_all
from plumbline.operators.reconcile import match_outer
from plumbline.operators.reshape import wide_to_long
from plumbline.plans.literacy import rules
from plumbline.plans.literacy import schemas as s

Tables = Mapping[str, DataFrame]

LINEAGE = {
    "source_ingestion_timestamp": "_ingestion_timestamp",
    "source_batch_id": "_batch_id",
    "source_table": "_source_table",
    "ingestion_date": "ingestion_date",
    "batch_id": "batch_id",
}


def _lineage() -> list[Column]:
    return [F.col(src).alias(out) for out, src in LINEAGE.items()]


def _year() -> list[Column]:
    return [F.col("ano"), F.make_date("ano", F.lit(1), F.lit(1)).alias("ano_referencia")]


def _stripped(**names: str) -> list[Column]:
    return [strip(src).alias(out) for out, src in names.items()]


def _network() -> Column:
    """Target networks are free text: two spellings are normalised, the rest only trimmed."""
    text = strip("rede")
    return value_label(F.lower(text), {"pública": "Pública", "municipal": "Municipal"}, text).alias("rede_normalizada")


def staged_dictionary(source: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    names = ["id_tabela", "nome_coluna", "chave", "cobertura_temporal", "valor"]
    return source.select(*_stripped(**{n: n for n in names}), *_lineage())


def staged_pupils(source: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Pupils by their codes alone: names follow from codes, and are added once repeats are marked on narrower rows."""
    return source.select(
        *_year(),
        *_stripped(
            id_municipio="id_municipio", id_escola="id_escola", id_aluno="id_aluno", caderno_codigo="caderno",
            serie_codigo="serie", rede_codigo="rede", presenca_codigo="presenca",
            preenchimento_caderno_codigo="preenchimento_caderno", alfabetizado_codigo="alfabetizado",
        ),
        "proficiencia",
        "peso_aluno",
        *_lineage(),
    )


def named_pupils(base: DataFrame, codes: DataFrame) -> DataFrame:
    coded = ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]
    decoded = decode_columns(base, codes, "alunos", {f"{n}_nome": (f"{n}_codigo", n) for n in coded})
    decoded = decoded.withColumn("rede_agrupada", grouped_label("rede_nome", s.PUPIL_NETWORK_GROUPS))
    return decoded.select(
        "ano", "ano_referencia", "id_municipio", "id_escola", "id_aluno", "caderno_codigo", "serie_codigo",
        "serie_nome", "rede_codigo", "rede_nome", "rede_agrupada", "presenca_codigo", "presenca_nome",
        "preenchimento_caderno_codigo", "preenchimento_caderno_nome", "alfabetizado_codigo", "alfabetizado_nome",
        "proficiencia", "peso_aluno", *LINEAGE, "is_repeat",
    )


def _staged_results(source: DataFrame, codes: DataFrame, table: str, place: Column, place_name: str) -> DataFrame:
    levels = list(s.LEVEL_COLUMNS.values())
    base = source.select(
        *_year(),
        place.alias(place_name),
        *_stripped(serie_codigo="serie", rede_codigo="rede"),
        "taxa_alfabetizacao",
        "media_portugues",
        *levels,
        present_count(levels).alias("quantidade_niveis_preenchidos"),
        present_sum(levels).alias("soma_proporcoes_niveis"),
        *_lineage(),
    )
    decoded = decode_columns(base, codes, table, {f"{n}_nome": (f"{n}_codigo", n) for n in ("serie", "rede")})
    grouped = grouped_label("rede_nome", s.RESULT_NETWORK_GROUPS, s.RESULT_NETWORK_PREFIXES)
    return decoded.withColumn("rede_agrupada", grouped).select(
        "ano", "ano_referencia", place_name, "serie_codigo", "serie_nome", "rede_codigo", "rede_nome",
        "rede_agrupada", "taxa_alfabetizacao", "media_portugues", *levels,
        "quantidade_niveis_preenchidos", "soma_proporcoes_niveis", *LINEAGE,
    )


def staged_city_results(source: DataFrame, codes: DataFrame) -> DataFrame:
    return _staged_results(source, codes, "municipio", strip("id_municipio"), "id_municipio")


def staged_state_results(source: DataFrame, codes: DataFrame) -> DataFrame:
    return _staged_results(source, codes, "uf", F.upper(strip("sigla_uf")), "sigla_uf")


def _staged_targets(source: DataFrame, place: list[Column], extra: list[str]) -> DataFrame:
    wide = source.select(
        *_year(), *place, _network(), "taxa_alfabetizacao", *s.TARGET_COLUMNS.values(), *extra,
        "percentual_participacao", *_lineage(),
    )
    long = wide_to_long(wide, s.TARGET_COLUMNS, "ano_meta", "meta_alfabetizacao")
    head = [n for n in ("ano", "ano_referencia", "id_municipio", "sigla_uf", "rede_normalizada") if n in long.columns]
    return long.select(
        *head, "taxa_alfabetizacao", "ano_meta", "meta_alfabetizacao", *extra, "percentual_participacao", *LINEAGE
    )


def staged_national_targets(source: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    return _staged_targets(source, [], [])


def staged_state_targets(source: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    return _staged_targets(source, [F.upper(strip("sigla_uf")).alias("sigla_uf")], [])


def staged_city_targets(source: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    return _staged_targets(source, [strip("id_municipio").alias("id_municipio")], ["nivel_alfabetizacao"])


@dataclass(frozen=True)
class SourcePlan:
    """How one source becomes a cleaned table: staging, uniqueness key, rules, quarantine key, layout."""

    table: str
    stage: Callable[[DataFrame, DataFrame | None], DataFrame]
    key: tuple[str, ...]
    rules: Callable[[], RuleBook]
    record_key: tuple[str, ...]
    cluster: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    partition: tuple[str, ...] = ("ano_referencia",)
    drop: tuple[str, ...] = ()
    expansion: int = 1
    nullable_head: bool = True  # a NULL first part makes the quarantine key NULL
    fixed_tail: tuple[str, ...] = field(default=())  # key parts that are never NULL
    named: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None  # columns that follow from others, added last

    def tagged(self, source: DataFrame, codes: DataFrame | None, repeats: bool = True) -> DataFrame:
        """Rows with the rules they break; without ``repeats`` those that repeat a key, which are never clean, are left out."""
        staged = self.stage(source, codes)
        order = [F.desc("source_ingestion_timestamp"), *[F.asc(o) for o in self.order]]
        if repeats:
            marked = mark_repeats(staged, self.key, order)
        else:
            marked = drop_repeats(staged, self.key, order).withColumn("is_repeat", F.lit(False))
        return self.rules().tag(self.named(marked, codes) if self.named else marked)

    def clean(self, tagged: DataFrame, as_of: Column) -> DataFrame:
        out = clean_rows(tagged, ["is_repeat"])
        if self.drop:
            out = out.drop(*self.drop)
        return out.withColumn("silver_processed_at", as_of)

    def quarantined(self, name: str, tagged: DataFrame, as_of: Column) -> DataFrame:
        head, *rest = self.record_key
        first = F.col(head).cast("string")
        parts = [first if self.nullable_head else F.coalesce(first, F.lit(""))]
        parts += [F.coalesce(F.col(r).cast("string"), F.lit("")) for r in rest]
        return quarantine_rows(tagged, name, joined_key(*parts), as_of, ["is_repeat"])


# Source name -> plan, in build order: the dictionary feeds the decoding of the others.
SOURCE_PLANS: dict[str, SourcePlan] = {
    "dicionario": SourcePlan(
        "dim_dicionario", staged_dictionary, ("id_tabela", "nome_coluna", "chave"), rules.dictionary_rules,
        ("id_tabela", "nome_coluna", "chave"), partition=(), drop=("batch_id", "quality_status", "quality_alerts"),
        nullable_head=False,
    ),
    "alunos": SourcePlan(
        "alunos", staged_pupils, ("ano", "id_aluno"), rules.pupil_rules, ("ano", "id_aluno"),
        ("id_municipio", "rede_nome", "id_escola"), order=("id_escola",), named=named_pupils,
    ),
    "municipio": SourcePlan(
        "resultado_municipio", staged_city_results, ("ano", "id_municipio", "serie_codigo", "rede_codigo"),
        rules.city_result_rules, ("ano", "id_municipio", "serie_codigo", "rede_codigo"), ("id_municipio", "rede_codigo"),
    ),
    "uf": SourcePlan(
        "resultado_uf", staged_state_results, ("ano", "sigla_uf", "serie_codigo", "rede_codigo"),
        rules.state_result_rules, ("ano", "sigla_uf", "serie_codigo", "rede_codigo"), ("sigla_uf", "rede_codigo"),
    ),
    "meta_alfabetizacao_brasil": SourcePlan(
        "meta_brasil", staged_national_targets, ("ano", "rede_normalizada", "ano_meta"),
        rules.national_target_rules, ("ano", "rede_normalizada", "ano_meta"), ("rede_normalizada", "ano_meta"),
        expansion=len(s.TARGET_YEARS),
    ),
    "meta_alfabetizacao_uf": SourcePlan(
        "meta_uf", staged_state_targets, ("ano", "sigla_uf", "rede_normalizada", "ano_meta"),
        rules.state_target_rules, ("ano", "sigla_uf", "rede_normalizada", "ano_meta"),
        ("sigla_uf", "rede_normalizada", "ano_meta"), expansion=len(s.TARGET_YEARS),
    ),
    "meta_alfabetizacao_municipio": SourcePlan(
        "meta_municipio", staged_city_targets, ("ano", "id_municipio", "rede_normalizada", "ano_meta"),
        rules.city_target_rules, ("ano", "id_municipio", "rede_normalizada", "ano_meta"),
        ("id_municipio", "rede_normalizada", "ano_meta"), expansion=len(s.TARGET_YEARS),
    ),
}

QUARANTINE = "quarantine_records"


def quarantine(tagged: Mapping[str, DataFrame], as_of: Column) -> DataFrame:
    return union_all(SOURCE_PLANS[name].quarantined(name, df, as_of) for name, df in tagged.items())


def pupil_aggregate(t: Tables, as_of: Column) -> DataFrame:
    """Pupils per year, city and network; computed map-side first, so 100 TB of pupils shuffle as partial sums."""
    present = F.col("presenca_codigo") == "1"
    filled = F.col("preenchimento_caderno_codigo") == "1"
    literate = F.col("alfabetizado_codigo") == "1"
    rows = F.count(F.lit(1))
    return (
        t["alunos"]
        .groupBy("ano", "ano_referencia", "id_municipio", "rede_codigo", "rede_nome", "rede_agrupada")
        .agg(
            rows.alias("quantidade_alunos"),
            F.count_if(present).alias("quantidade_presentes"),
            F.count_if(filled).alias("quantidade_provas_preenchidas"),
            F.count_if(literate).alias("quantidade_alfabetizados"),
            safe_percent(F.count_if(present), rows).alias("taxa_presenca"),
            safe_percent(F.count_if(filled), rows).alias("taxa_preenchimento"),
            safe_percent(F.count_if(literate), rows).alias("taxa_alfabetizacao_calculada"),
            mean_where(present, "proficiencia").alias("proficiencia_media"),
            weighted_mean_where(present, "proficiencia", "peso_aluno").alias("proficiencia_media_ponderada"),
            F.count_if(F.col("quality_status") == ALERT_STATUS).alias("quantidade_registros_com_alerta"),
            F.min("source_batch_id").alias("source_batch_id"),
        )
        .withColumn("silver_processed_at", as_of)
    )


def pupils_with_results(t: Tables, as_of: Column) -> DataFrame:
    """Aggregated pupils against published city results; results of other grades stay, unmatched."""
    counts = [
        "quantidade_alunos", "quantidade_presentes", "quantidade_alfabetizados", "taxa_presenca",
        "taxa_alfabetizacao_calculada", "proficiencia_media", "proficiencia_media_ponderada",
    ]
    joined = match_outer(
        t["agg_alunos_municipio"],
        t["resultado_municipio"],
        ["ano", "id_municipio", "rede_nome"],
        {"__ref_l": "ano_referencia", **{n: n for n in counts}},
        {"__ref_r": "ano_referencia", "taxa_alfabetizacao_publicada": "taxa_alfabetizacao",
         "media_portugues": "media_portugues"},
        (s.MATCH, s.ONLY_PUPILS, s.ONLY_RESULT),
        residual=lambda right: right("serie_codigo") == s.GRADE,
        presence="id_municipio",
    )
    return joined.select(
        "ano", F.coalesce("__ref_l", "__ref_r").alias("ano_referencia"), "id_municipio", "rede_nome", *counts,
        "taxa_alfabetizacao_publicada", "media_portugues", "integration_status", as_of.alias("silver_processed_at"),
    )


def _results_with_targets(results: DataFrame, targets: DataFrame, place: str, extra: list[str], as_of: Column) -> DataFrame:
    joined = match_outer(
        results,
        targets.filter(F.col("ano_meta") == F.col("ano")),
        ["ano", place],
        {"__ref_l": "ano_referencia", "taxa_alfabetizacao_resultado": "taxa_alfabetizacao",
         "media_portugues": "media_portugues"},
        {"__ref_r": "ano_referencia", "meta_alfabetizacao": "meta_alfabetizacao",
         "percentual_participacao": "percentual_participacao", **{n: n for n in extra}},
        (s.MATCH, s.ONLY_RESULT, s.ONLY_TARGET),
    )
    return joined.select(
        "ano", F.coalesce("__ref_l", "__ref_r").alias("ano_referencia"), place, "taxa_alfabetizacao_resultado",
        "media_portugues", "meta_alfabetizacao", "percentual_participacao", *extra,
        (F.col("taxa_alfabetizacao_resultado") - F.col("meta_alfabetizacao")).alias("gap_meta_pontos_percentuais"),
        "integration_status", as_of.alias("silver_processed_at"),
    )


def municipal_results(t: Tables) -> DataFrame:
    return t["resultado_municipio"].filter((F.col("serie_codigo") == s.GRADE) & (F.col("rede_nome") == s.MUNICIPAL))


def public_state_results(t: Tables) -> DataFrame:
    return t["resultado_uf"].filter((F.col("serie_codigo") == s.GRADE) & (F.col("rede_codigo") == s.PUBLIC_STATE_CODE))


def city_results_with_targets(t: Tables, as_of: Column) -> DataFrame:
    targets = t["meta_municipio"].filter(F.col("rede_normalizada") == s.MUNICIPAL)
    return _results_with_targets(municipal_results(t), targets, "id_municipio", ["nivel_alfabetizacao"], as_of)


def state_results_with_targets(t: Tables, as_of: Column) -> DataFrame:
    targets = t["meta_uf"].filter(F.col("rede_normalizada") == s.PUBLIC)
    return _results_with_targets(public_state_results(t), targets, "sigla_uf", [], as_of)


def national_results_with_targets(t: Tables, as_of: Column) -> DataFrame:
    return t["meta_brasil"].filter(F.col("ano_meta") == F.col("ano")).select(
        "ano", "ano_referencia", "rede_normalizada",
        F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_resultado"),
        "meta_alfabetizacao", "percentual_participacao",
        (F.col("taxa_alfabetizacao") - F.col("meta_alfabetizacao")).alias("gap_meta_pontos_percentuais"),
        as_of.alias("silver_processed_at"),
    )


@dataclass(frozen=True)
class Product:
    """A named table: how to compute it from earlier tables, and its layout."""

    build: Callable[[Tables, Column], DataFrame]
    cluster: tuple[str, ...] = ()
    partition: tuple[str, ...] = ("ano_referencia",)


INTEGRATIONS: dict[str, Product] = {
    "agg_alunos_municipio": Product(pupil_aggregate, ("id_municipio", "rede_nome")),
    "int_alunos_resultado_municipio": Product(pupils_with_results, ("id_municipio", "rede_nome")),
    "int_municipio_meta": Product(city_results_with_targets, ("id_municipio",)),
    "int_uf_meta": Product(state_results_with_targets, ("sigla_uf",)),
    "int_brasil_meta": Product(national_results_with_targets, ("rede_normalizada",)),
}
