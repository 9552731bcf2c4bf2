"""Quality rules per source: 61 critical and 29 alert rules over 51 distinct ids.

The ids are fixed output values; the conditions describe violations over the decoded columns.
"""

from __future__ import annotations

from pyspark.sql.functions import col as c

from plumbline.functions.numeric import any_outside, outside
from plumbline.functions.text import blank, full_match
from plumbline.operators.quality import Rule, RuleBook
from plumbline.plans.literacy.schemas import LEVEL_COLUMNS, MUNICIPAL, PUBLIC, STATES

LEVELS = list(LEVEL_COLUMNS.values())
CUT_OFF = 743


def repeated(rule_id: str) -> Rule:
    return Rule(rule_id, c("is_repeat"))


def no_year() -> Rule:
    return Rule("DQ001_ANO_AUSENTE", c("ano").isNull())


def city_code() -> tuple[Rule, ...]:
    return (
        Rule("DQ003_ID_MUNICIPIO_AUSENTE", blank("id_municipio")),
        Rule("DQ004_ID_MUNICIPIO_INVALIDO", ~full_match("id_municipio", r"\d{7}")),
    )


def state_code() -> tuple[Rule, ...]:
    return (
        Rule("DQ030_SIGLA_UF_AUSENTE", blank("sigla_uf")),
        Rule("DQ031_SIGLA_UF_INVALIDA", ~c("sigla_uf").isin(STATES)),
    )


def undecoded() -> tuple[Rule, ...]:
    return (
        Rule("DQ008_SERIE_NAO_MAPEADA", c("serie_nome").isNull()),
        Rule("DQ009_REDE_NAO_MAPEADA", c("rede_nome").isNull()),
    )


def bad_rate() -> Rule:
    return Rule("DQ020_TAXA_FORA_INTERVALO", outside("taxa_alfabetizacao", 0, 100))


def no_rate() -> Rule:
    return Rule("DQ110_TAXA_ALFABETIZACAO_AUSENTE", c("taxa_alfabetizacao").isNull())


def dictionary_rules() -> RuleBook:
    return RuleBook(
        critical=(
            Rule("DQ001_ID_TABELA_AUSENTE", blank("id_tabela")),
            Rule("DQ002_NOME_COLUNA_AUSENTE", blank("nome_coluna")),
            Rule("DQ003_CHAVE_DICIONARIO_AUSENTE", blank("chave")),
            Rule("DQ004_VALOR_DICIONARIO_AUSENTE", blank("valor")),
            repeated("DQ005_DICIONARIO_DUPLICADO"),
        )
    )


def pupil_rules() -> RuleBook:
    present, absent = c("presenca_codigo") == "1", c("presenca_codigo") == "0"
    literate, not_literate = c("alfabetizado_codigo") == "1", c("alfabetizado_codigo") == "0"
    booklet = c("preenchimento_caderno_codigo") == "1"
    score, weight = c("proficiencia"), c("peso_aluno")
    return RuleBook(
        critical=(
            no_year(),
            Rule("DQ002_ANO_FORA_INTERVALO", outside("ano", 2020, 2035)),
            *city_code(),
            Rule("DQ005_ID_ESCOLA_AUSENTE", blank("id_escola")),
            Rule("DQ006_ID_ALUNO_AUSENTE", blank("id_aluno")),
            Rule("DQ007_CADERNO_AUSENTE", blank("caderno_codigo")),
            *undecoded(),
            Rule("DQ010_PRESENCA_NAO_MAPEADA", c("presenca_nome").isNull()),
            Rule("DQ011_PREENCHIMENTO_NAO_MAPEADO", c("preenchimento_caderno_nome").isNull()),
            Rule("DQ012_ALFABETIZADO_NAO_MAPEADO", c("alfabetizado_nome").isNull()),
            Rule("DQ013_PROFICIENCIA_NEGATIVA", score < 0),
            Rule("DQ014_PESO_ALUNO_NAO_POSITIVO", weight <= 0),
            repeated("DQ015_CHAVE_ALUNO_DUPLICADA"),
        ),
        alert=(
            Rule("DQ101_PRESENTE_COM_PROVA_SEM_PROFICIENCIA", present & booklet & score.isNull()),
            Rule("DQ102_AUSENTE_COM_PROFICIENCIA", absent & score.isNotNull()),
            Rule("DQ103_AUSENTE_MARCADO_ALFABETIZADO", absent & literate),
            Rule("DQ104_PROFICIENCIA_ACIMA_CORTE_NAO_ALFABETIZADO", (score >= CUT_OFF) & not_literate),
            Rule("DQ105_PROFICIENCIA_ABAIXO_CORTE_ALFABETIZADO", (score < CUT_OFF) & literate),
            Rule("DQ106_PRESENTE_SEM_PESO_ALUNO", present & weight.isNull()),
        ),
    )


def _result_rules(place: tuple[Rule, ...], repeat_id: str) -> RuleBook:
    filled, total = c("quantidade_niveis_preenchidos"), c("soma_proporcoes_niveis")
    return RuleBook(
        critical=(
            no_year(),
            *place,
            *undecoded(),
            bad_rate(),
            Rule("DQ021_MEDIA_PORTUGUES_NEGATIVA", c("media_portugues") < 0),
            Rule("DQ022_PROPORCAO_NIVEL_FORA_INTERVALO", any_outside(LEVELS, 0, 100)),
            repeated(repeat_id),
        ),
        alert=(
            no_rate(),
            Rule("DQ111_MEDIA_PORTUGUES_AUSENTE", c("media_portugues").isNull()),
            Rule("DQ112_NIVEIS_NAO_INFORMADOS", filled == 0),
            Rule("DQ113_NIVEIS_PARCIALMENTE_INFORMADOS", filled.between(1, 8)),
            Rule("DQ114_SOMA_NIVEIS_FORA_TOLERANCIA", (filled == 9) & outside(total, 99.9, 100.1)),
        ),
    )


def city_result_rules() -> RuleBook:
    return _result_rules(city_code(), "DQ023_CHAVE_RESULTADO_MUNICIPIO_DUPLICADA")


def state_result_rules() -> RuleBook:
    return _result_rules(state_code(), "DQ032_CHAVE_RESULTADO_UF_DUPLICADA")


def _target_rules(
    place: tuple[Rule, ...], network_id: str, network: str, repeat_id: str, with_level: bool = False
) -> RuleBook:
    level = c("nivel_alfabetizacao")
    negative_level = (Rule("DQ045_NIVEL_ALFABETIZACAO_NEGATIVO", level < 0),) if with_level else ()
    no_level = (Rule("DQ125_NIVEL_ALFABETIZACAO_AUSENTE", level.isNull()),) if with_level else ()
    return RuleBook(
        critical=(
            no_year(),
            *place,
            Rule("DQ040_REDE_META_AUSENTE", blank("rede_normalizada")),
            bad_rate(),
            Rule("DQ041_META_FORA_INTERVALO", outside("meta_alfabetizacao", 0, 100)),
            *negative_level,
            Rule("DQ042_PARTICIPACAO_FORA_INTERVALO", outside("percentual_participacao", 0, 100)),
            repeated(repeat_id),
        ),
        alert=(
            Rule(network_id, c("rede_normalizada") != network),
            no_rate(),
            Rule("DQ121_META_ALFABETIZACAO_AUSENTE", c("meta_alfabetizacao").isNull()),
            *no_level,
            Rule("DQ122_PARTICIPACAO_AUSENTE", c("percentual_participacao").isNull()),
        ),
    )


def national_target_rules() -> RuleBook:
    return _target_rules((), "DQ120_REDE_META_BRASIL_INESPERADA", PUBLIC, "DQ043_CHAVE_META_BRASIL_DUPLICADA")


def state_target_rules() -> RuleBook:
    return _target_rules(state_code(), "DQ123_REDE_META_UF_INESPERADA", PUBLIC, "DQ044_CHAVE_META_UF_DUPLICADA")


def city_target_rules() -> RuleBook:
    return _target_rules(
        city_code(), "DQ124_REDE_META_MUNICIPIO_INESPERADA", MUNICIPAL, "DQ046_CHAVE_META_MUNICIPIO_DUPLICADA", True
    )


def rule_books() -> dict[str, RuleBook]:
    """Rule book per source (needs an active session, as every Column does)."""
    return {
        "dicionario": dictionary_rules(),
        "alunos": pupil_rules(),
        "municipio": city_result_rules(),
        "uf": state_result_rules(),
        "meta_alfabetizacao_brasil": national_target_rules(),
        "meta_alfabetizacao_uf": state_target_rules(),
        "meta_alfabetizacao_municipio": city_target_rules(),
    }
