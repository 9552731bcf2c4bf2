"""Source schemas, names and fixed code lists of the literacy data."""

from __future__ import annotations

from pyspark.sql import types as T

TARGET_YEARS = range(2024, 2031)
TARGET_COLUMNS = {year: f"meta_alfabetizacao_{year}" for year in TARGET_YEARS}
LEVEL_COLUMNS = {level: f"proporcao_aluno_nivel_{level}" for level in range(9)}


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _TEXT, _NUMBER = T.LongType(), T.StringType(), T.DoubleType()
_TARGETS = {"taxa_alfabetizacao": _NUMBER, **{name: _NUMBER for name in TARGET_COLUMNS.values()}}
_RESULTS = {"taxa_alfabetizacao": _NUMBER, "media_portugues": _NUMBER, **{name: _NUMBER for name in LEVEL_COLUMNS.values()}}

SOURCES: dict[str, T.StructType] = {
    "alunos": _struct({
        "ano": _LONG, "id_municipio": _TEXT, "id_escola": _TEXT, "id_aluno": _TEXT, "caderno": _TEXT, "serie": _TEXT, "rede": _TEXT,
        "presenca": _TEXT, "preenchimento_caderno": _TEXT, "alfabetizado": _TEXT, "proficiencia": _NUMBER, "peso_aluno": _NUMBER,
    }),
    "municipio": _struct({"ano": _LONG, "id_municipio": _TEXT, "serie": _TEXT, "rede": _TEXT, **_RESULTS}),
    "uf": _struct({"ano": _LONG, "sigla_uf": _TEXT, "serie": _TEXT, "rede": _TEXT, **_RESULTS}),
    "meta_alfabetizacao_brasil": _struct({"ano": _LONG, "rede": _TEXT, **_TARGETS, "percentual_participacao": _NUMBER}),
    "meta_alfabetizacao_uf": _struct({"ano": _LONG, "sigla_uf": _TEXT, "rede": _TEXT, **_TARGETS, "percentual_participacao": _NUMBER}),
    "meta_alfabetizacao_municipio": _struct({
        "ano": _LONG, "id_municipio": _TEXT, "rede": _TEXT, **_TARGETS, "nivel_alfabetizacao": _LONG, "percentual_participacao": _NUMBER,
    }),
    "dicionario": _struct({"id_tabela": _TEXT, "nome_coluna": _TEXT, "chave": _TEXT, "cobertura_temporal": _TEXT, "valor": _TEXT}),
}

# The 27 state codes.
STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO",
    "RR", "SC", "SP", "SE", "TO",
]

# Category codes and labels used by filters.
GRADE = "2"
PUBLIC_STATE_CODE = "5"
MUNICIPAL = "Municipal"
PUBLIC = "Pública"

# Network label -> group, for pupil rows and for published results.
PUPIL_NETWORK_GROUPS = {"Federal": "Pública", "Estadual": "Pública", "Municipal": "Pública", "Privada": "Privada"}
RESULT_NETWORK_GROUPS = PUPIL_NETWORK_GROUPS | {
    "Pública (Estadual e Municipal)": "Pública",
    "Pública (Federal, Estadual e Municipal)": "Pública",
}
RESULT_NETWORK_PREFIXES = {"Total": "Total"}

# Product labels.
STATUS_LABELS = ("SEM_RESULTADO", "SEM_META_DO_ANO", "ATINGIU_OU_SUPEROU", "ABAIXO_DA_META")
PARTICIPATION_STEPS = [(80, "ABAIXO_DE_80"), (90, "DE_80_A_89_99")]
PARTICIPATION_TOP, PARTICIPATION_MISSING = "90_OU_MAIS", "SEM_DADO"
GAP_STEPS = [(-10, "ABAIXO_MAIS_DE_10_PP"), (-5, "ABAIXO_DE_5_A_10_PP"), (0, "ABAIXO_ATE_5_PP")]
GAP_TOP, GAP_MISSING = "META_ATINGIDA_OU_SUPERADA", "SEM_COMPARACAO"
QUARTILE_LABELS = {1: "Q1_MAIS_ALTO", 2: "Q2", 3: "Q3", 4: "Q4_MAIS_BAIXO"}
NO_RANKING = "SEM_RANKING"
MATCH = "MATCH"
ONLY_PUPILS, ONLY_RESULT, ONLY_TARGET = "SOMENTE_ALUNOS", "SOMENTE_RESULTADO", "SOMENTE_META"
CITY_LEVEL, STATE_LEVEL = "MUNICIPIO", "UF"
