"""Small literacy sources: the published national targets and dictionary, plus one row per edge case."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from plumbline.plans.literacy import schemas as s

AT = dt.datetime(2026, 7, 12, 1, 11, 34)
BATCH = "batch_20260712T011134Z"

# The national targets as published (year, network, rate, 2024..2030 targets, participation).
NATIONAL = [
    (2023, "Pública", 55.9, 59.9, 63.77, 67.47, 70.97, 74.23, 77.24, 80.0, 86.0),
    (2024, "Pública", 59.2, 59.9, 63.77, 67.47, 70.97, 74.23, 77.24, 80.0, 87.37),
    (2025, "Pública", 66.0, 60.0, 64.0, 67.0, 71.0, 74.0, 77.0, 80.0, 88.0),
]

# The code table.
_NETWORKS = {"1": "Federal", "2": "Estadual", "3": "Municipal", "4": "Privada"}
_RESULT_NETWORKS = {
    "0": "Total (Federal, Estadual, Municipal e Privada)",
    **_NETWORKS,
    "5": "Pública (Estadual e Municipal)",
    "6": "Pública (Federal, Estadual e Municipal)",
}
_GRADE = {"2": "2° ano do Ensino Fundamental"}
_CODES = {
    ("alunos", "alfabetizado"): {"0": "Não", "1": "Sim"},
    ("alunos", "preenchimento_caderno"): {"0": "Prova não preenchida", "1": "Prova preenchida"},
    ("alunos", "presenca"): {"0": "Ausente", "1": "Presente"},
    ("alunos", "rede"): _NETWORKS,
    ("municipio", "rede"): _RESULT_NETWORKS,
    ("uf", "rede"): _RESULT_NETWORKS,
    ("alunos", "serie"): _GRADE,
    ("municipio", "serie"): _GRADE,
    ("uf", "serie"): _GRADE,
}
DICTIONARY = [(t, c, k, "(1)", v) for (t, c), codes in _CODES.items() for k, v in codes.items()]


def pupil(pid="A1", city="3550308", school="E1", grade="2", network="3", present="1", booklet="1", literate="1",
          score=800.0, weight=1.0, year=2024, booklet_id="C1"):
    return (year, city, school, pid, booklet_id, grade, network, present, booklet, literate, score, weight)


def result(year, place, rate=60.0, mean=700.0, levels=None, grade="2", network="3"):
    levels = levels if levels is not None else [10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 20.0]
    return (year, place, grade, network, rate, mean, *levels)


def target(year, place, network, rate=60.0, targets=None, level=None, participation=85.0, city=False):
    targets = targets if targets is not None else [60.0, 62.0, 64.0, 66.0, 68.0, 70.0, 80.0]
    tail = (level, participation) if city else (participation,)
    head = (year, network) if place is None else (year, place, network)
    return (*head, rate, *targets, *tail)


def frame(spark: SparkSession, name: str, rows):
    schema = s.SOURCES[name]
    return spark.createDataFrame(rows, schema)


def clean_sources(spark: SparkSession):
    """A consistent little data set on which every suite holds."""
    cities = ["3550308", "3304557", "5300108", "2927408", "1100015"]
    pupils = [
        pupil(pid=f"A{i}", city=cities[i % 5], school=f"E{i % 3}", score=700.0 + i, year=2023 + i % 3,
              literate="1" if 700.0 + i >= 743 else "0", weight=1.0 + i % 2)
        for i in range(90)
    ]
    city_results = [result(y, c, 50.0 + 5 * i + (y - 2023)) for y in (2023, 2024, 2025) for i, c in enumerate(cities)]
    states = ["SP", "RJ", "DF", "BA"]
    state_results = [result(y, u, 55.0 + i, network="5") for y in (2023, 2025) for i, u in enumerate(states)]
    return {
        "dicionario": frame(spark, "dicionario", DICTIONARY),
        "alunos": frame(spark, "alunos", pupils),
        "municipio": frame(spark, "municipio", city_results),
        "uf": frame(spark, "uf", state_results),
        "meta_alfabetizacao_brasil": frame(spark, "meta_alfabetizacao_brasil", NATIONAL),
        "meta_alfabetizacao_uf": frame(
            spark, "meta_alfabetizacao_uf", [target(y, u, "Pública") for y in (2024, 2025) for u in states]
        ),
        "meta_alfabetizacao_municipio": frame(
            spark, "meta_alfabetizacao_municipio",
            [target(y, c, "Municipal", level=3, city=True) for y in (2024, 2025) for c in cities],
        ),
    }
