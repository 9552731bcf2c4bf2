"""The literacy products on sources that Spark derives from the whole star-schema tables.

Line items become pupils, suppliers cities, nations states; every source grows with its table. Some rows break
rules by nature of the data (repeated line keys, balances that give targets above 100).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.quality import union_all
from plumbline.plans.literacy import schemas as s
from plumbline.plans.literacy import suites
from plumbline.plans.literacy.dashboards import city_view, national_view, state_view
from plumbline.plans.literacy.gold import PRODUCTS
from plumbline.plans.literacy.silver import INTEGRATIONS, QUARANTINE, SOURCE_PLANS, quarantine
from plumbline.plans.star.base import Query, table
from plumbline.session import stage

AT, BATCH = dt.datetime(2026, 7, 12, 1, 11, 34), "batch_20260712T011134Z"

# The code table (table, column) -> code -> label.
NETWORKS = {"1": "Federal", "2": "Estadual", "3": "Municipal", "4": "Privada"}
RESULT_NETWORKS = {
    "0": "Total (Federal, Estadual, Municipal e Privada)", **NETWORKS,
    "5": "Pública (Estadual e Municipal)", "6": "Pública (Federal, Estadual e Municipal)",
}
GRADES = {"2": "2° ano do Ensino Fundamental"}
CODES = {
    ("alunos", "alfabetizado"): {"0": "Não", "1": "Sim"},
    ("alunos", "preenchimento_caderno"): {"0": "Prova não preenchida", "1": "Prova preenchida"},
    ("alunos", "presenca"): {"0": "Ausente", "1": "Presente"},
    ("alunos", "rede"): NETWORKS, ("municipio", "rede"): RESULT_NETWORKS, ("uf", "rede"): RESULT_NETWORKS,
    ("alunos", "serie"): GRADES, ("municipio", "serie"): GRADES, ("uf", "serie"): GRADES,
}
CODE_ROWS = [(t, c, k, "(1)", v) for (t, c), codes in CODES.items() for k, v in codes.items()]


def _years(start: Column) -> Column:
    """The seven order years folded onto three school years."""
    return (2023 + (start - 1995) % 3).cast("long")


def _pupils(lines: DataFrame) -> DataFrame:
    absent = F.col("l_discount") == 0
    return lines.select(
        _years(F.year("l_shipdate")).alias("ano"),
        (F.col("l_suppkey") + 1_000_000).cast("string").alias("id_municipio"),
        F.col("l_partkey").cast("string").alias("id_escola"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id_aluno"),
        F.col("l_linestatus").alias("caderno"),
        F.when(F.col("l_quantity") > 49, "3").otherwise("2").alias("serie"),
        F.when(F.col("l_returnflag") == "N", "2").otherwise("3\t").alias("rede"),
        F.when(absent, "0").otherwise(" 1").alias("presenca"),
        F.when(absent | (F.col("l_tax") > 0.075), "0").otherwise("1").alias("preenchimento_caderno"),
        F.when(F.col("l_extendedprice") > 50000, "1").otherwise("0").alias("alfabetizado"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice") / 131).alias("proficiencia"),
        F.when(F.col("l_discount") < 0.095, (F.col("l_quantity") - 1) / 10).alias("peso_aluno"),
    )


def _results(lines: DataFrame, place: Column, place_name: str) -> DataFrame:
    n = F.count(F.lit(1))
    band = F.floor(F.col("l_extendedprice") / 12000)
    rede = F.when(F.col("l_returnflag") == "A", "3").when(F.col("l_returnflag") == "R", "5").otherwise("9")
    grouped = lines.groupBy(_years(F.year("l_shipdate")).alias("ano"), place.alias(place_name), rede.alias("rede")).agg(
        F.when(n >= 3, F.count_if(F.col("l_extendedprice") > 50000) * 100 / n).alias("taxa_alfabetizacao"),
        (F.avg("l_extendedprice") / 131).alias("media_portugues"),
        *[F.nullif(F.count_if(band == i) * 100 / n, F.lit(0.0)).alias(c) for i, c in s.LEVEL_COLUMNS.items()],
    )
    kind = "municipio" if place_name == "id_municipio" else "uf"
    return grouped.withColumn("serie", F.lit("2")).select(*s.SOURCES[kind].names)


def _targets(rows: DataFrame, kind: str, base: Column) -> DataFrame:
    targets = {c: base + (y - 2024) * 0.5 for y, c in s.TARGET_COLUMNS.items()}
    return rows.withColumns(targets).select(*s.SOURCES[kind].names)


def _state(key: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in s.STATES]), F.col(key) + 1)


def derived_sources(spark: SparkSession, sf: str) -> dict[str, Callable[[], DataFrame]]:
    lines, suppliers = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    every_year = F.explode(F.array(*[F.lit(y).cast("long") for y in (2023, 2024, 2025)])).alias("ano")

    def state_results() -> DataFrame:
        # Per supplier first, so the join to the small place table happens after the reduction in rows.
        places = suppliers.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        return _results(lines.join(places, "l_suppkey"), F.lower(_state("s_nationkey")), "sigla_uf")

    def city_targets() -> DataFrame:
        rows = suppliers.select(
            every_year, (F.col("s_suppkey") + 1_000_000).cast("string").alias("id_municipio"), "s_acctbal",
            F.when(F.col("s_nationkey") % 5 == 0, "MUNICIPAL ").otherwise("Municipal").alias("rede"),
            (50 + F.col("s_acctbal") / 700).alias("taxa_alfabetizacao"),
            F.nullif(F.col("s_nationkey") % 5, F.lit(4)).cast("long").alias("nivel_alfabetizacao"),
            (75 + F.col("s_suppkey") % 30).cast("double").alias("percentual_participacao"),
        )
        return _targets(rows, "meta_alfabetizacao_municipio", 40 + F.col("s_acctbal") / 130)

    def state_targets() -> DataFrame:
        per_state = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("b"))
        rows = per_state.select(
            every_year, _state("c_nationkey").alias("sigla_uf"), F.lit("Pública").alias("rede"), "b",
            (50 + F.col("b") / 700).alias("taxa_alfabetizacao"),
            (82 + F.col("c_nationkey") % 9).cast("double").alias("percentual_participacao"),
        )
        return _targets(rows, "meta_alfabetizacao_uf", 30 + F.col("b") / 700)

    def national_targets() -> DataFrame:
        rows = table(spark, sf, "orders").groupBy(_years(F.year("o_orderdate")).alias("ano")).agg(
            (F.avg("o_totalprice") / 5130).alias("taxa_alfabetizacao"),
            (80 + F.count(F.lit(1)) % 20).cast("double").alias("percentual_participacao"),
        )
        return _targets(rows.withColumn("rede", F.lit("pública")), "meta_alfabetizacao_brasil", F.lit(49.0))

    return {
        "dicionario": lambda: spark.createDataFrame(CODE_ROWS, s.SOURCES["dicionario"]),
        "alunos": lambda: _pupils(lines),
        "municipio": lambda: _results(lines, (F.col("l_suppkey") + 1_000_000).cast("string"), "id_municipio"),
        "uf": state_results,
        "meta_alfabetizacao_brasil": national_targets,
        "meta_alfabetizacao_uf": state_targets,
        "meta_alfabetizacao_municipio": city_targets,
    }


# Tables that later ones read more than once; the others are planned into their only reader.
REUSED = {
    "dim_dicionario", "resultado_municipio", "resultado_uf", "meta_brasil", "int_municipio_meta", "int_uf_meta",
    "kpi_brasil", "kpi_uf", "kpi_municipio",
}


class LazyLayers(Mapping[str, DataFrame]):
    """Sources, cleaned tables, integrations and products by name, each planned on first use.

    ``result`` names the table that is asked for in the end: it is never staged, and what it reads only once is
    not either. With ``both_sides`` the tagged rows are staged, as both the clean rows and the quarantine read them; what is
    only filtered from them is then not staged again. Otherwise only the quarantine needs the rows that repeat a key.
    """

    def __init__(self, spark: SparkSession, sf: str, result: str | None = None, both_sides: bool = False):
        self._sources = derived_sources(spark, sf)
        self._by_table = {plan.table: name for name, plan in SOURCE_PLANS.items()}
        self._built: dict[str, DataFrame] = {}
        self._as_of = F.lit(AT.isoformat(sep=" ")).cast("timestamp")
        self._result, self._both_sides = result, both_sides

    def source(self, name: str) -> DataFrame:
        return self._sources[name]().withColumns(
            {
                "_ingestion_timestamp": self._as_of, "_batch_id": F.lit(BATCH), "_source_table": F.lit(f"star.{name}"),
                "ingestion_date": F.lit(AT.date()), "batch_id": F.lit(BATCH),
            }
        )

    def tagged(self, name: str, repeats: bool = True) -> DataFrame:
        repeats = repeats or self._both_sides
        key = f"tagged-{name}" if repeats else f"kept-{name}"
        if key not in self._built:
            codes = None if name == "dicionario" or name.startswith("meta") else self["dim_dicionario"]
            tagged = SOURCE_PLANS[name].tagged(self.source(name), codes, repeats)
            self._built[key] = stage(tagged, key) if self._both_sides else tagged
        return self._built[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in self._by_table:
                source = self._by_table[name]
                df = SOURCE_PLANS[source].clean(self.tagged(source, repeats=False), self._as_of)
            elif name == QUARANTINE:
                df = quarantine({n: self.tagged(n) for n in SOURCE_PLANS}, self._as_of)
            else:
                df = {**INTEGRATIONS, **PRODUCTS}[name].build(self, self._as_of)
            filtered = self._both_sides and (name == QUARANTINE or name in self._by_table)
            shared = name in REUSED or (self._result is None and not filtered)
            self._built[name] = stage(df, name) if shared and name != self._result else df
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*self._by_table, QUARANTINE, *INTEGRATIONS, *PRODUCTS])

    def __len__(self) -> int:
        return len(list(iter(self)))


HIDDEN = {
    "source_ingestion_timestamp", "source_batch_id", "source_table", "ingestion_date", "batch_id", "silver_processed_at",
    "gold_processed_at", "ano_referencia",
}


def shown(df: DataFrame) -> DataFrame:
    """Without run metadata, doubles rounded, rule lists as text."""
    columns = []
    for f in df.schema.fields:
        if f.name in HIDDEN:
            continue
        kind = f.dataType.simpleString()
        c = F.round(f.name, 6) if kind == "double" else F.array_join(f.name, ";") if kind.startswith("array") else F.col(f.name)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _of(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: shown(LazyLayers(spark, sf, name)[name])


def quarantine_query(spark: SparkSession, sf: str) -> DataFrame:
    rejected = LazyLayers(spark, sf, QUARANTINE)[QUARANTINE]
    return rejected.select("source_table", "record_key", F.array_join("quality_rules", ";").alias("rules"))


def targets_query(spark: SparkSession, sf: str) -> DataFrame:
    layers = LazyLayers(spark, sf, "targets")
    places = {"meta_brasil": F.lit("BR"), "meta_uf": F.col("sigla_uf"), "meta_municipio": F.col("id_municipio")}
    return shown(
        union_all(
            layers[name].select(
                F.lit(name).alias("source"), place.alias("place"), "ano", "rede_normalizada", "ano_meta", "meta_alfabetizacao",
                "percentual_participacao", "quality_status", "quality_alerts",
            )
            for name, place in places.items()
        )
    )


def silver_suite(spark: SparkSession, sf: str) -> DataFrame:
    layers = LazyLayers(spark, sf, both_sides=True)
    sources = {n: layers.source(n) for n in SOURCE_PLANS}
    out = suites.silver_checks(spark, sources, layers, AT.date(), BATCH, F.lit(None).cast("timestamp"))
    return out.select("check_type", "object_name", "expected_value", "actual_value", "status")


def gold_suite(spark: SparkSession, sf: str) -> DataFrame:
    out = suites.gold_checks(spark, LazyLayers(spark, sf), F.lit(None).cast("timestamp"))
    return out.select("check_type", "object_name", "expected_value", "actual_value", "status")


def dashboards_query(name: str, view: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: view(LazyLayers(spark, sf, name)[name]).drop(*HIDDEN)


# --- the same products in SQL -------------------------------------------------------------------------------------

_LEVELS = list(s.LEVEL_COLUMNS.values())
_VALUES = ", ".join(f"('{t}', '{c}', '{k}', '{v}')" for t, c, k, _, v in CODE_ROWS)
_STATE_LIST = "[" + ",".join(f"'{x}'" for x in s.STATES) + "]"


def _year(c: str) -> str:
    return f"(2023 + (year({c}) - 1995) % 3)"


def _label(t: str, c: str, code: str) -> str:
    return f"(SELECT v FROM codes WHERE t = '{t}' AND c = '{c}' AND k = {code})"


def _rules(*rules: tuple[str, str]) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {cond} THEN '{rule}' END" for rule, cond in rules) + ")"


def _results_sql(name: str, kind: str, place: str, rows: str, repeat: str) -> str:
    levels = ", ".join(
        f"nullif(100.0 * count(*) FILTER (floor(l_extendedprice / 12000) = {i}) / count(*), 0) AS {c}"
        for i, c in s.LEVEL_COLUMNS.items()
    )
    filled = " + ".join(f"({c} IS NOT NULL)::INT" for c in _LEVELS)
    alerts = _rules(
        ("DQ110_TAXA_ALFABETIZACAO_AUSENTE", "taxa_alfabetizacao IS NULL"),
        ("DQ112_NIVEIS_NAO_INFORMADOS", "filled = 0"), ("DQ113_NIVEIS_PARCIALMENTE_INFORMADOS", "filled BETWEEN 1 AND 8"),
    )
    # Grouping makes the key unique, so the only rule that breaks is the unknown network '9'.
    return f"""{name}_tagged AS (
  SELECT *, {filled} AS filled, (SELECT v FROM codes WHERE t = '{kind}' AND c = 'rede' AND k = rede_codigo) AS rede_nome
  FROM (SELECT {_year("l_shipdate")} AS ano, {place} AS place,
      CASE l_returnflag WHEN 'A' THEN '3' WHEN 'R' THEN '5' ELSE '9' END AS rede_codigo,
      CASE WHEN count(*) >= 3 THEN 100.0 * count(*) FILTER (l_extendedprice > 50000) / count(*) END AS taxa_alfabetizacao,
      avg(l_extendedprice) / 131 AS media_portugues, {levels} FROM {rows} GROUP BY 1, 2, 3)),
{name} AS (SELECT *, {alerts} AS quality_alerts, CASE WHEN {alerts} = '' THEN 'VALID' ELSE 'ALERT' END AS quality_status
  FROM {name}_tagged WHERE rede_nome IS NOT NULL)"""


def _targets_sql(name: str, rows: str, base: str, extra: str, critical: str, alerts: str) -> str:
    return f"""{name}_tagged AS (
  SELECT *, {critical} AS critical, {alerts} AS quality_alerts
  FROM (SELECT r.*, y.ano_meta, {base} + (y.ano_meta - 2024) * 0.5 AS meta_alfabetizacao
        FROM ({rows}) r, (SELECT unnest(range(2024, 2031)) AS ano_meta) y)),
{name} AS (SELECT *, CASE WHEN quality_alerts = '' THEN 'VALID' ELSE 'ALERT' END AS quality_status FROM {name}_tagged WHERE critical = '')"""


_RANGE = "({0} < 0 OR {0} > 100)"
_TARGET_CRITICAL = [
    ("DQ020_TAXA_FORA_INTERVALO", _RANGE.format("taxa")), ("DQ041_META_FORA_INTERVALO", _RANGE.format("meta_alfabetizacao")),
    ("DQ042_PARTICIPACAO_FORA_INTERVALO", _RANGE.format("participacao")),
]
_PUPIL_CRITICAL = _rules(
    ("DQ008_SERIE_NAO_MAPEADA", "serie <> '2'"), ("DQ014_PESO_ALUNO_NAO_POSITIVO", "peso <= 0"),
    ("DQ015_CHAVE_ALUNO_DUPLICADA", "rn > 1"),
)
_PUPIL_ALERTS = _rules(
    ("DQ101_PRESENTE_COM_PROVA_SEM_PROFICIENCIA", "presenca = '1' AND caderno_ok = '1' AND prof IS NULL"),
    ("DQ102_AUSENTE_COM_PROFICIENCIA", "presenca = '0' AND prof IS NOT NULL"),
    ("DQ103_AUSENTE_MARCADO_ALFABETIZADO", "presenca = '0' AND lit = '1'"),
    ("DQ104_PROFICIENCIA_ACIMA_CORTE_NAO_ALFABETIZADO", "prof >= 743 AND lit = '0'"),
    ("DQ105_PROFICIENCIA_ABAIXO_CORTE_ALFABETIZADO", "prof < 743 AND lit = '1'"),
    ("DQ106_PRESENTE_SEM_PESO_ALUNO", "presenca = '1' AND peso IS NULL"),
)


def _kpi_sql(name: str, integrated: str, results: str, extra_columns: str, extra_joins: str) -> str:
    return f"""{name} AS (
  SELECT i.*, h.change, {extra_columns}, k.position, k.percentile, k.quartile,
    CASE k.quartile WHEN 1 THEN 'Q1_MAIS_ALTO' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' WHEN 4 THEN 'Q4_MAIS_BAIXO' ELSE 'SEM_RANKING' END AS faixa_desempenho,
    CASE WHEN i.result IS NULL THEN 'SEM_RESULTADO' WHEN i.target IS NULL THEN 'SEM_META_DO_ANO' WHEN i.gap >= 0 THEN 'ATINGIU_OU_SUPEROU' ELSE 'ABAIXO_DA_META' END AS status_meta
  FROM {integrated} i
  LEFT JOIN (SELECT ano, place, taxa_alfabetizacao - lag(taxa_alfabetizacao) OVER (PARTITION BY place ORDER BY ano) AS change FROM {results}) h
    ON h.ano = i.ano AND h.place = i.place
  LEFT JOIN (SELECT ano, place, rank() OVER (PARTITION BY ano ORDER BY result DESC) AS position,
               percent_rank() OVER (PARTITION BY ano ORDER BY result) AS percentile, ntile(4) OVER (PARTITION BY ano ORDER BY result DESC, place) AS quartile
             FROM {integrated} WHERE result IS NOT NULL) k ON k.ano = i.ano AND k.place = i.place
  {extra_joins})"""


def _integrated_sql(name: str, results: str, targets: str) -> str:
    return f"""{name} AS (
  SELECT coalesce(r.ano, m.ano) AS ano, coalesce(r.place, m.place) AS place, r.taxa_alfabetizacao AS result, r.media_portugues,
    m.meta_alfabetizacao AS target, m.participacao, m.nivel, r.taxa_alfabetizacao - m.meta_alfabetizacao AS gap,
    CASE WHEN m.place IS NULL THEN 'SOMENTE_RESULTADO' WHEN r.place IS NULL THEN 'SOMENTE_META' ELSE 'MATCH' END AS integration_status
  FROM {results} r FULL JOIN (SELECT * FROM {targets} WHERE ano_meta = ano) m ON r.ano = m.ano AND r.place = m.place)"""


CHAIN_SQL = ",\n".join(
    [
        f"codes(t, c, k, v) AS (VALUES {_VALUES})",
        f"""pupils_tagged AS (
  SELECT *, {_PUPIL_CRITICAL} AS critical, {_PUPIL_ALERTS} AS quality_alerts,
    CASE rede WHEN '2' THEN 'Estadual' ELSE 'Municipal' END AS rede_nome
  FROM (SELECT *, row_number() OVER (PARTITION BY ano, id_aluno ORDER BY escola, cidade, caderno, serie, rede, presenca, caderno_ok, lit,
                                     prof NULLS FIRST, peso NULLS FIRST) AS rn
    FROM (SELECT {_year("l_shipdate")} AS ano, (l_suppkey + 1000000)::VARCHAR AS cidade, l_partkey::VARCHAR AS escola,
      l_orderkey || '-' || l_linenumber AS id_aluno, l_linestatus AS caderno, CASE WHEN l_quantity > 49 THEN '3' ELSE '2' END AS serie,
      CASE WHEN l_returnflag = 'N' THEN '2' ELSE '3' END AS rede, CASE WHEN l_discount = 0 THEN '0' ELSE '1' END AS presenca,
      CASE WHEN l_discount = 0 OR l_tax > 0.075 THEN '0' ELSE '1' END AS caderno_ok, CASE WHEN l_extendedprice > 50000 THEN '1' ELSE '0' END AS lit,
      CASE WHEN l_tax <> 0 THEN l_extendedprice / 131 END AS prof, CASE WHEN l_discount < 0.095 THEN (l_quantity - 1) / 10 END AS peso
      FROM lineitem)))""",
        "pupils AS (SELECT *, CASE WHEN quality_alerts = '' THEN 'VALID' ELSE 'ALERT' END AS quality_status FROM pupils_tagged WHERE critical = '')",
        _results_sql("city_results", "municipio", "(l_suppkey + 1000000)::VARCHAR", "lineitem", ""),
        _results_sql("state_results", "uf", f"{_STATE_LIST}[s_nationkey + 1]", "lineitem JOIN supplier ON s_suppkey = l_suppkey", ""),
        _targets_sql(
            "city_targets",
            """SELECT unnest([2023, 2024, 2025]) AS ano, (s_suppkey + 1000000)::VARCHAR AS place, 'Municipal' AS rede, s_acctbal AS b,
            50 + s_acctbal / 700 AS taxa, nullif(s_nationkey % 5, 4) AS nivel, 75 + s_suppkey % 30 AS participacao FROM supplier""",
            "40 + b / 130", "", _rules(*_TARGET_CRITICAL), _rules(("DQ125_NIVEL_ALFABETIZACAO_AUSENTE", "nivel IS NULL")),
        ),
        _targets_sql(
            "state_targets",
            f"""SELECT unnest([2023, 2024, 2025]) AS ano, {_STATE_LIST}[c_nationkey + 1] AS place, 'Pública' AS rede, avg(c_acctbal) AS b,
            50 + avg(c_acctbal) / 700 AS taxa, NULL::INT AS nivel, 82 + c_nationkey % 9 AS participacao FROM customer GROUP BY c_nationkey""",
            "30 + b / 700", "", _rules(*_TARGET_CRITICAL), "''",
        ),
        _targets_sql(
            "national_targets",
            f"""SELECT {_year("o_orderdate")} AS ano, 'BR' AS place, 'Pública' AS rede, avg(o_totalprice) / 5130 AS taxa,
            80 + count(*) % 20 AS participacao FROM orders GROUP BY 1""",
            "49", "", _rules(*_TARGET_CRITICAL), "''",
        ),
        """pupil_agg AS (
  SELECT ano, cidade AS place, rede, rede_nome, count(*) AS alunos, count(*) FILTER (presenca = '1') AS presentes,
    count(*) FILTER (caderno_ok = '1') AS provas, count(*) FILTER (lit = '1') AS alfabetizados,
    100.0 * count(*) FILTER (presenca = '1') / count(*) AS taxa_presenca, 100.0 * count(*) FILTER (caderno_ok = '1') / count(*) AS taxa_preenchimento,
    100.0 * count(*) FILTER (lit = '1') / count(*) AS taxa_calculada, avg(prof) FILTER (presenca = '1') AS prof_media,
    sum(prof * peso) FILTER (presenca = '1') / nullif(sum(peso) FILTER (presenca = '1'), 0) AS prof_ponderada,
    count(*) FILTER (quality_status = 'ALERT') AS alertas
  FROM pupils GROUP BY 1, 2, 3, 4)""",
        "municipal_results AS (SELECT * FROM city_results WHERE rede_nome = 'Municipal')",
        "public_results AS (SELECT * FROM state_results WHERE rede_codigo = '5')",
        _integrated_sql("city_int", "municipal_results", "city_targets"),
        _integrated_sql("state_int", "public_results", "state_targets"),
        """kpi_br AS (
  SELECT a.ano, a.rede, a.taxa AS result, t.meta_alfabetizacao AS target, a.taxa - t.meta_alfabetizacao AS gap,
    a.taxa - lag(a.taxa) OVER (PARTITION BY a.rede ORDER BY a.ano) AS change, a.participacao
  FROM (SELECT DISTINCT ano, rede, taxa, participacao FROM national_targets) a
  LEFT JOIN national_targets t ON t.ano = a.ano AND t.rede = a.rede AND t.ano_meta = a.ano)""",
        _kpi_sql("kpi_state", "state_int", "public_results", "b.result AS br, i.result - b.result AS gap_br", "LEFT JOIN kpi_br b ON b.ano = i.ano"),
        _kpi_sql(
            "kpi_city", "city_int", "municipal_results",
            """a.alunos, a.presentes, a.provas, a.alfabetizados, a.taxa_presenca, a.taxa_preenchimento, a.taxa_calculada, a.prof_media,
            a.prof_ponderada, a.alertas, a.taxa_calculada - i.result AS divergencia""",
            "LEFT JOIN pupil_agg a ON a.ano = i.ano AND a.place = i.place AND a.rede_nome = 'Municipal'",
        ),
    ]
)


def _select(body: str) -> str:
    return f"WITH {CHAIN_SQL}\n{body}"


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def _result_columns(place: str) -> str:
    total = " + ".join(f"coalesce({c}, 0)" for c in _LEVELS)
    levels = ", ".join(_r(c, c) for c in _LEVELS)
    return f"""ano, place AS {place}, '2' AS serie_codigo, '2° ano do Ensino Fundamental' AS serie_nome, rede_codigo, rede_nome, 'Pública' AS rede_agrupada,
      {_r("taxa_alfabetizacao", "taxa_alfabetizacao")}, {_r("media_portugues", "media_portugues")}, {levels},
      filled AS quantidade_niveis_preenchidos, {_r(total, "soma_proporcoes_niveis")}, quality_status, quality_alerts"""


def _kpi_columns(place: str, position: str, digits: int = 6, percent: str = "percentile") -> str:
    return f"""ano, place AS {place}, {_r("result", "taxa_alfabetizacao_resultado", digits)}, {_r("media_portugues", "media_portugues", digits)},
      {_r("target", "meta_alfabetizacao", digits)}, {_r("gap", "gap_meta_pontos_percentuais", digits)}, {_r("change", "variacao_pp_ano_anterior", digits)},
      {_r("participacao", "percentual_participacao", digits)}, position AS {position}, {_r(percent, "percentil_desempenho", digits)},
      quartile AS quartil_desempenho, faixa_desempenho, status_meta, integration_status"""


def _state_columns(digits: int = 6, percent: str = "percentile") -> str:
    return f"""{_kpi_columns("sigla_uf", "posicao_uf", digits, percent)}, {_r("br", "taxa_alfabetizacao_brasil", digits)},
      {_r("gap_br", "gap_brasil_pontos_percentuais", digits)}"""


_PARTICIPATION_BAND = """CASE WHEN participacao IS NULL THEN 'SEM_DADO' WHEN participacao < 80 THEN 'ABAIXO_DE_80'
  WHEN participacao < 90 THEN 'DE_80_A_89_99' ELSE '90_OU_MAIS' END AS faixa_participacao"""


def _pupil_columns(digits: int = 6) -> str:
    return f"""alunos AS quantidade_alunos, presentes AS quantidade_presentes, provas AS quantidade_provas_preenchidas,
      alfabetizados AS quantidade_alfabetizados, {_r("taxa_presenca", "taxa_presenca", digits)}, {_r("taxa_preenchimento", "taxa_preenchimento", digits)},
      {_r("taxa_calculada", "taxa_alfabetizacao_calculada", digits)}, {_r("prof_media", "proficiencia_media", digits)},
      {_r("prof_ponderada", "proficiencia_media_ponderada", digits)}, alertas AS quantidade_registros_com_alerta"""


def _city_columns(digits: int = 6, percent: str = "percentile") -> str:
    return f"""{_kpi_columns("id_municipio", "posicao_nacional_municipio", digits, percent)}, nivel AS nivel_alfabetizacao, {_pupil_columns(digits)},
      {_r("divergencia", "divergencia_microdados_publicado_pp", digits)},
      CASE WHEN gap IS NULL THEN 'SEM_COMPARACAO' WHEN gap < -10 THEN 'ABAIXO_MAIS_DE_10_PP' WHEN gap < -5 THEN 'ABAIXO_DE_5_A_10_PP'
        WHEN gap < 0 THEN 'ABAIXO_ATE_5_PP' ELSE 'META_ATINGIDA_OU_SUPERADA' END AS faixa_gap_meta, {_PARTICIPATION_BAND}"""


def _integration_columns(place: str, level: str) -> str:
    return f"""ano, place AS {place}, {_r("result", "taxa_alfabetizacao_resultado")}, {_r("media_portugues", "media_portugues")},
      {_r("target", "meta_alfabetizacao")}, {_r("participacao", "percentual_participacao")}{level}, {_r("gap", "gap_meta_pontos_percentuais")}, integration_status"""


def _side(name: str, plural: str, singular: str, extra: str = "") -> str:
    return f"""(SELECT ano, count(result) AS {plural}_com_resultado, count(*) FILTER (result IS NOT NULL AND target IS NOT NULL) AS {plural}_comparaveis,
      count(*) FILTER (status_meta = 'ATINGIU_OU_SUPEROU') AS {plural}_atingiram_meta, avg(result) AS media_{plural}, min(result) AS menor_{singular},
      max(result) AS maior_{singular}{extra} FROM {name} GROUP BY ano)"""


def _summary_sql(digits: int, status: bool = False) -> str:
    def block(plural: str, singular: str) -> str:
        return f"""{plural}_com_resultado, {plural}_comparaveis, {plural}_atingiram_meta,
          {_r(f"100.0 * {plural}_atingiram_meta / nullif({plural}_comparaveis, 0)", f"percentual_{plural}_atingiram_meta", digits)},
          {_r(f"media_{plural}", f"media_taxa_{plural}", digits)}, {_r(f"menor_{singular}", f"menor_taxa_{singular}", digits)},
          {_r(f"maior_{singular}", f"maior_taxa_{singular}", digits)}"""

    shown_status = """, CASE WHEN b.target IS NULL THEN 'SEM_META_DO_ANO' WHEN b.gap >= 0 THEN 'ATINGIU_OU_SUPEROU'
      ELSE 'ABAIXO_DA_META' END AS status_meta_brasil""" if status else ""
    return _select(
        f"""SELECT y.ano, {_r("b.result", "taxa_alfabetizacao_brasil", digits)}, {_r("b.target", "meta_brasil", digits)},
        {_r("b.gap", "gap_meta_brasil_pp", digits)}, {_r("b.participacao", "participacao_brasil", digits)}, {block("ufs", "uf")},
        {block("municipios", "municipio")}, {_r("presenca", "media_taxa_presenca_alunos", digits)}{shown_status}
        FROM (SELECT ano FROM kpi_br UNION SELECT ano FROM kpi_state UNION SELECT ano FROM kpi_city) y
        LEFT JOIN kpi_br b ON b.ano = y.ano LEFT JOIN {_side("kpi_state", "ufs", "uf")} u ON u.ano = y.ano
        LEFT JOIN {_side("kpi_city", "municipios", "municipio", ", avg(taxa_presenca) AS presenca")} m ON m.ano = y.ano"""
    )


_PUPILS_SQL = _select(
    f"""SELECT ano, cidade AS id_municipio, escola AS id_escola, id_aluno, caderno AS caderno_codigo, serie AS serie_codigo,
    '2° ano do Ensino Fundamental' AS serie_nome, rede AS rede_codigo, rede_nome, 'Pública' AS rede_agrupada, presenca AS presenca_codigo,
    CASE presenca WHEN '1' THEN 'Presente' ELSE 'Ausente' END AS presenca_nome, caderno_ok AS preenchimento_caderno_codigo,
    CASE caderno_ok WHEN '1' THEN 'Prova preenchida' ELSE 'Prova não preenchida' END AS preenchimento_caderno_nome, lit AS alfabetizado_codigo,
    CASE lit WHEN '1' THEN 'Sim' ELSE 'Não' END AS alfabetizado_nome, {_r("prof", "proficiencia")}, {_r("peso", "peso_aluno")},
    quality_status, quality_alerts FROM pupils"""
)
_QUARANTINE_SQL = _select(
    """SELECT 'alunos' AS source_table, ano || '|' || id_aluno AS record_key, critical AS rules FROM pupils_tagged WHERE critical <> ''
    UNION ALL SELECT 'municipio', ano || '|' || place || '|2|' || rede_codigo, 'DQ009_REDE_NAO_MAPEADA' FROM city_results_tagged WHERE rede_nome IS NULL
    UNION ALL SELECT 'uf', ano || '|' || place || '|2|' || rede_codigo, 'DQ009_REDE_NAO_MAPEADA' FROM state_results_tagged WHERE rede_nome IS NULL
    UNION ALL SELECT 'meta_alfabetizacao_municipio', ano || '|' || place || '|' || rede || '|' || ano_meta, critical FROM city_targets_tagged WHERE critical <> ''
    UNION ALL SELECT 'meta_alfabetizacao_uf', ano || '|' || place || '|' || rede || '|' || ano_meta, critical FROM state_targets_tagged WHERE critical <> ''
    UNION ALL SELECT 'meta_alfabetizacao_brasil', ano || '|' || rede || '|' || ano_meta, critical FROM national_targets_tagged WHERE critical <> ''"""
)
_TARGETS_SQL = _select(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS source, place, ano, rede AS rede_normalizada, ano_meta, round(meta_alfabetizacao, 6) AS meta_alfabetizacao,
        participacao AS percentual_participacao, quality_status, quality_alerts FROM {cte}"""
        for name, cte in (("meta_brasil", "national_targets"), ("meta_uf", "state_targets"), ("meta_municipio", "city_targets"))
    )
)
_PUPIL_RESULTS_SQL = _select(
    f"""SELECT coalesce(a.ano, r.ano) AS ano, coalesce(a.place, r.place) AS id_municipio, coalesce(a.rede_nome, r.rede_nome) AS rede_nome,
    alunos AS quantidade_alunos, presentes AS quantidade_presentes, alfabetizados AS quantidade_alfabetizados, {_r("taxa_presenca", "taxa_presenca")},
    {_r("taxa_calculada", "taxa_alfabetizacao_calculada")}, {_r("prof_media", "proficiencia_media")}, {_r("prof_ponderada", "proficiencia_media_ponderada")},
    {_r("r.taxa_alfabetizacao", "taxa_alfabetizacao_publicada")}, {_r("r.media_portugues", "media_portugues")},
    CASE WHEN r.place IS NULL THEN 'SOMENTE_ALUNOS' WHEN a.place IS NULL THEN 'SOMENTE_RESULTADO' ELSE 'MATCH' END AS integration_status
    FROM pupil_agg a FULL JOIN city_results r ON r.ano = a.ano AND r.place = a.place AND r.rede_nome = a.rede_nome"""
)
_COVERAGE_SQL = _select(
    """SELECT *, round(100.0 * quantidade / sum(quantidade) OVER (PARTITION BY nivel_territorial, ano), 6) AS percentual_cobertura
    FROM (SELECT 'MUNICIPIO' AS nivel_territorial, ano, integration_status, count(*) AS quantidade FROM city_int GROUP BY ALL
          UNION ALL SELECT 'UF', ano, integration_status, count(*) FROM state_int GROUP BY ALL)"""
)
_DISTRIBUTION_SQL = _select(
    "\nUNION ALL ".join(
        f"""SELECT ano, place AS sigla_uf, rede_nome, {i} AS nivel_proficiencia, round({c}, 6) AS proporcao_alunos, {c} IS NOT NULL AS dado_disponivel
        FROM public_results"""
        for i, c in s.LEVEL_COLUMNS.items()
    )
)
_FEATURES_SQL = _select(
    f"""SELECT ano, place AS id_municipio, {_r("result", "taxa_alfabetizacao_resultado")}, {_r("media_portugues", "media_portugues")},
    {_r("target", "meta_alfabetizacao")}, {_r("gap", "gap_meta_pontos_percentuais")}, {_r("participacao", "percentual_participacao")},
    nivel AS nivel_alfabetizacao, {_r("change", "variacao_pp_ano_anterior")}, alunos AS quantidade_alunos, presentes AS quantidade_presentes,
    alfabetizados AS quantidade_alfabetizados, {_r("taxa_presenca", "taxa_presenca")}, {_r("taxa_preenchimento", "taxa_preenchimento")},
    {_r("taxa_calculada", "taxa_alfabetizacao_calculada")}, {_r("prof_media", "proficiencia_media")}, {_r("prof_ponderada", "proficiencia_media_ponderada")},
    integration_status, status_meta, lead(ano) OVER w AS target_ano, round(lead(result) OVER w, 6) AS target_taxa_alfabetizacao_proximo_ano,
    lead(status_meta) OVER w AS target_status_meta_proximo_ano,
    coalesce(lead(ano) OVER w = ano + 1 AND lead(result) OVER w IS NOT NULL, FALSE) AS possui_target_ano_seguinte
    FROM kpi_city WINDOW w AS (PARTITION BY place ORDER BY ano)"""
)
_BRASIL_SQL = _select(
    f"""SELECT ano, rede AS rede_normalizada, {_r("result", "taxa_alfabetizacao_resultado")}, {_r("target", "meta_alfabetizacao")},
    {_r("gap", "gap_meta_pontos_percentuais")}, {_r("change", "variacao_pp_ano_anterior")}, participacao AS percentual_participacao,
    CASE WHEN target IS NULL THEN 'SEM_META_DO_ANO' WHEN gap >= 0 THEN 'ATINGIU_OU_SUPEROU' ELSE 'ABAIXO_DA_META' END AS status_meta,
    {_PARTICIPATION_BAND} FROM kpi_br"""
)


def _suite_sql(rows: list[tuple[str, str, str, str]]) -> str:
    """Check rows from (kind, name, expected, actual), where both sides are SQL over the chain's tables."""
    checks = "\nUNION ALL ".join(f"SELECT '{kind}' AS check_type, '{name}' AS object_name, {e} AS expected_value, {a} AS actual_value" for kind, name, e, a in rows)
    return _select(f"SELECT *, CASE WHEN expected_value = actual_value THEN 'OK' ELSE 'FAIL' END AS status FROM ({checks})")


def _n(source: str, condition: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {source} WHERE {condition})"


def _repeated(source: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1))"


def _contradicting(query: str) -> str:
    return _n(
        f"({query})",
        """(status_meta = 'ATINGIU_OU_SUPEROU' AND gap_meta_pontos_percentuais < 0) OR (status_meta = 'ABAIXO_DA_META' AND gap_meta_pontos_percentuais >= 0)
        OR (status_meta = 'SEM_RESULTADO' AND taxa_alfabetizacao_resultado IS NOT NULL) OR (status_meta = 'SEM_META_DO_ANO' AND meta_alfabetizacao IS NOT NULL)""",
    )


def _silver_suite_sql() -> str:
    kinds = "(year(l_shipdate) - 1995) % 3"
    sides = {
        "dicionario": ("27", "27"),
        "alunos": (_n("lineitem"), f"{_n('pupils')} + {_n('pupils_tagged', "critical <> ''")}"),
        "municipio": (_n(f"(SELECT DISTINCT {kinds}, l_suppkey, l_returnflag FROM lineitem)"), f"{_n('city_results')} + {_n('city_results_tagged', 'rede_nome IS NULL')}"),
        "uf": (
            _n(f"(SELECT DISTINCT {kinds}, s_nationkey, l_returnflag FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)"),
            f"{_n('state_results')} + {_n('state_results_tagged', 'rede_nome IS NULL')}",
        ),
    }
    expected = {
        "municipio": ("city", _n("supplier")), "uf": ("state", "(SELECT count(DISTINCT c_nationkey) FROM customer)"),
        "brasil": ("national", "(SELECT count(DISTINCT (year(o_orderdate) - 1995) % 3) FROM orders)"),
    }
    for name, (cte, places) in expected.items():
        rejected = _n(f"{cte}_targets_tagged", "critical <> ''")
        sides[f"meta_alfabetizacao_{name}"] = (f"{7 if name == 'brasil' else 21} * {places}", f"{_n(f'{cte}_targets')} + {rejected}")
    rows = [("RECONCILIATION", name, *both) for name, both in sides.items()]
    rows.append(("UNIQUENESS", "alunos", "0", _repeated("pupils", "ano, cidade, escola, id_aluno")))
    for name, cte in (("resultado_municipio", "city_results"), ("resultado_uf", "state_results")):
        rows.append(("UNIQUENESS", name, "0", _repeated(cte, "ano, place, rede_codigo")))
        rows.append(("VALIDITY", f"taxas_{name}", "0", _n(cte, "NOT taxa_alfabetizacao BETWEEN 0 AND 100")))
    targets = " + ".join(_n(f"{cte}_targets", "NOT meta_alfabetizacao BETWEEN 0 AND 100") for cte, _ in expected.values())
    return _suite_sql([*rows, ("VALIDITY", "metas", "0", targets)])


def _gold_suite_sql() -> str:
    state, city = (_select(f"SELECT {columns} FROM {cte}") for columns, cte in ((_state_columns(), "kpi_state"), (_city_columns(), "kpi_city")))
    kpis = {"brasil": _BRASIL_SQL, "uf": state, "municipio": city}
    cells = f"({_COVERAGE_SQL})"
    years = " UNION ".join(f"SELECT ano FROM ({q})" for q in kpis.values())
    statuses = " + ".join(_n(f"(SELECT DISTINCT ano, integration_status FROM {cte})") for cte in ("city_int", "state_int"))
    outside = {c: " + ".join(_n(f"({q})", f"NOT {c} BETWEEN 0 AND 100") for q in kpis.values()) for c in ("taxa_alfabetizacao_resultado", "percentual_participacao")}
    uneven = f"(SELECT 1 FROM {cells} GROUP BY nivel_territorial, ano HAVING abs(sum(percentual_cobertura) - 100) > 0.0001)"
    return _suite_sql([
        ("RECONCILIATION", "kpi_brasil", _n("(SELECT DISTINCT ano, rede FROM national_targets)"), _n(f"({_BRASIL_SQL})")),
        ("RECONCILIATION", "kpi_uf", _n("state_int"), _n(f"({state})")),
        ("RECONCILIATION", "kpi_municipio", _n("city_int"), _n(f"({city})")),
        ("RECONCILIATION", "cobertura_integracao", statuses, _n(cells)),
        ("RECONCILIATION", "distribuicao_niveis_uf", f"{len(s.LEVEL_COLUMNS)} * {_n('public_results')}", _n(f"({_DISTRIBUTION_SQL})")),
        ("RECONCILIATION", "resumo_executivo", _n(f"({years})"), _n(f"({_summary_sql(6)})")),
        ("RECONCILIATION", "features_modelo_municipio", _n(f"({city})"), _n(f"({_FEATURES_SQL})")),
        ("UNIQUENESS", "kpi_brasil", "0", _repeated(f"({_BRASIL_SQL})", "ano, rede_normalizada")),
        ("UNIQUENESS", "kpi_uf", "0", _repeated(f"({state})", "ano, sigla_uf")),
        ("UNIQUENESS", "kpi_municipio", "0", _repeated(f"({city})", "ano, id_municipio")),
        ("UNIQUENESS", "cobertura_integracao", "0", _repeated(cells, "nivel_territorial, ano, integration_status")),
        ("VALIDITY", "taxas_gold", "0", outside["taxa_alfabetizacao_resultado"]),
        ("VALIDITY", "participacao_gold", "0", outside["percentual_participacao"]),
        ("VALIDITY", "percentual_cobertura", "0", _n(cells, "NOT percentual_cobertura BETWEEN 0 AND 100")),
        ("CONSISTENCY", "soma_percentual_cobertura", "0", _n(uneven)),
        ("CONSISTENCY", "features_target_ano", "0", _n(f"({_FEATURES_SQL})", "possui_target_ano_seguinte AND target_ano <> ano + 1")),
        *(("CONSISTENCY", f"status_meta_{name}", "0", _contradicting(q)) for name, q in kpis.items()),
    ])


QUERIES: dict[str, Query] = {
    "literacy_pupils": Query(_of("alunos"), _PUPILS_SQL),
    "literacy_city_results": Query(_of("resultado_municipio"), _select(f"SELECT {_result_columns('id_municipio')} FROM city_results")),
    "literacy_state_results": Query(_of("resultado_uf"), _select(f"SELECT {_result_columns('sigla_uf')} FROM state_results")),
    "literacy_targets": Query(targets_query, _TARGETS_SQL),
    "literacy_quarantine": Query(quarantine_query, _QUARANTINE_SQL),
    "literacy_pupil_aggregate": Query(
        _of("agg_alunos_municipio"),
        _select(f"SELECT ano, place AS id_municipio, rede AS rede_codigo, rede_nome, 'Pública' AS rede_agrupada, {_pupil_columns()} FROM pupil_agg"),
    ),
    "literacy_pupils_with_results": Query(_of("int_alunos_resultado_municipio"), _PUPIL_RESULTS_SQL),
    "literacy_city_integration": Query(
        _of("int_municipio_meta"), _select(f"SELECT {_integration_columns('id_municipio', ', nivel AS nivel_alfabetizacao')} FROM city_int")
    ),
    "literacy_state_integration": Query(_of("int_uf_meta"), _select(f"SELECT {_integration_columns('sigla_uf', '')} FROM state_int")),
    "literacy_national_integration": Query(
        _of("int_brasil_meta"),
        _select(f"""SELECT ano, rede AS rede_normalizada, {_r("taxa", "taxa_alfabetizacao_resultado")}, {_r("meta_alfabetizacao", "meta_alfabetizacao")},
        participacao AS percentual_participacao, {_r("taxa - meta_alfabetizacao", "gap_meta_pontos_percentuais")} FROM national_targets WHERE ano_meta = ano"""),
    ),
    "literacy_kpi_national": Query(_of("kpi_brasil"), _BRASIL_SQL),
    "literacy_kpi_state": Query(_of("kpi_uf"), _select(f"SELECT {_state_columns()} FROM kpi_state")),
    "literacy_kpi_city": Query(_of("kpi_municipio"), _select(f"SELECT {_city_columns()} FROM kpi_city")),
    "literacy_coverage": Query(_of("cobertura_integracao"), _COVERAGE_SQL),
    "literacy_level_distribution": Query(_of("distribuicao_niveis_uf"), _DISTRIBUTION_SQL),
    "literacy_summary": Query(_of("resumo_executivo"), _summary_sql(6)),
    "literacy_features": Query(_of("features_modelo_municipio"), _FEATURES_SQL),
    "literacy_dashboard_national": Query(dashboards_query("resumo_executivo", national_view), _summary_sql(2, status=True)),
    "literacy_dashboard_state": Query(
        dashboards_query("kpi_uf", state_view), _select(f"SELECT {_state_columns(2, '100 * percentile')} FROM kpi_state")
    ),
    "literacy_dashboard_city": Query(
        dashboards_query("kpi_municipio", city_view), _select(f"SELECT {_city_columns(2, '100 * percentile')} FROM kpi_city")
    ),
    "literacy_silver_suite": Query(silver_suite, _silver_suite_sql()),
    "literacy_gold_suite": Query(gold_suite, _gold_suite_sql()),
}
