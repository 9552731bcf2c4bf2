from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from literacy_data import AT, BATCH, DICTIONARY, clean_sources, frame, pupil, result, target
from plumbline.operators.checks import CheckFailure
from plumbline.plans.literacy import rules, runner
from plumbline.plans.literacy import schemas as s
from plumbline.plans.literacy.silver import QUARANTINE, SOURCE_PLANS, pupils_with_results
from plumbline.sources.snapshots import read_snapshot, snapshot_checks, with_lineage, write_snapshot
from plumbline.sources.tables import Store


def bronze(df):
    return with_lineage(df, AT, BATCH, "src").withColumns(
        {"ingestion_date": F.lit(AT.date()), "batch_id": F.lit(BATCH)}
    )


@pytest.fixture(scope="module")
def codes(spark):
    plan = SOURCE_PLANS["dicionario"]
    return plan.clean(plan.tagged(bronze(frame(spark, "dicionario", DICTIONARY)), None), F.lit(None)).cache()


def tag(spark, name, rows, codes):
    return SOURCE_PLANS[name].tagged(bronze(frame(spark, name, rows)), codes)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("literacy"))
    sources = clean_sources(spark)
    runner.ingest(spark, sources, f"{base}/bronze", AT, BATCH, "origin")
    tables = runner.run_batch(spark, f"{base}/bronze", f"{base}/wh", AT.date(), BATCH, AT)
    return base, sources, tables


def test_rule_catalogue_size(spark):
    books = rules.rule_books()
    assert sum(len(b.critical) for b in books.values()) == 61
    assert sum(len(b.alert) for b in books.values()) == 29
    assert len({i for b in books.values() for i in b.ids()}) == 51


def test_all_suites_hold_on_clean_data(run):
    _, _, t = run
    silver = t["latest_silver_validation"].collect()
    gold = t["latest_gold_validation"].collect()
    assert len(silver) == 13 and {r.status for r in silver} == {"OK"}
    assert len(gold) == 19 and {r.status for r in gold} == {"OK"}


def test_published_run_is_found(spark, run):
    base, _, t = run
    store = Store.current(spark, f"{base}/wh")
    assert store.read("kpi_brasil").count() == t["kpi_brasil"].count() == 3


def test_national_kpi_golden(run):
    rows = {r.ano: r for r in run[2]["kpi_brasil"].collect()}
    assert rows[2023].meta_alfabetizacao is None and rows[2023].status_meta == "SEM_META_DO_ANO"
    assert rows[2023].variacao_pp_ano_anterior is None
    assert round(rows[2024].gap_meta_pontos_percentuais, 6) == -0.7
    assert round(rows[2024].variacao_pp_ano_anterior, 6) == 3.3
    assert rows[2024].status_meta == "ABAIXO_DA_META"
    assert round(rows[2025].gap_meta_pontos_percentuais, 6) == 2.0
    assert round(rows[2025].variacao_pp_ano_anterior, 6) == 6.8
    assert rows[2025].status_meta == "ATINGIU_OU_SUPEROU"
    assert {r.faixa_participacao for r in rows.values()} == {"DE_80_A_89_99"}
    assert run[2]["meta_brasil"].count() == 21


def test_state_change_is_against_previous_row_despite_gap(run):
    rows = run[2]["kpi_uf"].filter("sigla_uf = 'SP'").orderBy("ano").collect()
    assert [r.ano for r in rows] == [2023, 2024, 2025]
    assert [r.integration_status for r in rows] == ["SOMENTE_RESULTADO", "SOMENTE_META", "MATCH"]
    assert rows[2].variacao_pp_ano_anterior == 0.0
    assert rows[1].faixa_desempenho == "SEM_RANKING" and rows[1].status_meta == "SEM_RESULTADO"
    assert [rows[0].posicao_uf, rows[0].percentil_desempenho, rows[0].quartil_desempenho] == [4, 0.0, 4]


def test_features_have_consecutive_targets(run):
    rows = run[2]["features_modelo_municipio"].filter("id_municipio = '3550308'").orderBy("ano").collect()
    assert [r.target_ano for r in rows] == [2024, 2025, None]
    assert [r.possui_target_ano_seguinte for r in rows] == [True, True, False]


def test_summary_and_coverage(run):
    t = run[2]
    summary = {r.ano: r for r in t["resumo_executivo"].collect()}
    assert summary[2025].municipios_com_resultado == 5 and summary[2025].ufs_comparaveis == 4
    assert t["distribuicao_niveis_uf"].count() == 8 * 9
    shares = t["cobertura_integracao"].groupBy("nivel_territorial", "ano").agg(F.sum("percentual_cobertura").alias("t"))
    assert all(abs(r.t - 100) < 1e-9 for r in shares.collect())


def test_silver_columns_follow_layout(run):
    t = run[2]
    assert "is_repeat" not in t["alunos"].columns and "critical_rules" not in t["alunos"].columns
    assert t["dim_dicionario"].columns[-1] == "silver_processed_at" and "batch_id" not in t["dim_dicionario"].columns


PUPIL_CASES = [
    (dict(year=None), ["DQ001_ANO_AUSENTE"]),
    (dict(year=2019), ["DQ002_ANO_FORA_INTERVALO"]),
    (dict(city=None), ["DQ003_ID_MUNICIPIO_AUSENTE"]),
    (dict(city=""), ["DQ003_ID_MUNICIPIO_AUSENTE", "DQ004_ID_MUNICIPIO_INVALIDO"]),
    (dict(city="355030"), ["DQ004_ID_MUNICIPIO_INVALIDO"]),
    (dict(school=" "), ["DQ005_ID_ESCOLA_AUSENTE"]),
    (dict(pid=None), ["DQ006_ID_ALUNO_AUSENTE"]),
    (dict(booklet_id=None), ["DQ007_CADERNO_AUSENTE"]),
    (dict(grade="9"), ["DQ008_SERIE_NAO_MAPEADA"]),
    (dict(network="9"), ["DQ009_REDE_NAO_MAPEADA"]),
    (dict(present="7"), ["DQ010_PRESENCA_NAO_MAPEADA"]),
    (dict(booklet="7"), ["DQ011_PREENCHIMENTO_NAO_MAPEADO"]),
    (dict(literate="7"), ["DQ012_ALFABETIZADO_NAO_MAPEADO"]),
    (dict(score=-1.0, literate="0"), ["DQ013_PROFICIENCIA_NEGATIVA"]),
    (dict(weight=0.0), ["DQ014_PESO_ALUNO_NAO_POSITIVO"]),
    (dict(year=2036, city="x", weight=-1.0),
     ["DQ002_ANO_FORA_INTERVALO", "DQ004_ID_MUNICIPIO_INVALIDO", "DQ014_PESO_ALUNO_NAO_POSITIVO"]),
    (dict(network="\t3 ", city="3550308\n"), []),
]


def test_each_pupil_rule_alone(spark, codes):
    rows = []
    for i, (change, _) in enumerate(PUPIL_CASES):
        values = {"pid": f"P{i}"} | change
        rows.append(pupil(**{**values, "school": values.get("school", f"E{i}") if i != 5 else " "}))
    tagged = tag(spark, "alunos", rows, codes)
    got = {}
    for r in tagged.collect():
        got.setdefault(tuple(r.critical_rules), 0)
        got[tuple(r.critical_rules)] += 1
    want = {}
    for _, ids in PUPIL_CASES:
        want.setdefault(tuple(ids), 0)
        want[tuple(ids)] += 1
    assert got == want


def test_pupil_alerts(spark, codes):
    cases = {
        "a": (dict(score=None), ["DQ101_PRESENTE_COM_PROVA_SEM_PROFICIENCIA"]),
        "b": (dict(present="0", literate="0", score=700.0), ["DQ102_AUSENTE_COM_PROFICIENCIA"]),
        "c": (dict(present="0", score=None, booklet="0"), ["DQ103_AUSENTE_MARCADO_ALFABETIZADO"]),
        "d": (dict(score=743.0, literate="0"), ["DQ104_PROFICIENCIA_ACIMA_CORTE_NAO_ALFABETIZADO"]),
        "e": (dict(score=742.9), ["DQ105_PROFICIENCIA_ABAIXO_CORTE_ALFABETIZADO"]),
        "f": (dict(weight=None), ["DQ106_PRESENTE_SEM_PESO_ALUNO"]),
        "g": ({}, []),
    }
    tagged = tag(spark, "alunos", [pupil(pid=k, **v[0]) for k, v in cases.items()], codes)
    assert {r.id_aluno: r.alert_rules for r in tagged.collect()} == {k: v[1] for k, v in cases.items()}
    statuses = {r.id_aluno: r.quality_status for r in SOURCE_PLANS["alunos"].clean(tagged, F.lit(None)).collect()}
    assert statuses == {k: "ALERT" if v[1] else "VALID" for k, v in cases.items()}


def test_duplicate_keys_including_null(spark, codes):
    rows = [pupil(pid="X", school="E2"), pupil(pid="X", school="E1"), pupil(pid=None, school="E1"), pupil(pid=None, school="E2")]
    got = {(r.id_aluno, r.id_escola): r.critical_rules for r in tag(spark, "alunos", rows, codes).collect()}
    assert got[("X", "E1")] == [] and got[("X", "E2")] == ["DQ015_CHAVE_ALUNO_DUPLICADA"]
    assert got[(None, "E1")] == ["DQ006_ID_ALUNO_AUSENTE"]
    assert got[(None, "E2")] == ["DQ006_ID_ALUNO_AUSENTE", "DQ015_CHAVE_ALUNO_DUPLICADA"]


def test_result_rules(spark, codes):
    def levels(total):
        return [10.0] * 8 + [round(total - 80.0, 2)]

    cases = {
        "1000001": (dict(levels=levels(99.89)), [], ["DQ114_SOMA_NIVEIS_FORA_TOLERANCIA"]),
        "1000002": (dict(levels=levels(99.95)), [], []),
        "1000003": (dict(levels=levels(100.11)), [], ["DQ114_SOMA_NIVEIS_FORA_TOLERANCIA"]),
        "1000004": (dict(levels=[10.0] * 8 + [None]), [], ["DQ113_NIVEIS_PARCIALMENTE_INFORMADOS"]),
        "1000005": (dict(levels=[None] * 9), [], ["DQ112_NIVEIS_NAO_INFORMADOS"]),
        "1000006": (dict(levels=[100.5] + [None] * 8), ["DQ022_PROPORCAO_NIVEL_FORA_INTERVALO"],
                    ["DQ113_NIVEIS_PARCIALMENTE_INFORMADOS"]),
        "1000007": (dict(rate=100.01), ["DQ020_TAXA_FORA_INTERVALO"], []),
        "1000008": (dict(mean=-0.1), ["DQ021_MEDIA_PORTUGUES_NEGATIVA"], []),
        "1000009": (dict(rate=None, mean=None), [], ["DQ110_TAXA_ALFABETIZACAO_AUSENTE", "DQ111_MEDIA_PORTUGUES_AUSENTE"]),
        "1000010": (dict(rate=float("nan")), ["DQ020_TAXA_FORA_INTERVALO"], []),
    }
    rows = [result(2024, k, **v[0]) for k, v in cases.items()] + [result(2024, "1000002", rate=1.0)]
    got = tag(spark, "municipio", rows, codes).collect()
    dup = [r for r in got if "DQ023_CHAVE_RESULTADO_MUNICIPIO_DUPLICADA" in r.critical_rules]
    assert len(dup) == 1 and dup[0].id_municipio == "1000002"
    rest = {r.id_municipio: (r.critical_rules, r.alert_rules) for r in got if r is not dup[0]}
    assert rest == {k: (v[1], v[2]) for k, v in cases.items()}


def test_state_codes_and_target_networks(spark, codes):
    got = {r.sigla_uf: r.critical_rules for r in tag(spark, "uf", [result(2024, u) for u in (" sp", "XX", "")], codes).collect()}
    assert got == {"SP": [], "XX": ["DQ031_SIGLA_UF_INVALIDA"], "": ["DQ030_SIGLA_UF_AUSENTE", "DQ031_SIGLA_UF_INVALIDA"]}
    rows = [target(2024, None, n) for n in ("PÚBLICA ", "municipal", "Outra", None)]
    tagged = tag(spark, "meta_alfabetizacao_brasil", rows, codes)
    assert tagged.count() == 28
    names = {r.rede_normalizada: (r.critical_rules, r.alert_rules) for r in tagged.collect()}
    assert names["Pública"] == ([], [])
    assert names["Municipal"] == ([], ["DQ120_REDE_META_BRASIL_INESPERADA"])
    assert names[None] == (["DQ040_REDE_META_AUSENTE"], [])


def test_quarantine_layout(spark, codes):
    plan = SOURCE_PLANS["alunos"]
    rows = [pupil(pid="Q1", weight=0.0, score=None, year=2019), pupil(pid="Q2", year=None)]
    q = {r.record_key: r for r in plan.quarantined("alunos", tag(spark, "alunos", rows, codes), F.lit(None)).collect()}
    assert set(q) == {"2019|Q1", None}
    r = q["2019|Q1"]
    assert r.quality_message == (
        "Registro rejeitado pelas regras: DQ002_ANO_FORA_INTERVALO; DQ014_PESO_ALUNO_NAO_POSITIVO"
    )
    assert '"proficiencia":null' in r.payload_json and "is_repeat" not in r.payload_json
    assert r.quality_severity == "CRITICAL" and r.source_table == "alunos"


def test_residual_full_join_keeps_other_grades(spark):
    pupils = spark.createDataFrame(
        [(2024, dt.date(2024, 1, 1), "1", "Municipal", 5, 4, 3, 80.0, 60.0, 700.0, 701.0)],
        "ano long, ano_referencia date, id_municipio string, rede_nome string, quantidade_alunos long,"
        "quantidade_presentes long, quantidade_alfabetizados long, taxa_presenca double,"
        "taxa_alfabetizacao_calculada double, proficiencia_media double, proficiencia_media_ponderada double",
    )
    results = spark.createDataFrame(
        [(2024, dt.date(2024, 1, 1), "1", "Municipal", g, r, 700.0) for g, r in (("2", 61.0), ("5", 62.0))]
        + [(2024, dt.date(2024, 1, 1), "2", None, "2", 63.0, 700.0)],
        "ano long, ano_referencia date, id_municipio string, rede_nome string, serie_codigo string,"
        "taxa_alfabetizacao double, media_portugues double",
    )
    out = pupils_with_results({"agg_alunos_municipio": pupils, "resultado_municipio": results}, F.lit(None)).collect()
    got = sorted((r.integration_status, r.taxa_alfabetizacao_publicada) for r in out)
    assert got == [("MATCH", 61.0), ("SOMENTE_RESULTADO", 62.0), ("SOMENTE_RESULTADO", 63.0)]


def test_weighted_mean_keeps_weight_without_score(spark, codes):
    from plumbline.plans.literacy.silver import pupil_aggregate

    plan = SOURCE_PLANS["alunos"]
    rows = [pupil(pid="1", score=800.0, weight=1.0), pupil(pid="2", score=None, weight=3.0),
            pupil(pid="3", city="3304557", present="0", score=None, literate="0")]
    clean = plan.clean(tag(spark, "alunos", rows, codes), F.lit(None))
    got = {r.id_municipio: r for r in pupil_aggregate({"alunos": clean}, F.lit(None)).collect()}
    assert got["3550308"].proficiencia_media == 800.0 and got["3550308"].proficiencia_media_ponderada == 200.0
    assert got["3304557"].proficiencia_media is None and got["3304557"].proficiencia_media_ponderada is None


def test_bad_rows_are_quarantined_and_the_gate_refuses_failed_checks(spark, tmp_path):
    sources = clean_sources(spark)
    sources["meta_alfabetizacao_brasil"] = frame(
        spark, "meta_alfabetizacao_brasil",
        [target(2024, None, "Pública", rate=59.0), target(2025, None, "Pública", rate=60.0)],
    ).union(frame(spark, "meta_alfabetizacao_brasil", [target(2024, None, "Municipal", rate=120.0)]))
    base = str(tmp_path)
    runner.ingest(spark, sources, f"{base}/bronze", AT, BATCH, "o")
    tables = runner.run_batch(spark, f"{base}/bronze", f"{base}/wh", AT.date(), BATCH, AT)
    assert tables[QUARANTINE].count() == 7
    broken = tables["latest_silver_validation"].withColumn("status", F.lit("FAIL"))
    from plumbline.operators.checks import gate

    with pytest.raises(CheckFailure, match="RECONCILIATION alunos"):
        gate(broken)


def test_snapshots_are_never_overwritten(spark, tmp_path):
    df = frame(spark, "dicionario", DICTIONARY)
    base = str(tmp_path)
    write_snapshot(df, base, "dicionario", AT, BATCH, "o.d")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_snapshot(df, base, "dicionario", AT, BATCH, "o.d")
    write_snapshot(df.limit(3), base, "dicionario", AT, "batch_other", "o.d")
    snap = read_snapshot(spark, base, "dicionario", AT.date(), BATCH, s.SOURCES["dicionario"])
    assert snap.count() == len(DICTIONARY) == 27
    assert {"_ingestion_timestamp", "_batch_id", "_source_table", "ingestion_date", "batch_id"} <= set(snap.columns)
    checks = snapshot_checks(spark, {"dicionario": (df, snap), "short": (df.limit(5), snap)}, F.lit(None)).collect()
    assert {r.object_name: r.status for r in checks} == {"dicionario": "OK", "short": "FAIL"}
