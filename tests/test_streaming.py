from __future__ import annotations

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import observe
from plumbline.plans.literacy import suites
from plumbline.session import stage
from plumbline.sources import files
from plumbline.sources.messages import MESSAGE_SCHEMA, file_messages, from_kafka_layout
from plumbline.streaming import contract as c
from plumbline.streaming import epochs, router, views
from plumbline.streaming.alerts import AlertPolicy, alert_episodes, sustained_breaches

RUN = "blue-run-7"
T0 = dt.datetime(2027, 3, 4, 9, 30, 0)
RECEIVED = dt.datetime(2027, 3, 4, 9, 41, 5)

IND, STATE_IND, CITY_META = "indicador_municipio_atualizado", "indicador_uf_atualizado", "meta_municipio_atualizada"
META, PUPIL = "meta_uf_atualizada", "resultado_aluno_recebido"

# One valid entity and payload per event type.
ENTITY = {IND: "4205407", STATE_IND: "SC", CITY_META: "2611606", META: "PE", PUPIL: "turma-b.17"}
PAYLOAD = {
    IND: {"ano": 2027, "rede": "Estadual", "taxa_alfabetizacao": 48.25, "percentual_participacao": 77.0},
    STATE_IND: {"ano": 2026, "rede": "Federal", "taxa_alfabetizacao": 52.75, "percentual_participacao": 83.5},
    CITY_META: {"ano": 2027, "ano_meta": 2029, "rede": "Estadual", "meta_alfabetizacao": 66.0},
    META: {"ano": 2026, "ano_meta": 2028, "rede": "Federal", "meta_alfabetizacao": 64.5},
    PUPIL: {"ano": 2027, "id_municipio": "1501402", "rede": "Privada", "proficiencia": 612.0, "alfabetizado": False},
}


def event(kind, payload=None, drop=(), number=0, **changes):
    """The body of a valid event of this type, with changes to its payload and envelope."""
    body = {
        "source": "tests", "schema_version": "1.0", "simulation_run_id": RUN, "event_id": f"ev-{number}",
        "event_time": f"{(T0 + dt.timedelta(minutes=number)).isoformat()}+00:00", "event_type": kind,
        "entity_type": c.EVENT_TYPES[kind], "entity_id": ENTITY[kind], "payload": PAYLOAD[kind] | (payload or {}),
    } | changes
    for path in drop:
        holder, _, name = path.rpartition(".")
        del (body[holder] if holder else body)[name]
    return body


def message(body, number=0, **attributes):
    """A message as the source hands it over; the body is an object or raw text."""
    text = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False)
    return text, {"simulation_run_id": RUN, **attributes}, f"msg/{number}", T0 + dt.timedelta(minutes=number, milliseconds=250)


# A run with each event type and each way to fail: text cut off, no source, a year too early, a share below zero.
RUN_BODIES = [
    event(IND, number=0), event(IND, number=1, entity_id="1501402"), event(STATE_IND, number=2), event(STATE_IND, number=3, entity_id="PA"),
    event(CITY_META, number=4), event(META, number=5), event(PUPIL, number=6), event(PUPIL, number=7, entity_id="turma-c.02"),
    '[{"event_id": "ev-8"', event(META, drop=["source"], number=9), event(CITY_META, {"ano": 1999}, number=10), event(STATE_IND, {"taxa_alfabetizacao": -3.0}, number=11),
]
VALID, BROKEN = 8, 4
RUN_MESSAGES = [message(body, number, event_id=f"ev-{number}") for number, body in enumerate(RUN_BODIES)]


def judged(spark, messages):
    df = spark.createDataFrame(messages, MESSAGE_SCHEMA)
    return stage(c.judge(df), "judged")


def at():
    return F.lit(RECEIVED.isoformat(sep=" ")).cast("timestamp")


ERRORS = [
    (event(IND, event_id=" "), None, c.NO_EVENT_ID),
    (event(IND, simulation_run_id=" "), "x", c.NO_RUN_ID),
    (event(IND, event_type="outro"), "x", c.BAD_EVENT_TYPE),
    (event(IND, event_type=5), "x", c.BAD_EVENT_TYPE),
    (event(IND, schema_version="2.0"), "x", c.BAD_VERSION),
    (event(IND, entity_type="uf"), "x", c.BAD_ENTITY_TYPE),
    (event(IND, entity_id=""), "x", c.NO_ENTITY_ID),
    (event(IND, entity_id="42054071"), "x", c.BAD_CITY_ID),
    (event(META, entity_id="S1"), "x", c.BAD_STATE_ID),
    (event(PUPIL, entity_id="ab"), "x", c.BAD_PUPIL_ID),
    (event(IND, source=None), "x", c.NO_SOURCE),
    (event(IND) | {"payload": [1]}, "x", c.BAD_PAYLOAD),
    (event(IND, event_time=5), "x", c.TIME_NOT_TEXT),
    (event(IND, event_time=" "), "x", c.TIME_NOT_TEXT),
    (event(IND, event_time="2027-03-04T09:30:00"), "x", c.TIME_NO_ZONE),
    (event(IND, event_time="2027-03-04"), "x", c.TIME_NO_ZONE),
    (event(IND, event_time="amanhã cedo"), "x", "Invalid isoformat string: 'amanhã cedo'"),
    (event(IND, event_time="2027-02-30T09:30:00Z"), "x", "Invalid isoformat string: '2027-02-30T09:30:00+00:00'"),
    (event(IND, drop=["payload.ano"]), "x", "payload.ano é obrigatório"),
    (event(IND, {"ano": True}), "x", "ano deve ser inteiro"),
    (event(IND, {"ano": "2027.5"}), "x", "ano deve ser inteiro"),
    (event(IND, {"ano": [2027]}), "x", "ano deve ser inteiro"),
    (event(IND, {"ano": 2022}), "x", c.BAD_YEAR),
    (event(IND, {"ano": 2036}), "x", c.BAD_YEAR),
    (event(IND, {"ano": 10**30}), "x", c.BAD_YEAR),
    (event(IND, {"taxa_alfabetizacao": ""}), "x", "payload.taxa_alfabetizacao é obrigatório"),
    (event(IND, {"taxa_alfabetizacao": "abc"}), "x", "taxa_alfabetizacao deve ser numérico"),
    (event(IND, {"taxa_alfabetizacao": False}), "x", "taxa_alfabetizacao deve ser numérico"),
    (event(IND, {"taxa_alfabetizacao": "nan"}), "x", "taxa_alfabetizacao deve estar entre 0 e 100"),
    (event(IND, {"percentual_participacao": ""}), "x", "percentual_participacao deve ser numérico"),
    (event(IND, {"percentual_participacao": -0.1}), "x", "percentual_participacao deve estar entre 0 e 100"),
    (event(META, {"ano_meta": 2023}), "x", c.BAD_TARGET_YEAR),
    (event(META, {"ano_meta": 2031}), "x", c.BAD_TARGET_YEAR),
    (event(META, {"meta_alfabetizacao": None}), "x", "payload.meta_alfabetizacao é obrigatório"),
    (event(PUPIL, {"id_municipio": "15014"}), "x", c.BAD_PAYLOAD_CITY),
    (event(PUPIL, {"proficiencia": -1}), "x", c.NEGATIVE_SCORE),
    (event(PUPIL, {"alfabetizado": "true"}), "x", c.NOT_BOOLEAN),
    (event(PUPIL, drop=["payload.alfabetizado"]), "x", "payload.alfabetizado é obrigatório"),
]


def test_every_contract_error(spark):
    messages = [(json.dumps(body, ensure_ascii=False), {} if attr is None else {"event_id": attr}, str(i), T0)
                for i, (body, attr, _) in enumerate(ERRORS)]
    got = {r.message_id: (r.error_code, r.error_message) for r in judged(spark, messages).collect()}
    for i, (body, _, text) in enumerate(ERRORS):
        assert got[str(i)] == (c.CONTRACT_ERROR, text), (i, body)


def test_invalid_json_and_length_cap(spark):
    texts = ["{", "[1]", '"x"', "", '{"a":1,"a":2}', '{"a": NaN}']
    long_time = "9" * 2000
    messages = [(t, {"event_id": f"a{i}"}, str(i), T0) for i, t in enumerate(texts)]
    messages.append(message(event(IND, event_time=long_time), 99))
    j = judged(spark, messages)
    rows = {r.pubsub_message_id: r for r in c.rejected_rows(j, at()).collect()}
    assert [rows[str(i)].error_code for i in range(6)] == [c.INVALID_JSON] * 6
    assert rows["1"].error_message == c.NOT_OBJECT and rows["0"].error_message == c.NOT_JSON
    assert len(rows["msg/99"].error_message) == 1024
    assert c.raw_rows(j, at()).filter("event_id = 'a3' and raw_message = ''").count() == 1


def test_accepted_variations_are_normalised(spark):
    cases = [
        (event(META, entity_id="pe", entity_type="UF"), dict(entity_id="PE", entity_type="uf", sigla_uf="PE")),
        (event(IND, {"ano": "2026"}), dict(ano=2026)),
        (event(IND, {"ano": " 2_026 "}), dict(ano=2026)),
        (event(IND, {"ano": 2026.9}), dict(ano=2026)),
        (event(IND, {"taxa_alfabetizacao": " 6.15e1 "}), dict(taxa_alfabetizacao=61.5)),
        (event(IND, {"taxa_alfabetizacao": 0}), dict(taxa_alfabetizacao=0.0)),
        (event(IND, {"percentual_participacao": None}), dict(percentual_participacao=None)),
        (event(PUPIL, {"alfabetizado": True}), dict(alfabetizado=True, entity_id="turma-b.17")),
        (event(PUPIL, {"id_municipio": 4205407}), dict(id_municipio="4205407")),
        (event(IND, {"sigla_uf": "xx", "id_municipio": "zz"}), dict(id_municipio=ENTITY[IND], sigla_uf="xx")),
        (event(IND, event_time="2027-03-04T06:30:00.1234567-03:00"), dict(event_time=T0.replace(microsecond=123456))),
        (event(IND, event_time="20270304T0930+0000"), dict(event_time=T0)),
        (event(IND, event_time="2027-03-04 09:30+00"), dict(event_time=T0)),
        (event(IND, event_id=""), dict(event_id="attr")),
    ]
    messages = [(json.dumps(b, ensure_ascii=False), {"event_id": "attr"}, str(i), T0) for i, (b, _) in enumerate(cases)]
    j = judged(spark, messages)
    bad = {r.message_id: r.error_message for r in j.filter("error_code is not null").collect()}
    assert bad == {}
    typed = c.typed_rows(j.withColumn("__source", F.col("message_id")), at())
    rows = {r.source: r for r in typed.collect()}
    for i, (_, want) in enumerate(cases):
        assert {k: rows[str(i)][k] for k in want} == want, i
    payload = json.loads(cases[0][0]["payload"]["rede"] and rows["0"].payload_json)
    assert payload == cases[0][0]["payload"]
    assert rows["0"].payload_json.startswith('{"ano": 2026, "ano_meta": 2028, ')


def test_compound_values_are_quarantined_not_lost(spark):
    j = judged(spark, [message(event(IND, source={"a": 1}), 0), message(event(IND, {"rede": ["x"]}, number=5), 1)])
    rejected = {r.pubsub_message_id: r.error_code for r in c.rejected_rows(j, at()).collect()}
    assert rejected == {"msg/0": c.RAW_CAST_ERROR, "msg/1": c.TYPED_CAST_ERROR}
    assert c.raw_rows(j, at()).count() == 2
    assert [r.event_id for r in c.typed_rows(j, at()).collect()] == ["ev-0"]


def test_kafka_layout(spark):
    df = spark.createDataFrame(
        [(bytearray(b"ok\xff"), "t", 0, 7, T0, [("event_id", bytearray(b"e1"))]), (bytearray(b"x"), "t", 1, 8, T0, None)],
        "value binary, topic string, partition int, offset long, timestamp timestamp, headers array<struct<key:string,value:binary>>",
    )
    rows = {r.message_id: r for r in from_kafka_layout(df).collect()}
    assert rows["t-0-7"].value == "ok�" and rows["t-0-7"].attributes == {"event_id": "e1"}
    assert rows["t-1-8"].attributes == {}


LATE = [message(event(IND, number=20 + n, entity_id="1100205"), 20 + n, event_id=f"ev-{20 + n}") for n in range(2)]
LATE = [(text, attributes, name, T0 - dt.timedelta(days=9)) for text, attributes, name, _ in LATE]
NAMELESS = [(text, {}, None, at) for text, _, _, at in [message(event(PUPIL, number=30), 30)] * 3]


@pytest.fixture(scope="module")
def routed(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stream"))
    again = [(v, a, m + "/again", t + dt.timedelta(seconds=30)) for v, a, m, t in RUN_MESSAGES[:5]]
    # The late ones were published nine days before messages that came earlier.
    for part in (RUN_MESSAGES[:7], RUN_MESSAGES[7:] + again, RUN_MESSAGES[2:4] * 5, LATE + LATE, NAMELESS):
        spark.createDataFrame(part, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    sinks = router.RouteSinks(f"{base}/out")
    stream = file_messages(spark, f"{base}/in", files_per_trigger=1)
    query = router.start_router(stream, sinks, f"{base}/checkpoint", drain=True)
    query.awaitTermination(240)
    assert query.exception() is None
    return base, sinks


def test_stream_loses_no_message(spark, routed):
    _, sinks = routed
    raw, typed, rejected = sinks.raw(spark), sinks.typed(spark), sinks.rejected(spark)
    valid = VALID + len(LATE) + len(NAMELESS)
    counts = (raw.count(), typed.count(), rejected.count(), sinks.dead_letters(spark).count())
    assert counts == (valid + BROKEN, valid, BROKEN, BROKEN)
    codes = sorted(r.error_code for r in rejected.collect())
    assert codes == [c.CONTRACT_ERROR] * (BROKEN - 1) + [c.INVALID_JSON]
    letters = [json.loads(r.value) for r in sinks.dead_letters(spark).collect()]
    assert {x["error_message"] for x in letters} == {c.NOT_JSON, c.NO_SOURCE, c.BAD_YEAR, "taxa_alfabetizacao deve estar entre 0 e 100"}
    assert typed.filter("entity_id = '1100205'").count() == len(LATE)
    assert typed.filter("event_id = 'ev-30'").count() == len(NAMELESS)


def test_streaming_suite_and_views(spark, tmp_path):
    sinks = router.RouteSinks(str(tmp_path))
    router.route_batch(spark.createDataFrame(RUN_MESSAGES, MESSAGE_SCHEMA), 0, sinks)
    raw, typed, rejected = sinks.raw(spark), sinks.typed(spark), sinks.rejected(spark)
    now = at()
    results = suites.streaming_checks(spark, raw, typed, rejected, RUN, (VALID + BROKEN, VALID, BROKEN), now).collect()
    assert len(results) == 8 and {r.status for r in results} == {"OK"}
    short = suites.streaming_checks(spark, raw, typed.limit(VALID - 1), rejected, RUN, (VALID + BROKEN, VALID, BROKEN), now).collect()
    assert "FAIL" in {r.status for r in short}
    assert sum(r.quantidade_eventos for r in views.event_summary(typed).collect()) == VALID
    assert views.latest_events(typed).count() == VALID and views.latest_events(typed).columns == [
        x.name for x in typed.select(*views.latest_events(typed).columns).schema
    ]
    latency = observe.latency_summary(typed, raw, now)
    assert latency.agg(F.sum("events_without_publish_time")).first()[0] == 0


def test_replayed_epoch_replaces_its_rows(spark, tmp_path):
    sinks = router.RouteSinks(str(tmp_path))
    batch = spark.createDataFrame(RUN_MESSAGES, MESSAGE_SCHEMA)
    for _ in range(2):
        router.route_batch(batch, 3, sinks)
    assert sinks.raw(spark).count() == VALID + BROKEN and sinks.dead_letters(spark).count() == BROKEN


class Stopping(router.RouteSinks):
    """Fails before one of the outputs is written."""

    def write(self, name, epoch, rows):
        if name == "quarantine":
            raise OSError("no space left")
        return super().write(name, epoch, rows)


def test_epoch_that_stopped_between_sinks_counts_nowhere(spark, tmp_path):
    sinks = router.RouteSinks(str(tmp_path))
    batch = spark.createDataFrame(RUN_MESSAGES, MESSAGE_SCHEMA)
    with pytest.raises(OSError):
        router.route_batch(batch, 0, Stopping(str(tmp_path)))
    assert len(files.listed(spark, f"{tmp_path}/typed/_epoch=0")) == 1
    assert [sinks.committed(spark).read(n).count() for n in router.SCHEMAS] == [0, 0, 0, 0]
    router.route_batch(batch, 0, sinks)
    before = sinks.committed(spark)
    router.route_batch(batch, 1, sinks)
    assert sinks.raw(spark).count() == 2 * before.read("raw").count() == 2 * (VALID + BROKEN)
    # The attempt that stopped goes, what counts stays.
    assert sinks.vacuum(spark) == []
    gone = sinks.vacuum(spark, older_than=dt.timedelta(0))
    assert len(gone) == 3 and sinks.typed(spark).count() == 2 * VALID


def test_compaction_retention_and_clearing(spark, tmp_path):
    sinks = router.RouteSinks(str(tmp_path))
    batch = spark.createDataFrame(RUN_MESSAGES, MESSAGE_SCHEMA)
    for epoch in range(5):
        router.route_batch(batch, epoch, sinks, dt.datetime(2024, 3, 1 + epoch // 2, 12, tzinfo=dt.timezone.utc))
    opened, count = sinks.committed(spark), sinks.raw(spark).count()
    new = sinks.compact(spark, before=dt.date(2024, 3, 2))
    assert {(e.sink, e.first, e.last, e.day) for e in new} == {(n, 0, 1, "2024-03-01") for n in router.SCHEMAS}
    assert len(sinks.compact(spark)) == 4 and sinks.compact(spark) == []
    now = sinks.committed(spark)
    assert len(now.manifest.folders("raw")) == 3 and now.read("raw").count() == count == opened.read("raw").count()
    assert sorted(map(str, now.read("dead_letter").collect())) == sorted(map(str, opened.read("dead_letter").collect()))
    # Another run's rewriting of the same folders comes too late.
    gone = list(opened.manifest.entries[:8])
    assert not sinks.log(spark).swap(gone, [epochs.Entry("raw", "raw/late", 0, 1, "2024-03-01")])
    sinks.log(spark).expire(dt.date(2024, 3, 2))
    assert sinks.raw(spark).count() == 3 * (VALID + BROKEN)
    assert len(sinks.vacuum(spark, older_than=dt.timedelta(0), kept=1)) == 20
    assert sinks.typed(spark).count() == 3 * VALID and len(files.listed(spark, f"{tmp_path}/_manifest")) == 1
    router.route_batch(batch, 4, sinks)  # replayed after its commit
    assert sinks.typed(spark).count() == 3 * VALID


def test_of_two_writers_of_a_version_one_succeeds(spark, tmp_path):
    log = epochs.EpochLog(spark, str(tmp_path))
    assert log.current() == epochs.Manifest()
    assert files.put_new(spark, f"{tmp_path}/_manifest/one", "a") and not files.put_new(spark, f"{tmp_path}/_manifest/one", "b")
    assert files.read_text(spark, f"{tmp_path}/_manifest/one") == "a" and list(files.listed(spark, f"{tmp_path}/_manifest")) == ["one"]
    first, other = [], epochs.EpochLog(spark, str(tmp_path))

    def slowly(m):
        if not first:  # the other writer commits between reading and writing
            first.append(other.commit(0, dt.date(2024, 1, 1), {"raw": "raw/a"}))
        return dataclasses.replace(m, entries=(*m.entries, epochs.Entry("raw", "raw/b", 1, 1, "2024-01-01")))

    assert log.update(slowly).folders("raw") == ["raw/a", "raw/b"] and log.current().version == 2


def test_latest_ties_and_batch_dedup(spark):
    rows = judged(spark, [message(event(IND, event_id=f"ev-{k}"), k) for k in range(3)])
    newest = views.latest_events(c.typed_rows(rows, at())).collect()
    assert [r.event_id for r in newest] == ["ev-2"]
    repeated = [message(event(IND), k, event_id="ev-0") for k in range(4)] + [message(event(IND), 9)] + NAMELESS
    out = router.deduplicated_table(spark.createDataFrame(repeated, MESSAGE_SCHEMA)).collect()
    assert sorted(r.message_id or "" for r in out) == ["", "", "", "msg/0", "msg/9"]


def test_streaming_views_and_alert(spark, routed, tmp_path):
    base, _ = routed
    typed = spark.readStream.schema(c.TYPED_SCHEMA + ", _epoch long, _try string").parquet(f"{base}/out/typed").drop("_epoch", "_try")
    q = views.latest_events_stream(typed).writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("latest").count() == VALID + 1
    q = views.event_summary_stream(typed).writeStream.format("memory").queryName("summary").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("summary").agg(F.sum("quantidade_eventos")).first()[0] == VALID + len(LATE) + len(NAMELESS)
    samples = [("s", T0 + dt.timedelta(minutes=m), 150.0) for m in range(8)] + [("s", T0 + dt.timedelta(hours=2), 0.0)]
    folder = str(tmp_path / "samples")
    spark.createDataFrame(samples, "series string, ts timestamp, value double").coalesce(1).write.parquet(folder)
    source = spark.readStream.schema("series string, ts timestamp, value double").parquet(folder)
    q = sustained_breaches(source, AlertPolicy("backlog", 100), "1 minute").writeStream.format("memory").queryName("alerts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("alerts").count() == 4


def test_alert_episodes_of_tables_and_streams(spark, tmp_path):
    """Two stretches with a minute between, one too short, another series; the last sample moves the watermark on."""
    high = [*range(0, 6), *range(7, 13), *range(20, 24)]
    samples = [("s", T0 + dt.timedelta(minutes=m, seconds=20), 150.0 + m) for m in high]
    samples += [("s", T0 + dt.timedelta(minutes=m, seconds=40), 10.0) for m in (1, 6, 13)] + [("t", T0 + dt.timedelta(minutes=m), 101.0) for m in range(5)]
    schema, policy, folder = "series string, ts timestamp, value double", AlertPolicy("backlog", 100), str(tmp_path / "samples")
    for part in (samples[::2], samples[1::2], [("s", T0 + dt.timedelta(hours=3), 0.0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    minute = lambda m: T0 + dt.timedelta(minutes=m)
    want = {("s", minute(0), minute(6), 6, 155.0), ("s", minute(7), minute(13), 6, 162.0), ("t", minute(0), minute(5), 5, 101.0)}
    table = alert_episodes(spark.read.schema(schema).parquet(folder), policy)
    assert {tuple(r)[1:] for r in table.collect()} == want
    stream = alert_episodes(spark.readStream.schema(schema).parquet(folder), policy, "10 minutes")
    q = stream.writeStream.format("memory").queryName("episodes").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r)[1:] for r in spark.table("episodes").collect()} == want


def test_outputs_by_the_columns_that_are_read(spark):
    from plumbline.plans.star.events import event_messages, judged_events, typed_events

    sf, now = "/root/testdata/sf0.001", F.lit("2024-02-01").cast("timestamp")
    whole = c.judge(event_messages(spark, sf)).cache()
    only = {"raw": ["event_id", "pubsub_publish_time"], "typed": ["entity_id", "event_time", "quality_status"], "rejected": ["event_id", "error_code", "error_message"]}
    rows = {"raw": c.raw_rows, "typed": c.typed_rows, "rejected": c.rejected_rows}
    for name, names in only.items():
        narrow = rows[name](whole.select(*c.columns_read(**{name: names})), now, names)
        full = rows[name](whole, now)
        assert set(narrow.columns) == set(names) and narrow.schema == full.select(*narrow.columns).schema
        assert narrow.count() > 0 and narrow.exceptAll(full.select(*narrow.columns)).isEmpty() and full.select(*narrow.columns).exceptAll(narrow).isEmpty()
    typed = ["event_id", "event_time", "processing_timestamp"]
    stored = judged_events(spark, sf, typed=typed)
    assert stored.columns == ["__event_id", "__event_time", "error_code"]  # no bodies
    assert typed_events(stored, typed).count() == c.typed_rows(whole, now).count()
    whole.unpersist()
