"""Event contract, routing, latest/summary views, latency and alerts on the events table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.observe import latency_summary
from plumbline.operators.quality import union_all
from plumbline.plans.literacy import suites
from plumbline.plans.literacy.dashboards import streaming_view
from plumbline.plans.literacy.schemas import STATES
from plumbline.plans.star.base import Query, rounded, stamp, table
from plumbline.session import fresh_path, spread, stage
from plumbline.sources.messages import file_messages
from plumbline.streaming import contract
from plumbline.streaming.alerts import AlertPolicy, alert_episodes, sustained_breaches
from plumbline.streaming.router import RouteSinks, deduplicated_table, start_router
from plumbline.streaming.views import event_summary, latest_events

# Event type of the table -> event type of the contract.
KINDS = {
    "view": "indicador_municipio_atualizado",
    "click": "indicador_uf_atualizado",
    "signup": "meta_municipio_atualizada",
    "error": "meta_uf_atualizada",
    "purchase": "resultado_aluno_recebido",
}


def _pick(subject: Column, options: dict[str, Column | str]) -> Column:
    out = None
    for value, result in options.items():
        hit = subject == value
        out = F.when(hit, result) if out is None else out.when(hit, result)
    return out


def event_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a contract message. Some are corrupted, by event id: cut JSON, no entity id, another
    version, a time without zone, a year out of range. Values above 100 break the percentage rule by themselves.

    A message takes far longer to make and judge than its event to read, so events are dealt to all cores first."""
    e = spread(table(spark, sf, "events"), "event_id", "ts")
    kind, user, number = F.col("event_type"), F.col("user_id"), F.col("event_id")
    city = F.format_string("%07d", user + 1_000_000)
    state = F.element_at(F.array(*[F.lit(s) for s in STATES]), (user % len(STATES) + 1).cast("int"))
    pupil = F.format_string("pupil/%d", user)
    indicator = kind.isin("view", "click")
    target = kind.isin("signup", "error")
    payload = F.struct(
        F.when(number % 41 == 0, 2036).otherwise(2025).alias("ano"),
        F.when(target, 2026).alias("ano_meta"),
        F.lit("Municipal").alias("rede"),
        F.when(kind == "purchase", city).alias("id_municipio"),
        F.when(indicator, F.col("value")).alias("taxa_alfabetizacao"),
        F.when(target, F.col("value")).alias("meta_alfabetizacao"),
        F.when(kind == "purchase", F.col("value")).alias("proficiencia"),
        F.when(kind == "purchase", F.col("value") > 50).alias("alfabetizado"),
    )
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    body = F.to_json(
        F.struct(
            F.concat(F.lit("e"), number).alias("event_id"),
            F.concat(F.lit("run_"), F.date_format("ts", "dd")).alias("simulation_run_id"),
            _pick(kind, KINDS).alias("event_type"),
            F.concat(when, F.when(number % 37 == 0, "").otherwise("Z")).alias("event_time"),
            F.when(number % 31 == 0, "2.0").otherwise("1.0").alias("schema_version"),
            _pick(kind, {k: contract.EVENT_TYPES[v] for k, v in KINDS.items()}).alias("entity_type"),
            F.when(
                number % 29 != 0,
                F.when(kind.isin("view", "signup"), city).when(kind.isin("click", "error"), state).otherwise(pupil),
            ).alias("entity_id"),
            F.lit("star").alias("source"),
            payload.alias("payload"),
        )
    )
    attributes = F.create_map(
        F.lit("event_id"), F.concat(F.lit("e"), number),
        F.lit("simulation_run_id"), F.concat(F.lit("run_"), F.date_format("ts", "dd")),
    )
    return e.select(
        F.when(number % 23 == 0, F.substring(body, 1, 40)).otherwise(body).alias("value"),
        attributes.alias("attributes"),
        number.cast("string").alias("message_id"),
        (F.col("ts").cast("timestamp") + F.expr("interval 500 milliseconds")).alias("publish_time"),
    )


# The verdict straight from the corruption rules, without looking at any message.
VERDICT_SQL = f"""verdict AS (
  SELECT *, 'run_' || strftime(ts, '%d') AS run,
    CASE event_type WHEN 'view' THEN 'indicador_municipio_atualizado' WHEN 'click' THEN 'indicador_uf_atualizado'
      WHEN 'signup' THEN 'meta_municipio_atualizada' WHEN 'error' THEN 'meta_uf_atualizada' ELSE 'resultado_aluno_recebido' END AS kind,
    CASE WHEN event_type IN ('view', 'signup') THEN 'municipio' WHEN event_type IN ('click', 'error') THEN 'uf' ELSE 'aluno' END AS entity,
    CASE WHEN event_type IN ('view', 'signup') THEN (user_id + 1000000)::VARCHAR
      WHEN event_type IN ('click', 'error') THEN {STATES}[user_id % {len(STATES)} + 1]
      ELSE 'pupil/' || user_id END AS entity_id,
    CASE WHEN event_id % 23 = 0 THEN 'INVALID_JSON' WHEN event_id % 31 = 0 OR event_id % 29 = 0 OR event_id % 37 = 0
      OR (event_type <> 'purchase' AND value > 100) OR event_id % 41 = 0 THEN 'CONTRACT_VALIDATION_ERROR' END AS error_code,
    CASE WHEN event_id % 23 = 0 THEN 'a mensagem não é um JSON válido' WHEN event_id % 31 = 0 THEN 'schema_version deve ser 1.0'
      WHEN event_id % 29 = 0 THEN 'entity_id é obrigatório' WHEN event_id % 37 = 0 THEN 'event_time precisa conter fuso horário'
      WHEN event_type IN ('view', 'click') AND value > 100 THEN 'taxa_alfabetizacao deve estar entre 0 e 100'
      WHEN event_type IN ('signup', 'error') AND value > 100 THEN 'meta_alfabetizacao deve estar entre 0 e 100'
      WHEN event_id % 41 = 0 THEN 'ano está fora do intervalo esperado' END AS error_message
  FROM events),
valid AS (SELECT *, date_trunc('second', ts) AS event_time, date_trunc('second', ts) + to_milliseconds((event_id * 37) % 5000) AS done
          FROM verdict WHERE error_code IS NULL)"""


def judged_events(spark: SparkSession, sf: str, **read: Sequence[str]) -> DataFrame:
    """All judged messages; of each, if ``raw``, ``typed`` or ``rejected`` columns are named, only what these come from.

    The bodies are most of a judged row, and columns that nobody reads are neither made nor written.
    """
    judged = contract.judge(deduplicated_table(event_messages(spark, sf)))
    return stage(judged.select(*contract.columns_read(**read)) if read else judged, "judged")


def _received() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def typed_events(judged: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Valid events; the processing time follows the event time by a delay made from the event id."""
    typed = contract.typed_rows(judged, _received(), only)
    number = F.substring("event_id", 2, 20).cast("long")
    delay = F.make_dt_interval(secs=((number * 37) % 5000 / 1000).cast("decimal(18,6)"))
    return typed.withColumn("processing_timestamp", F.col("event_time") + delay)


def event_contract_errors(spark: SparkSession, sf: str) -> DataFrame:
    rejected = ["event_id", "simulation_run_id", "error_code", "error_message", "pubsub_message_id"]
    return contract.rejected_rows(judged_events(spark, sf, rejected=rejected), _received(), rejected).select(*rejected)


CONTRACT_SQL = f"""WITH {VERDICT_SQL}
SELECT 'e' || event_id AS event_id, run AS simulation_run_id, error_code, error_message, event_id::VARCHAR AS pubsub_message_id
FROM verdict WHERE error_code IS NOT NULL"""


def event_typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    typed = [
        "event_id", "simulation_run_id", "event_type", "event_time", "entity_type", "entity_id",
        "ano", "ano_meta", "rede", "id_municipio", "sigla_uf", "taxa_alfabetizacao", "meta_alfabetizacao", "proficiencia",
        "alfabetizado", "quality_status",
    ]
    rows = contract.typed_rows(judged_events(spark, sf, typed=typed), _received(), typed)
    return rows.select(*typed).withColumn("event_time", stamp("event_time"))


TYPED_SQL = f"""WITH {VERDICT_SQL}
SELECT 'e' || event_id AS event_id, run AS simulation_run_id, kind AS event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
  entity AS entity_type, entity_id, 2025 AS ano, CASE WHEN event_type IN ('signup', 'error') THEN 2026 END AS ano_meta,
  'Municipal' AS rede, CASE WHEN entity = 'municipio' THEN entity_id WHEN entity = 'aluno' THEN (user_id + 1000000)::VARCHAR END AS id_municipio,
  CASE WHEN entity = 'uf' THEN entity_id END AS sigla_uf, CASE WHEN event_type IN ('view', 'click') THEN value END AS taxa_alfabetizacao,
  CASE WHEN event_type IN ('signup', 'error') THEN value END AS meta_alfabetizacao, CASE WHEN entity = 'aluno' THEN value END AS proficiencia,
  CASE WHEN entity = 'aluno' THEN value > 50 END AS alfabetizado, 'VALID' AS quality_status
FROM valid"""


def _counts(frames: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        df.groupBy("simulation_run_id").agg(F.count(F.lit(1)).alias("n")).withColumn("output", F.lit(name))
        for name, df in frames.items()
    )


def event_routing_counts(spark: SparkSession, sf: str) -> DataFrame:
    judged = judged_events(spark, sf)
    rejected = contract.rejected_rows(judged, _received())
    letters = contract.dead_letters(rejected).select(F.get_json_object("value", "$.simulation_run_id").alias("simulation_run_id"))
    return _counts(
        {"raw": contract.raw_rows(judged, _received()), "typed": contract.typed_rows(judged, _received()),
         "quarantine": rejected, "dead_letter": letters}
    )


ROUTING_SQL = f"""WITH {VERDICT_SQL}
SELECT run AS simulation_run_id, count(*) AS n, 'raw' AS output FROM verdict GROUP BY 1
UNION ALL SELECT run, count(*), 'typed' FROM valid GROUP BY 1
UNION ALL SELECT run, count(*), 'quarantine' FROM verdict WHERE error_code IS NOT NULL GROUP BY 1
UNION ALL SELECT run, count(*), 'dead_letter' FROM verdict WHERE error_code IS NOT NULL GROUP BY 1"""


def event_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    out = event_summary(typed_events(judged_events(spark, sf))).withColumns(
        {"data_evento": F.col("data_evento").cast("string"), "ultima_atualizacao": stamp("ultima_atualizacao")}
    )
    return rounded(out, 6, "media_taxa_alfabetizacao", "media_meta_alfabetizacao")


SUMMARY_SQL = f"""WITH {VERDICT_SQL}
SELECT strftime(event_time, '%Y-%m-%d') AS data_evento, run AS simulation_run_id, kind AS event_type, entity AS entity_type,
  count(*) AS quantidade_eventos, count(DISTINCT entity_id) AS quantidade_entidades,
  round(avg(CASE WHEN event_type IN ('view', 'click') THEN value END), 6) AS media_taxa_alfabetizacao,
  round(avg(CASE WHEN event_type IN ('signup', 'error') THEN value END), 6) AS media_meta_alfabetizacao,
  NULL::DOUBLE AS media_percentual_participacao, strftime(max(done), '%Y-%m-%d %H:%M:%S') AS ultima_atualizacao
FROM valid GROUP BY 1, 2, 3, 4"""


def event_latest(spark: SparkSession, sf: str) -> DataFrame:
    measures = ["taxa_alfabetizacao", "meta_alfabetizacao", "proficiencia"]
    typed = ["event_id", "event_type", "event_time", "entity_type", "entity_id", *measures, "processing_timestamp"]
    return latest_events(typed_events(judged_events(spark, sf, typed=typed), typed)).select(
        "event_type", "entity_type", "entity_id", "event_id", stamp("event_time").alias("event_time"), *measures
    )


LATEST_SQL = f"""WITH {VERDICT_SQL}
SELECT kind AS event_type, entity AS entity_type, entity_id, 'e' || event_id AS event_id,
  strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, CASE WHEN event_type IN ('view', 'click') THEN value END AS taxa_alfabetizacao,
  CASE WHEN event_type IN ('signup', 'error') THEN value END AS meta_alfabetizacao, CASE WHEN entity = 'aluno' THEN value END AS proficiencia
FROM valid QUALIFY row_number() OVER (PARTITION BY kind, entity, entity_id ORDER BY valid.event_time DESC, done DESC, 'e' || event_id DESC) = 1"""


# What the latency of an event is made from.
TIMED = ["event_id", "simulation_run_id", "event_type", "event_time", "processing_timestamp"]
TIMED_RAW = ["event_id", "simulation_run_id", "pubsub_publish_time"]


def event_latency_p95(spark: SparkSession, sf: str) -> DataFrame:
    """Latency per run and type. Raw rows hold every message twice (redelivered later)."""
    read = {"raw": TIMED_RAW, "typed": TIMED}
    judged = judged_events(spark, sf, **read)
    typed = typed_events(judged, TIMED)
    raw = contract.raw_rows(judged, _received(), TIMED_RAW)
    again = raw.withColumn("pubsub_publish_time", F.col("pubsub_publish_time") + F.expr("interval 1 hour"))
    out = latency_summary(typed, raw.unionByName(again), _received())
    return out.drop("collected_at").withColumns(
        {"first_event_time": stamp("first_event_time"), "last_event_time": stamp("last_event_time")}
    )


LATENCY_SQL = f"""WITH {VERDICT_SQL}, timed AS (
  SELECT *, (event_id * 37) % 5000 AS total, date_diff('microsecond', ts + INTERVAL 500 MILLISECOND, done) AS processing
  FROM valid)
SELECT run AS simulation_run_id, kind AS event_type, count(*) AS event_count, count(processing) AS events_with_publish_time,
  count(*) - count(processing) AS events_without_publish_time, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_event_time,
  strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_event_time, round(avg(total) / 1000, 3) AS avg_end_to_end_latency_seconds,
  round(quantile_disc(total, 0.95) / 1000, 3) AS p95_end_to_end_latency_seconds, round(max(total) / 1000, 3) AS max_end_to_end_latency_seconds,
  round(avg(trunc(processing / 1000)) / 1000, 3) AS avg_processing_latency_seconds
FROM timed GROUP BY 1, 2"""


def event_raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The raw row of every message, valid or not; of the body, which is stored as it came, the first field."""
    rows = contract.raw_rows(judged_events(spark, sf), _received()).drop("ingestion_timestamp")
    return rows.withColumns(
        {
            "raw_message": F.substring_index("raw_message", ",", 1), "event_time": stamp("event_time"),
            "pubsub_publish_time": F.date_format("pubsub_publish_time", "yyyy-MM-dd HH:mm:ss.SSS"),
        }
    )


RAW_SQL = f"""WITH {VERDICT_SQL}, readable AS (SELECT *, event_id % 23 <> 0 AS parsed FROM verdict)
SELECT 'e' || event_id AS event_id, run AS simulation_run_id, CASE WHEN parsed THEN kind END AS event_type,
  CASE WHEN parsed THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_time,
  CASE WHEN parsed THEN CASE WHEN event_id % 31 = 0 THEN '2.0' ELSE '1.0' END END AS schema_version,
  CASE WHEN parsed THEN entity END AS entity_type, CASE WHEN parsed AND event_id % 29 <> 0 THEN entity_id END AS entity_id,
  CASE WHEN parsed THEN 'star' END AS source, '{{"event_id":"e' || event_id || '"' AS raw_message,
  '{{"event_id": "e' || event_id || '", "simulation_run_id": "' || run || '"}}' AS attributes_json,
  event_id::VARCHAR AS pubsub_message_id, strftime(ts + INTERVAL 500 MILLISECOND, '%Y-%m-%d %H:%M:%S.%g') AS pubsub_publish_time
FROM readable"""


def streaming_suite(spark: SparkSession, sf: str) -> DataFrame:
    """The checks of one run, against expected numbers that the run does not have: reconciliation fails."""
    run = ["event_id", "simulation_run_id"]
    typed = [*run, "event_type", "event_time", "entity_type", "entity_id", "source", "taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao"]
    read = {"raw": run, "typed": [*typed, "processing_timestamp"], "rejected": [*run, "error_code", "error_message"]}
    judged = judged_events(spark, sf, **read)
    frames = (
        contract.raw_rows(judged, _received(), read["raw"]), typed_events(judged, read["typed"]),
        contract.rejected_rows(judged, _received(), read["rejected"]),
    )
    return suites.streaming_checks(spark, *frames, "run_05", (5000, 4000, 7), _received()).drop("executed_at")


STREAMING_SUITE_SQL = f"""WITH {VERDICT_SQL}, r AS (SELECT * FROM verdict WHERE run = 'run_05'), v AS (SELECT * FROM valid WHERE run = 'run_05'), c AS (
  SELECT 'RECONCILIATION' AS check_type, 'bronze_total_eventos' AS object_name, 5000 AS expected_value, (SELECT count(*) FROM r) AS actual_value
  UNION ALL SELECT 'RECONCILIATION', 'silver_eventos_validos', 4000, (SELECT count(DISTINCT event_id) FROM v)
  UNION ALL SELECT 'RECONCILIATION', 'quarentena_eventos_invalidos', 7, (SELECT count(DISTINCT event_id) FROM r WHERE error_code IS NOT NULL)
  UNION ALL SELECT 'UNIQUENESS', 'silver_event_id', 0, (SELECT count(*) - count(DISTINCT event_id) FROM v)
  UNION ALL SELECT 'VALIDITY', 'silver_campos_obrigatorios', 0, (SELECT count(*) FROM v WHERE entity_id IS NULL OR event_time IS NULL)
  UNION ALL SELECT 'VALIDITY', 'silver_tipos_evento', 0, (SELECT count(*) FROM v WHERE event_type NOT IN ('view', 'click', 'signup', 'error', 'purchase'))
  UNION ALL SELECT 'VALIDITY', 'silver_percentuais', 0, (SELECT count(*) FROM v WHERE event_type <> 'purchase' AND NOT value BETWEEN 0 AND 100)
  UNION ALL SELECT 'CONSISTENCY', 'quarentena_com_motivo', 0, (SELECT count(*) FROM r WHERE (error_code IS NULL) <> (error_message IS NULL)))
SELECT *, CASE WHEN expected_value = actual_value THEN 'OK' ELSE 'FAIL' END AS status, 'run_05' AS simulation_run_id FROM c"""


def dashboard_streaming(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming dashboard: valid events per day and type, latency per run and type, and run totals.

    The means are left to ``event_summary``: rounded to two digits they fall on ties that engines break differently.
    """
    measures = ["taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao"]
    read = {"raw": TIMED_RAW, "typed": [*TIMED, "entity_type", "entity_id", *measures], "rejected": ["simulation_run_id"]}
    judged = judged_events(spark, sf, **read)
    typed, raw = typed_events(judged, read["typed"]), contract.raw_rows(judged, _received(), read["raw"])
    rejected = contract.rejected_rows(judged, _received(), read["rejected"])
    view = streaming_view(event_summary(typed), latency_summary(typed, raw, _received()), raw, typed, rejected)
    means = ["media_taxa_alfabetizacao", "media_meta_alfabetizacao", "media_percentual_participacao"]
    return view.drop("ultima_atualizacao", *means).withColumn("data_evento", F.col("data_evento").cast("string"))


DASHBOARD_STREAMING_SQL = f"""WITH s AS ({SUMMARY_SQL}), l AS ({LATENCY_SQL}), {VERDICT_SQL},
n AS (SELECT run, count(*) AS total, count(*) FILTER (error_code IS NULL) AS good FROM verdict GROUP BY 1)
SELECT data_evento, s.simulation_run_id, s.event_type, entity_type, quantidade_eventos, quantidade_entidades,
  event_count, events_with_publish_time, events_without_publish_time, avg_end_to_end_latency_seconds,
  p95_end_to_end_latency_seconds, max_end_to_end_latency_seconds, avg_processing_latency_seconds,
  total AS eventos_bronze_total_run, nullif(good, 0) AS eventos_validos_total_run, total - good AS eventos_invalidos_total_run
FROM s LEFT JOIN l ON l.simulation_run_id = s.simulation_run_id AND l.event_type = s.event_type LEFT JOIN n ON n.run = s.simulation_run_id"""

# --- alerts -----------------------------------------------------------------------------------------------------


def fast_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The values of each event type as metric samples, the month of events played sixty times faster."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000) - F.floor(F.unix_micros(start) / 60_000_000)
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series"), F.timestamp_seconds(F.unix_seconds(start) + seconds).alias("ts"), "value"
    )


def threshold_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Sustained high values per event type."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    samples = fast_samples(spark, sf)
    breaches = sustained_breaches(samples, AlertPolicy("high_value", 20.0))
    origin = F.unix_seconds(start)
    return breaches.select(
        "policy", "series", (F.unix_seconds("breach_start") - origin).alias("breach_start"),
        (F.unix_seconds("breach_end") - origin).alias("breach_end"), "lowest_peak",
    )


ALERT_SQL = """
WITH minutes AS (
  SELECT event_type AS series, floor(date_diff('second', TIMESTAMP '2024-01-01', ts) / 3600)::BIGINT AS minute, max(value) AS peak
  FROM events GROUP BY 1, 2)
SELECT 'high_value' AS policy, a.series, a.minute * 60 AS breach_start, (a.minute + 5) * 60 AS breach_end, min(b.peak) AS lowest_peak
FROM (SELECT DISTINCT series, unnest(range(minute - 4, minute + 1)) AS minute FROM minutes) a
JOIN minutes b ON b.series = a.series AND b.minute BETWEEN a.minute AND a.minute + 4
GROUP BY a.series, a.minute HAVING count(*) = 5 AND min(b.peak) > 20"""

def alert_episode_rows(spark: SparkSession, sf: str) -> DataFrame:
    """High values per event type, one row for each time that they last."""
    origin = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    episodes = alert_episodes(fast_samples(spark, sf), AlertPolicy("high_value", 20.0))
    return episodes.withColumns({c: F.unix_seconds(c) - origin for c in ("opened_at", "closed_at")})


EPISODES_SQL = """
WITH minutes AS (
  SELECT event_type AS series, floor(date_diff('second', TIMESTAMP '2024-01-01', ts) / 3600)::BIGINT AS minute, max(value) AS peak
  FROM events GROUP BY 1, 2 HAVING max(value) > 20),
islands AS (SELECT *, minute - row_number() OVER (PARTITION BY series ORDER BY minute) AS island FROM minutes)
SELECT 'high_value' AS policy, series, min(minute) * 60 AS opened_at, (max(minute) + 1) * 60 AS closed_at, count(*) AS minutes, max(peak) AS peak
FROM islands GROUP BY series, island HAVING count(*) >= 5"""

# --- the stream itself ------------------------------------------------------------------------------------------


def streaming_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """All events as message files, every message twice, through the router until drained; read back from the sinks.

    Some come a third time under a new id, published a month before the others, and some with no id at all.
    """
    folder = fresh_path(spark, "stream")
    messages = event_messages(spark, sf)
    again = messages.withColumn("message_id", F.concat("message_id", F.lit("-again")))
    late = messages.filter(F.col("message_id").cast("long") % 53 == 0).withColumns(
        {
            "attributes": F.map_concat(F.map_filter("attributes", lambda k, v: k != "event_id"), F.create_map(F.lit("event_id"), F.concat(F.lit("late"), "message_id"))),
            "publish_time": F.col("publish_time") - F.expr("interval 30 days"), "message_id": F.concat("message_id", F.lit("-late")),
        }
    )
    nameless = messages.filter(F.col("message_id").cast("long") % 59 == 0).withColumns(
        {"attributes": F.map_filter("attributes", lambda k, v: k != "event_id"), "message_id": F.lit(None).cast("string")}
    )
    for part in (messages, again, late, nameless, nameless):
        part.write.mode("append").parquet(f"{folder}/in")
    sinks = RouteSinks(f"{folder}/out")
    query = start_router(file_messages(spark, f"{folder}/in"), sinks, f"{folder}/checkpoint", drain=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    letters = sinks.dead_letters(spark).select(F.get_json_object("value", "$.simulation_run_id").alias("simulation_run_id"))
    return _counts(
        {"raw": sinks.raw(spark), "typed": sinks.typed(spark), "quarantine": sinks.rejected(spark), "dead_letter": letters}
    )


# Late messages have ids of their own and count again, those without an id each time they come.
STREAM_SQL = f"""WITH {VERDICT_SQL}, weighed AS (SELECT *, 1 + (event_id % 53 = 0)::INT + 2 * (event_id % 59 = 0)::INT AS times FROM verdict)
SELECT run AS simulation_run_id, sum(times)::BIGINT AS n, 'raw' AS output FROM weighed GROUP BY 1
UNION ALL SELECT run, sum(times)::BIGINT, 'typed' FROM weighed WHERE error_code IS NULL GROUP BY 1
UNION ALL SELECT run, sum(times)::BIGINT, 'quarantine' FROM weighed WHERE error_code IS NOT NULL GROUP BY 1
UNION ALL SELECT run, sum(times)::BIGINT, 'dead_letter' FROM weighed WHERE error_code IS NOT NULL GROUP BY 1"""

QUERIES: dict[str, Query] = {
    "event_contract_errors": Query(event_contract_errors, CONTRACT_SQL),
    "event_typed_rows": Query(event_typed_rows, TYPED_SQL),
    "event_routing_counts": Query(event_routing_counts, ROUTING_SQL),
    "event_summary": Query(event_summary_query, SUMMARY_SQL),
    "event_latest": Query(event_latest, LATEST_SQL),
    "event_latency_p95": Query(event_latency_p95, LATENCY_SQL),
    "threshold_alert": Query(threshold_alert, ALERT_SQL),
    "alert_episodes": Query(alert_episode_rows, EPISODES_SQL),
    "event_raw_rows": Query(event_raw_rows, RAW_SQL),
    "streaming_suite": Query(streaming_suite, STREAMING_SUITE_SQL),
    "dashboard_streaming": Query(dashboard_streaming, DASHBOARD_STREAMING_SQL),
    "streaming_end_to_end": Query(streaming_end_to_end, STREAM_SQL),
}
