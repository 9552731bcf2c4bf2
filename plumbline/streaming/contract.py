"""The event contract (version 1.0) as Column expressions over parsed JSON.

``judge`` turns messages into one frame holding raw fields, typed fields and the first contract error; it is
a pure projection, so the same code validates a table in batch and a stream in micro-batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import full_match, sorted_map_json, spaced_json, strip, strip_column
from plumbline.functions.variants import JsonValue, member_columns, members_of, texts_of

# Accepted event types and the entity type each one describes.
EVENT_TYPES = {
    "indicador_municipio_atualizado": "municipio",
    "indicador_uf_atualizado": "uf",
    "meta_municipio_atualizada": "municipio",
    "meta_uf_atualizada": "uf",
    "resultado_aluno_recebido": "aluno",
}
INDICATOR_EVENTS = ["indicador_municipio_atualizado", "indicador_uf_atualizado"]
TARGET_EVENTS = ["meta_municipio_atualizada", "meta_uf_atualizada"]
PUPIL_EVENTS = ["resultado_aluno_recebido"]
SCHEMA_VERSION = "1.0"
YEARS = (2023, 2035)
TARGET_YEARS = (2024, 2030)
ERROR_LENGTH = 1024
STATUS = "VALID"

# Error codes.
INVALID_JSON = "INVALID_JSON"
CONTRACT_ERROR = "CONTRACT_VALIDATION_ERROR"
RAW_CAST_ERROR = "RAW_FIELD_CAST_ERROR"
TYPED_CAST_ERROR = "TYPED_FIELD_CAST_ERROR"

# Error texts. JSON syntax errors get one text of our own.
COMPOSITE = "campos com valor composto: "
NOT_JSON = "a mensagem não é um JSON válido"
NOT_OBJECT = "a mensagem JSON deve ser um objeto"
NO_EVENT_ID = "event_id é obrigatório"
NO_RUN_ID = "simulation_run_id é obrigatório"
BAD_EVENT_TYPE = "event_type não reconhecido"
BAD_VERSION = "schema_version deve ser 1.0"
BAD_ENTITY_TYPE = "entity_type incompatível com event_type"
NO_ENTITY_ID = "entity_id é obrigatório"
BAD_CITY_ID = "entity_id de município deve ter 7 dígitos"
BAD_STATE_ID = "entity_id de UF deve conter duas letras maiúsculas"
BAD_PUPIL_ID = "entity_id de aluno é inválido"
NO_SOURCE = "source é obrigatório"
BAD_PAYLOAD = "payload deve ser um objeto JSON"
TIME_NOT_TEXT = "event_time deve ser uma string RFC3339"
TIME_NO_ZONE = "event_time precisa conter fuso horário"
BAD_PAYLOAD_CITY = "payload.id_municipio deve ter 7 dígitos"
NEGATIVE_SCORE = "proficiencia não pode ser negativa"
NOT_BOOLEAN = "alfabetizado deve ser booleano"
BAD_TARGET_YEAR = "ano_meta deve estar entre 2024 e 2030"
BAD_YEAR = "ano está fora do intervalo esperado"

RAW_SCHEMA = (
    "event_id string, simulation_run_id string, event_type string, event_time timestamp, schema_version string,"
    " entity_type string, entity_id string, source string, raw_message string, attributes_json string,"
    " pubsub_message_id string, pubsub_publish_time timestamp, ingestion_timestamp timestamp"
)
TYPED_SCHEMA = (
    "event_id string, simulation_run_id string, event_type string, event_time timestamp, schema_version string,"
    " entity_type string, entity_id string, source string, ano long, ano_meta long, rede string,"
    " id_municipio string, sigla_uf string, taxa_alfabetizacao double, meta_alfabetizacao double,"
    " percentual_participacao double, proficiencia double, alfabetizado boolean, payload_json string,"
    " quality_status string, processing_timestamp timestamp"
)
QUARANTINE_SCHEMA = (
    "event_id string, simulation_run_id string, event_type string, raw_message string, error_code string,"
    " error_message string, attributes_json string, pubsub_message_id string, pubsub_publish_time timestamp,"
    " quarantined_at timestamp"
)

_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{8})"
_CLOCK = r"\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?"
_ZONE = r"[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?"


def _not_json_text(field: str, kind: str) -> str:
    return f"{field} deve ser {kind}"


def _required(field: str) -> Column:
    return F.when(F.col(f"{field}__missing"), f"payload.{field} é obrigatório")


def _integer_error(field: str) -> Column:
    return F.coalesce(_required(field), F.when(F.col(f"{field}__number").isNull(), _not_json_text(field, "inteiro")))


def _float_error(field: str) -> Column:
    return F.when(F.col(f"{field}__number").isNull(), _not_json_text(field, "numérico"))


def _percentage_error(field: str) -> Column:
    # NaN sorts above 100, so it is rejected here as well.
    return F.coalesce(
        _float_error(field),
        F.when(~F.col(f"{field}__number").between(0, 100), f"{field} deve estar entre 0 e 100"),
    )


_USUAL_TIME = r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})\z"


def _time_parts(text: Column) -> tuple[Column, Column]:
    """(instant, error) of an ISO 8601 time whose zone is required.

    The usual form is cast as it stands; only other forms go through the rewriting below.
    """
    usual = text.rlike(_USUAL_TIME)
    iso = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    shaped = iso.rlike(rf"\A{_DATE}(?:.{_CLOCK}(?:{_ZONE})?)?\z")
    zoned = iso.rlike(rf"\A{_DATE}.{_CLOCK}{_ZONE}\z")
    # Bring basic forms to the extended one; fractions are cut to microseconds.
    extended = F.regexp_replace(iso, r"\A(\d{4})(\d{2})(\d{2})(?!-)", "$1-$2-$3")
    extended = F.regexp_replace(extended, r"\A(.{10}).(\d{2})(\d{2})(\d{2})", "$1T$2:$3:$4")
    extended = F.regexp_replace(extended, r"\A(.{10}).(\d{2})(\d{2})(?=[+-])", "$1T$2:$3")
    extended = F.regexp_replace(extended, r"\A(.{10}).(\d{2})(?=[+-])", "$1T$2:00")
    extended = F.regexp_replace(extended, r"\A(.{10}).", "$1T")
    extended = F.regexp_replace(extended, r"\A(.{10}T\d{2}:\d{2})(?=[+-])", "$1:00")
    extended = F.regexp_replace(extended, r"[.,](\d{1,6})\d*(?=[+-])", ".$1")
    extended = F.regexp_replace(extended, r"([+-]\d{2}):?(\d{2})\z", "$1:$2")
    extended = F.regexp_replace(extended, r"(T.*[+-]\d{2})\z", "$1:00")
    instant = F.when(usual, text.try_cast("timestamp")).when(zoned, extended.try_cast("timestamp"))
    invalid = F.concat(F.lit("Invalid isoformat string: '"), iso, F.lit("'"))
    error = (
        F.when(usual & text.try_cast("timestamp").isNotNull(), F.lit(None).cast("string"))
        .when(~shaped, invalid)
        .when(~zoned, TIME_NO_ZONE)
        .when(instant.isNull(), invalid)
    )
    return instant, error


TEXT_FIELDS = ["event_type", "schema_version", "entity_type", "entity_id", "source"]
ID_FIELDS = ["event_id", "simulation_run_id"]
INTEGER_FIELDS = ["ano", "ano_meta"]
NUMBER_FIELDS = ["taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao", "proficiencia"]
OTHER_FIELDS = ["rede", "id_municipio", "sigla_uf", "alfabetizado"]
PAYLOAD_FIELDS = [*INTEGER_FIELDS, *NUMBER_FIELDS, *OTHER_FIELDS]


def judge(messages: DataFrame) -> DataFrame:
    """Messages ``(value, attributes, message_id, publish_time)`` with parsed fields and ``error_code``/``error_message``.

    Checks run in contract order and the first failing one names the error; NULL means the message is valid.
    The result feeds several outputs: stage or persist it before branching, or the parsing is repeated per branch.
    The receipt time is added by the row builders, so the expensive part of a micro-batch plan never changes and
    its generated code is reused from batch to batch.
    """
    trimmed, identified = _converted_columns()
    checked, output = _verdict_columns()
    envelope, payload = _envelope_columns(), _payload_columns()
    members = messages.select(*_parsed_columns()).withColumns(envelope).withColumns(payload)
    members = members.withColumns(_payload_members())
    return members.select(*trimmed).withColumns(identified).withColumns(checked).select(*output)


# The column lists below are built once per process: a micro-batch then only binds them to its rows.
# Each list becomes one projection whose columns the next one reads, so nothing is parsed twice.


@cache
def _parsed_columns() -> list[Column]:
    text = F.coalesce("value", F.lit(""))
    return [
        text.alias("raw_message"),
        # Strict parsing decides whether it is JSON at all; an object is told by its first character.
        F.when(F.try_parse_json(text).isNull(), "NONE")
        .when(text.startswith("{") | strip(text).startswith("{"), "OBJECT")
        .otherwise("OTHER")
        .alias("__kind"),
        members_of(text, [*ID_FIELDS, *TEXT_FIELDS, "event_time", "payload"]).alias("__envelope"),
        texts_of(text, [*ID_FIELDS, *TEXT_FIELDS, "event_time"]).alias("__texts"),
        sorted_map_json("attributes").alias("attributes_json"),
        *[F.col("attributes").getItem(n).alias(f"__attribute_{n}") for n in ID_FIELDS],
        F.col("message_id"),
        F.col("publish_time"),
    ]


@cache
def _envelope_columns() -> dict[str, Column]:
    names = {f"m_{n}": n for n in [*ID_FIELDS, *TEXT_FIELDS, "event_time"]}
    return member_columns("__envelope", names, "__texts") | {"__payload_text": F.to_json(F.col("__envelope.payload"))}


@cache
def _payload_columns() -> dict[str, Column]:
    return {
        "__payload_ok": F.coalesce(F.col("__payload_text").startswith("{"), F.lit(False)),
        "__payload": members_of(F.col("__payload_text"), PAYLOAD_FIELDS),
        "payload_json": spaced_json(F.col("__payload_text")),
    }


@cache
def _payload_members() -> dict[str, Column]:
    return member_columns("__payload", {f"p_{n}": n for n in PAYLOAD_FIELDS})


@cache
def _converted_columns() -> tuple[list[Column | str], dict[str, Column]]:
    """Trimmed envelope texts, typed payload numbers and the event time, each computed once."""
    m = {n: JsonValue(f"m_{n}") for n in [*ID_FIELDS, *TEXT_FIELDS, "event_time"]}
    p = {n: JsonValue(f"p_{n}") for n in PAYLOAD_FIELDS}

    def any_id(name: str) -> Column:
        unusable = (F.col("__kind") != "OBJECT") | m[name].falsy()
        return F.when(unusable, F.col(f"__attribute_{name}")).otherwise(m[name].as_text())

    def trimmed(name: str) -> Column:
        return F.when(m[name].is_string(), strip_column(f"m_{name}__text")).when(m[name].falsy(), "").otherwise(strip(m[name].as_text()))

    # A scalar column cannot take an object or array: noticed here instead of failing the write.
    nested = [F.when(m[n].is_nested(), n) for n in [*ID_FIELDS, *TEXT_FIELDS]]
    first = [
        "raw_message", "attributes_json", "message_id", "publish_time", "__kind", "__payload_ok", "payload_json",
        any_id("event_id").alias("__any_event_id"),
        any_id("simulation_run_id").alias("__any_run_id"),
        *[m[n].scalar_text().alias(f"__raw_{n}") for n in TEXT_FIELDS],
        *[trimmed(n).alias(f"__{n}") for n in TEXT_FIELDS],
        F.when(m["event_time"].is_string(), m["event_time"].text).alias("__time_text"),
        F.concat_ws(", ", *nested).alias("__uncastable"),
        *[p[n].missing().alias(f"{n}__missing") for n in PAYLOAD_FIELDS],
        *[p[n].as_integer().alias(f"{n}__number") for n in INTEGER_FIELDS],
        *[p[n].as_double().alias(f"{n}__number") for n in NUMBER_FIELDS],
        *[p[n].as_text().alias(f"{n}__any_text") for n in OTHER_FIELDS],
        *[p[n].is_nested().alias(f"{n}__nested") for n in OTHER_FIELDS],
        p["percentual_participacao"].is_null().alias("percentual_participacao__null"),
        p["alfabetizado"].is_boolean().alias("alfabetizado__boolean"),
    ]
    entity_type = F.lower("__entity_type")
    instant, time_error = _time_parts(F.col("__time_text"))
    second = {
        "__event_id": F.coalesce(strip_column("__any_event_id"), F.lit("")),
        "__run_id": F.coalesce(strip_column("__any_run_id"), F.lit("")),
        "__entity_type": entity_type,
        "__entity_id": F.when(entity_type == "uf", F.upper("__entity_id")).otherwise(F.col("__entity_id")),
        "__event_time": instant,
        "__time_error": time_error,
    }
    return first, second


@cache
def _verdict_columns() -> tuple[dict[str, Column], list[Column | str]]:
    """The first failing check in contract order, the typed values, and the output columns."""
    event, entity_type, entity_id = F.col("__event_type"), F.col("__entity_type"), F.col("__entity_id")
    is_indicator, is_target, is_pupil = (event.isin(e) for e in (INDICATOR_EVENTS, TARGET_EVENTS, PUPIL_EVENTS))
    expected = F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair])
    entity_error = (
        F.when((entity_type == "municipio") & ~full_match(entity_id, r"\d{7}"), BAD_CITY_ID)
        .when((entity_type == "uf") & ~full_match(entity_id, r"[A-Z]{2}"), BAD_STATE_ID)
        .when((entity_type == "aluno") & (F.length(entity_id) < 3), BAD_PUPIL_ID)
    )
    envelope_error = F.coalesce(
        F.when(F.col("__event_id") == "", NO_EVENT_ID),
        F.when(F.col("__run_id") == "", NO_RUN_ID),
        F.when(~event.isin(list(EVENT_TYPES)), BAD_EVENT_TYPE),
        F.when(F.col("__schema_version") != SCHEMA_VERSION, BAD_VERSION),
        F.when(entity_type != F.try_element_at(expected, event), BAD_ENTITY_TYPE),
        F.when(entity_id == "", NO_ENTITY_ID),
        entity_error,
        F.when(F.col("__source") == "", NO_SOURCE),
        F.when(~F.col("__payload_ok"), BAD_PAYLOAD),
        F.when(F.coalesce(strip_column("__time_text"), F.lit("")) == "", TIME_NOT_TEXT),
        F.col("__time_error"),
    )
    indicator_error = F.coalesce(
        _required("taxa_alfabetizacao"),
        _percentage_error("taxa_alfabetizacao"),
        F.when(~F.col("percentual_participacao__null"), _percentage_error("percentual_participacao")),
    )
    target_error = F.coalesce(
        _integer_error("ano_meta"),
        _required("meta_alfabetizacao"),
        _percentage_error("meta_alfabetizacao"),
        F.when(~F.col("ano_meta__number").between(*TARGET_YEARS), BAD_TARGET_YEAR),
    )
    pupil_error = F.coalesce(
        _required("id_municipio"),
        F.when(~full_match("id_municipio__any_text", r"\d{7}"), BAD_PAYLOAD_CITY),
        _required("proficiencia"),
        _float_error("proficiencia"),
        F.when(F.col("proficiencia__number") < 0, NEGATIVE_SCORE),
        _required("alfabetizado"),
        F.when(~F.col("alfabetizado__boolean"), NOT_BOOLEAN),
    )
    payload_error = F.coalesce(
        _integer_error("ano"),
        F.when(is_indicator, indicator_error).when(is_target, target_error).when(is_pupil, pupil_error),
        F.when(~F.col("ano__number").between(*YEARS), BAD_YEAR),
    )
    city = F.when(entity_type == "municipio", entity_id).when(is_pupil, F.col("id_municipio__any_text"))
    state = F.when(entity_type == "uf", entity_id)

    def scalar(name: str) -> Column:
        return F.when(~F.col(f"{name}__nested"), F.col(f"{name}__any_text"))

    untyped = F.concat_ws(
        ", ",
        F.when(F.col("rede__nested"), "rede"),
        F.when(city.isNull() & F.col("id_municipio__nested"), "id_municipio"),
        F.when(state.isNull() & F.col("sigla_uf__nested"), "sigla_uf"),
    )
    not_json = F.when(F.col("__kind") == "NONE", NOT_JSON).when(F.col("__kind") != "OBJECT", NOT_OBJECT)
    checked = {
        "__not_json": not_json,
        "__contract": F.when(not_json.isNull(), F.coalesce(envelope_error, payload_error)),
        "__untyped": F.when(not_json.isNull(), untyped),
        # The raw table also takes times the contract refuses for want of a zone; they are read as UTC.
        "__raw_time": F.coalesce("__event_time", F.col("__time_text").try_cast("timestamp")),
        # Typed values are only filled for the event types that carry them.
        "ano": F.col("ano__number").try_cast("long"),
        "ano_meta": F.when(is_target, F.col("ano_meta__number").try_cast("long")),
        "rede": scalar("rede"),
        "id_municipio": F.coalesce(city, scalar("id_municipio")),
        "sigla_uf": F.coalesce(state, scalar("sigla_uf")),
        "taxa_alfabetizacao": F.when(is_indicator, F.col("taxa_alfabetizacao__number")),
        "meta_alfabetizacao": F.when(is_target, F.col("meta_alfabetizacao__number")),
        "percentual_participacao": F.when(is_indicator, F.col("percentual_participacao__number")),
        "proficiencia": F.when(is_pupil, F.col("proficiencia__number")),
        "alfabetizado": F.when(
            is_pupil & F.col("alfabetizado__boolean"), F.col("alfabetizado__any_text") == "True"
        ),
    }
    composite = F.when(F.col("__untyped") != "", F.concat(F.lit(COMPOSITE), F.col("__untyped")))
    output = [
        "raw_message", "attributes_json", "message_id", "publish_time", "payload_json",
        "__any_event_id", "__any_run_id", *[f"__raw_{n}" for n in TEXT_FIELDS], "__raw_time",
        "__event_id", "__run_id", *[f"__{n}" for n in TEXT_FIELDS], "__event_time", "__uncastable",
        *PAYLOAD_FIELDS,
        F.when(F.col("__not_json").isNotNull(), INVALID_JSON)
        .when(F.col("__contract").isNotNull(), CONTRACT_ERROR)
        .when(F.col("__untyped") != "", TYPED_CAST_ERROR)
        .alias("error_code"),
        F.substring(F.coalesce("__not_json", "__contract", composite), 1, ERROR_LENGTH).alias("error_message"),
    ]
    return checked, output


# Where the columns of each output come from.
RAW_FROM = {
    "event_id": "__any_event_id", "simulation_run_id": "__any_run_id", "event_time": "__raw_time",
    **{n: f"__raw_{n}" for n in TEXT_FIELDS},
    "raw_message": "raw_message", "attributes_json": "attributes_json",
    "pubsub_message_id": "message_id", "pubsub_publish_time": "publish_time",
}
TYPED_FROM = {
    "event_id": "__event_id", "simulation_run_id": "__run_id", "event_time": "__event_time",
    **{n: f"__{n}" for n in TEXT_FIELDS}, **{n: n for n in [*PAYLOAD_FIELDS, "payload_json"]},
}
REJECTED_FROM = {
    n: RAW_FROM[n]
    for n in ("event_id", "simulation_run_id", "event_type", "raw_message", "attributes_json", "pubsub_message_id", "pubsub_publish_time")
}


def columns_read(raw: Sequence[str] = (), typed: Sequence[str] = (), rejected: Sequence[str] = ()) -> list[str]:
    """The columns of judged rows that these columns of the outputs come from, for a caller that stores no others."""
    found = [RAW_FROM.get(n) for n in raw] + [TYPED_FROM.get(n) for n in typed] + [REJECTED_FROM.get(n) for n in rejected]
    verdict = ["error_code", *(["error_message", "__uncastable"] if rejected else [])]
    return list(dict.fromkeys([*filter(None, found), *verdict]))


def _shaped(df: DataFrame, schema: str, sources: Mapping[str, str], made: Mapping[str, Column], only: Sequence[str] | None) -> DataFrame:
    """The columns of ``schema``, or ``only`` some, renamed from the judged rows' or ``made`` here."""
    fields = [f for f in T.StructType.fromDDL(schema) if only is None or f.name in only]
    return df.select(*[(made[f.name] if f.name in made else F.col(sources[f.name])).alias(f.name) for f in fields]).to(T.StructType(fields))


def raw_rows(judged: DataFrame, received_at: Column, only: Sequence[str] | None = None) -> DataFrame:
    """Every message, valid or not; an unreadable event time is NULL and stays in ``raw_message``."""
    return _shaped(judged, RAW_SCHEMA, RAW_FROM, {"ingestion_timestamp": received_at}, only)


def typed_rows(judged: DataFrame, received_at: Column, only: Sequence[str] | None = None) -> DataFrame:
    """Valid messages with normalised, typed fields."""
    made = {"quality_status": F.lit(STATUS), "processing_timestamp": received_at}
    return _shaped(judged.filter(F.col("error_code").isNull()), TYPED_SCHEMA, TYPED_FROM, made, only)


def rejected_rows(judged: DataFrame, received_at: Column, only: Sequence[str] | None = None) -> DataFrame:
    """Quarantine rows: contract errors, plus raw fields that could not be stored as text."""
    uncastable = F.concat(F.lit(COMPOSITE), F.col("__uncastable"))
    raw_cast = F.col("error_code").isNull() & (F.col("__uncastable") != "")
    made = {
        "error_code": F.coalesce("error_code", F.lit(RAW_CAST_ERROR)),
        "error_message": F.coalesce("error_message", F.substring(uncastable, 1, ERROR_LENGTH)),
        "quarantined_at": received_at,
    }
    flagged = judged.filter(F.col("error_code").isNotNull() | raw_cast)
    return _shaped(flagged, QUARANTINE_SCHEMA, REJECTED_FROM, made, only)


def dead_letters(rejected: DataFrame) -> DataFrame:
    """Quarantine rows as one JSON text column, NULL fields kept."""
    return rejected.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
