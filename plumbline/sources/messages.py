"""Message sources: ``(value, attributes, message_id, publish_time)`` from files or Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "value string, attributes map<string,string>, message_id string, publish_time timestamp"


def file_messages(spark: SparkSession, folder: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Messages as files dropped into a folder (Parquet or JSON lines)."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(folder)


def from_kafka_layout(records: DataFrame) -> DataFrame:
    """Kafka's columns as messages: bytes decoded with replacement characters, headers as attributes."""
    attributes = F.map_from_entries(
        F.transform(
            F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")),
            lambda h: F.struct(h.key.alias("key"), F.make_valid_utf8(h.value.cast("string")).alias("value")),
        )
    )
    return records.select(
        F.make_valid_utf8(F.col("value").cast("string")).alias("value"),
        attributes.alias("attributes"),
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("publish_time"),
    )


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages from a Kafka topic (needs the Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return from_kafka_layout(reader.load())
