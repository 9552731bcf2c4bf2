"""Immutable source snapshots: lineage columns, Hive-layout Parquet, mandatory partition filter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.checks import Check, row_count, suite

LINEAGE = ("_ingestion_timestamp", "_batch_id", "_source_table")


def batch_id_at(at: dt.datetime) -> str:
    return at.strftime("batch_%Y%m%dT%H%M%SZ")


def with_lineage(df: DataFrame, at: dt.datetime, batch_id: str, source: str) -> DataFrame:
    """The source's columns plus when, in which batch and from where they were read."""
    return df.withColumns(
        {
            "_ingestion_timestamp": F.lit(at.isoformat(sep=" ")).cast("timestamp"),
            "_batch_id": F.lit(batch_id),
            "_source_table": F.lit(source),
        }
    )


def _folder(base: str, table: str, date: dt.date, batch_id: str) -> str:
    return f"{base}/{table}/ingestion_date={date.isoformat()}/batch_id={batch_id}"


def write_snapshot(df: DataFrame, base: str, table: str, at: dt.datetime, batch_id: str, source: str) -> None:
    """Write one snapshot; an existing one is never overwritten."""
    with_lineage(df, at, batch_id, source).write.mode("errorifexists").option("compression", "snappy").parquet(
        _folder(base, table, at.date(), batch_id)
    )


def read_snapshot(
    spark: SparkSession, base: str, table: str, date: dt.date, batch_id: str, schema: T.StructType | None = None
) -> DataFrame:
    """One snapshot. Date and batch are required arguments, so a scan over all snapshots cannot happen.

    Only the snapshot's own folder is listed; ``basePath`` supplies the two partition columns.
    """
    reader = spark.read.option("basePath", f"{base}/{table}")
    if schema is not None:
        full = T.StructType(
            [
                *schema.fields,
                T.StructField("_ingestion_timestamp", T.TimestampType()),
                T.StructField("_batch_id", T.StringType()),
                T.StructField("_source_table", T.StringType()),
                T.StructField("ingestion_date", T.DateType()),
                T.StructField("batch_id", T.StringType()),
            ]
        )
        reader = reader.schema(full)
    return reader.parquet(_folder(base, table, date, batch_id)).where(
        (F.col("ingestion_date") == F.lit(date)) & (F.col("batch_id") == batch_id)
    )


def snapshot_checks(
    spark: SparkSession, pairs: Mapping[str, tuple[DataFrame, DataFrame]], executed_at
) -> DataFrame:
    """Row counts of each source against its snapshot: ``{table: (source, snapshot)}``."""
    return suite(
        spark,
        [Check("RECONCILIATION", name, [row_count(src)], [row_count(snap)]) for name, (src, snap) in pairs.items()],
        executed_at,
    )
