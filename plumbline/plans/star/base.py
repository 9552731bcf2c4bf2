"""Table access and the query record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    """``run(spark, data folder)`` and the SQL that gives the same rows (None where SQL cannot say it)."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(df: DataFrame, c: Column) -> list[int]:
    """The different values of a narrow expression, such as the years of a table, in order: they become columns."""
    return sorted(r.v for r in df.select(c.alias("v")).distinct().collect() if r.v is not None)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def stamp(c: Column | str) -> Column:
    """A time as text, so that results compare independently of the client's time types."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
