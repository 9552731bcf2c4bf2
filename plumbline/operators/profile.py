"""Source profiling: columns, volumes, temporal coverage, category frequency, whole-row search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import frame_row_json
from plumbline.operators.quality import union_all


def column_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table, position, column, type and nullability from the schemas alone (no data is read)."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal_position int, column_name string, data_type string, is_nullable boolean"
    )


def profile_columns(df: DataFrame, table: str, exact_distinct: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values, minimum and maximum per column, in one pass over the table.

    Distinct counts are HyperLogLog estimates by default; ``exact_distinct`` first groups each
    (column, value) pair, which spreads over value and column and stays exact.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    text = {c: F.col(c).cast("string") for c in plain}
    if exact_distinct:
        cells = df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), text[c].alias("v")) for c in plain]))
        )
        per_value = cells.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
        out = per_value.groupBy("column_name").agg(
            F.sum("n").alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("v").alias("distinct_count"),
        )
    else:
        measures = []
        for c in plain:
            measures += [
                F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                F.approx_count_distinct(c).alias(f"{c}__distinct"),
                F.min(c).cast("string").alias(f"{c}__min"),
                F.max(c).cast("string").alias(f"{c}__max"),
            ]
        wide = df.agg(F.count(F.lit(1)).alias("row_count"), *measures)
        out = wide.select(
            "row_count",
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"),
                            F.col(f"{c}__nulls").alias("null_count"),
                            F.col(f"{c}__distinct").alias("distinct_count"),
                            F.col(f"{c}__min").alias("min_value"),
                            F.col(f"{c}__max").alias("max_value"),
                        )
                        for c in plain
                    ]
                )
            ),
        )
    return out.select(F.lit(table).alias("table_name"), *out.columns)


def table_volume(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("quantidade_linhas")).select(F.lit(name).alias("tabela"), "quantidade_linhas")
        for name, df in tables.items()
    )


def temporal_coverage(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """First, last and number of distinct periods per source: ``{table: (frame, period column)}``."""
    return union_all(
        df.agg(
            F.min(period).alias("primeiro_ano"),
            F.max(period).alias("ultimo_ano"),
            F.countDistinct(period).alias("quantidade_anos"),
        ).select(F.lit(name).alias("tabela"), "*")
        for name, (df, period) in tables.items()
    )


def category_frequency(tables: Mapping[str, tuple[DataFrame, str]], out: str = "rede") -> DataFrame:
    """Row count per category and source, categories as text: ``{table: (frame, category column)}``."""
    return union_all(
        df.groupBy(F.col(category).cast("string").alias(out))
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .select(F.lit(name).alias("tabela"), out, "quantidade")
        for name, (df, category) in tables.items()
    )


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Selected columns in a presentation order."""
    return df.select(*columns).orderBy(*order)


def sample_rows(df: DataFrame, n: int = 100) -> DataFrame:
    return df.limit(n)


def search_rows(df: DataFrame, pattern: str, out: str = "registro", keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose JSON text matches ``pattern`` case-insensitively, as JSON text (plus the ``keep`` columns)."""
    return df.select(*keep, frame_row_json(df).alias(out)).filter(F.lower(out).rlike(pattern))
