"""Wide rows to long rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(
    df: DataFrame, columns: Mapping[int, str], key_name: str, value_name: str, key_type: str = "long"
) -> DataFrame:
    """One output row per entry of ``columns`` (``{key: wide column}``), NULL values included.

    The row count is therefore always input rows × ``len(columns)``; a narrow Generate, no shuffle.
    """
    pairs = [
        F.struct(F.lit(key).cast(key_type).alias(key_name), F.col(name).alias(value_name))
        for key, name in columns.items()
    ]
    keep = [c for c in df.columns if c not in columns.values()]
    return df.select(*keep, F.inline(F.array(*pairs)))
