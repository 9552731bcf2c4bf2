"""Repeat detection and latest-row selection that hold up when one key owns most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPREAD, _LOCAL, _HASH = "__spread", "__local", "__hash"


def orderable(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` whose type Spark can sort on."""

    def sortable(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return sortable(t.elementType)
        if isinstance(t, T.StructType):
            return all(sortable(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))

    return [n for n in names if sortable(df.schema[n].dataType)]


def mark_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    flag: str = "is_repeat",
    spread: int | None = None,
) -> DataFrame:
    """Flag every row of a key except the first one under ``order``.

    Remaining columns break ties so the survivor is repeatable. NULL keys form one group, like any value.

    The row number is taken in two rounds. Round one ranks inside ``(key, spread)`` where ``spread`` comes from the
    input partition, so a key holding a third of all rows, even as exact copies, is cut into ``spread`` pieces (as many
    as there are shuffle partitions by default). Only the first row of each piece can still win; round two ranks those
    together while the certain repeats stay in their own pieces. No group sees more than its share of the hot key plus
    ``spread`` candidates, the input is read once, and nothing is counted first or joined back; the price is a second
    shuffle of the rows. A hash of the key leads each sort: rows are told apart by its 8 bytes, where a first key
    column of a few values, such as a year, would leave every comparison to the whole row.
    """
    ties = [F.col(c) for c in orderable(df, [c for c in df.columns if c not in keys])]
    ranking = [*order, *ties]
    pieces = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = df.withColumns({_HASH: F.xxhash64(*keys), _SPREAD: F.pmod(F.spark_partition_id(), F.lit(pieces))})
    first = first.withColumn(
        _LOCAL, F.row_number().over(Window.partitionBy(_HASH, *keys, _SPREAD).orderBy(*ranking))
    )
    # Candidates meet in piece -1; a row already beaten keeps its piece and can never rank first again.
    first = first.withColumn(_SPREAD, F.when(F.col(_LOCAL) == 1, F.lit(-1)).otherwise(F.col(_SPREAD)))
    second = Window.partitionBy(_HASH, *keys, _SPREAD).orderBy(*ranking)
    return first.withColumn(
        flag, (F.col(_SPREAD) != -1) | (F.row_number().over(second) > 1)
    ).drop(_HASH, _SPREAD, _LOCAL)


def drop_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows that :func:`mark_repeats` leaves unflagged, by one shuffle.

    Spark limits each key to its first row before the shuffle as well, so a hot key sends one row per task.
    """
    ties = [F.col(c) for c in orderable(df, [c for c in df.columns if c not in keys])]
    first = Window.partitionBy(_HASH, *keys).orderBy(*order, *ties)
    placed = df.withColumn(_HASH, F.xxhash64(*keys)).withColumn(_LOCAL, F.row_number().over(first))
    return placed.filter(F.col(_LOCAL) == 1).drop(_HASH, _LOCAL)


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``recency`` columns (NULL counts as oldest).

    Remaining columns break ties. Spark limits each group to its first row before the shuffle as well as after it, so
    a hot key sends one row per task; both limits sort their input. A ``max_by`` over structs sorts the same rows and
    carries each column twice; a maximum joined back reads the input twice.
    """
    ties = [c for c in orderable(df, [c for c in df.columns if c not in keys]) if c not in recency]
    newest = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in [*recency, *ties]))
    return df.withColumn(_LOCAL, F.row_number().over(newest)).filter(F.col(_LOCAL) == 1).drop(_LOCAL)
