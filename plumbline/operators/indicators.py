"""Indicator operators: change, next-period targets, shares, target status, and skew-proof ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numeric import safe_percent
from plumbline.functions.text import col
from plumbline.session import stage


def change_from_previous(
    df: DataFrame, entity: Sequence[str], period: str, value: str, out: str
) -> DataFrame:
    """``value`` minus the value of the entity's previous *row* (periods may be missing in between).

    Groups are one entity's periods, so their size is the number of periods, not a share of the data.
    """
    w = Window.partitionBy(*entity).orderBy(period)
    return df.withColumn(out, F.col(value) - F.lag(value).over(w))


def next_period(df: DataFrame, entity: Sequence[str], period: str, targets: Mapping[str, str]) -> DataFrame:
    """Values of the entity's next row: ``{output: source column}``, all from one sort."""
    w = Window.partitionBy(*entity).orderBy(period)
    return df.withColumns({out: F.lead(src).over(w) for out, src in targets.items()})


def share_of_total(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Percentage of the group total. Meant for aggregated rows, where a group holds one row per category."""
    total = F.sum(value).over(Window.partitionBy(*group))
    return df.withColumn(out, safe_percent(F.col(value), total))


def target_status(result: Column | str, target: Column | str, gap: Column | str, labels: Sequence[str]) -> Column:
    """``labels``: no result, no target, reached, missed; checked in this order."""
    no_result, no_target, reached, missed = labels
    return (
        F.when(col(result).isNull(), no_result)
        .when(col(target).isNull(), no_target)
        .when(col(gap) >= 0, reached)
        .otherwise(missed)
    )


def value_label(subject: Column | str, labels: Mapping[int | str, str], otherwise: str | Column) -> Column:
    """Label per exact value; NULL and unknown values fall through to ``otherwise``."""
    out = None
    for value, label in labels.items():
        hit = col(subject) == value
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def _tile(position: Column, n: Column, tiles: int) -> Column:
    """Tile of a 1-based position when n rows are dealt into tiles whose sizes differ by at most one."""
    size, extra = F.floor(n / tiles), n % tiles
    wide = (size + 1) * extra
    narrow = F.greatest(size, F.lit(1))
    return (
        F.when(position <= wide, F.ceil(position / (size + 1)))
        .otherwise(extra + F.ceil((position - wide) / narrow))
        .cast("int")
    )


def _null_safe_join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``names``, where NULL matches NULL; the columns of the left side stay."""
    other = {n: f"__right_{n}" for n in names}
    renamed = right.withColumnsRenamed(other)
    same = [F.col(n).eqNullSafe(F.col(r)) for n, r in other.items()]
    return left.join(renamed, same, how).drop(*other.values())


def rank_block(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    key: Sequence[str],
    rank: str = "rank",
    percent: str = "percent_rank",
    tile: str = "tile",
    tiles: int = 4,
) -> DataFrame:
    """``df`` with descending rank, ascending percent rank and descending tile of ``value`` within ``group``.

    Every row is kept: NULL groups are groups, and rows without a value have NULL in the three columns. ``key``
    (unique within the group) breaks ties between tiles. ``df`` is read twice, once to sample the ranges, so it should
    be a staged or stored table.

    One plan serves every size. Rows are range-partitioned on (group, value desc, key); ``key`` makes every row
    distinct, so the ranges stay even however skewed groups and values are, and adaptive execution merges small
    neighbours. The slice number is staged with the rows, because offsets and rows must agree on it. Positions
    inside a slice come from a window over (slice, group); a summary with one row per (slice, group) carries the
    running offset. Ties that cross slices can only be the first or the last value of a slice, so only those edge
    values are aggregated across slices.
    """
    order = [F.desc_nulls_last(value), *key]
    sliced = stage(
        df.repartitionByRange(*group, *order).withColumn("__slice", F.spark_partition_id()), "slices"
    )
    cell = ["__slice", *group]
    summary = _slice_summary(sliced.filter(F.col(value).isNotNull()), group, value)
    inside = Window.partitionBy(*cell).orderBy(F.desc_nulls_last(value))
    placed = Window.partitionBy(*cell).orderBy(*order)
    local = sliced.withColumns(
        {
            "__row": F.row_number().over(placed).cast("long"),
            "__local_rank": F.rank().over(inside).cast("long"),
            "__local_ties": F.count(F.lit(1)).over(inside.rangeBetween(0, 0)),
        }
    )
    joined = _null_safe_join(local, summary, cell, "left")

    def pick(suffix: str, otherwise: Column) -> Column:
        return (
            F.when(F.col(value) == F.col("__first"), F.col(f"__first_{suffix}"))
            .when(F.col(value) == F.col("__last"), F.col(f"__last_{suffix}"))
            .otherwise(otherwise)
        )

    n, position = F.col("__n"), F.col("__offset") + F.col("__row")
    own_rank = pick("rank", F.col("__offset") + F.col("__local_rank"))
    below = n - (own_rank - 1) - pick("ties", F.col("__local_ties"))
    scored = F.col(value).isNotNull()
    return joined.select(
        *df.columns,
        F.when(scored, own_rank).cast("long").alias(rank),
        F.when(scored, F.when(n > 1, below / (n - 1)).otherwise(F.lit(0.0))).alias(percent),
        F.when(scored, _tile(position, n, tiles)).alias(tile),
    )


def _slice_summary(sliced: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per (slice, group): rows before it, group size, and rank and ties of its first and last value."""
    cell = ["__slice", *group]
    # Size, edge values and how often each edge value occurs in the slice.
    counts = sliced.groupBy(*cell, value).count()
    edges = counts.groupBy(*cell).agg(
        F.sum("count").alias("__size"),
        F.max(value).alias("__first"), F.max_by("count", value).alias("__first_count"),
        F.min(value).alias("__last"), F.min_by("count", value).alias("__last_count"),
    )
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    summary = stage(
        edges.withColumns(
            {
                "__offset": F.coalesce(F.sum("__size").over(before), F.lit(0)),
                "__n": F.sum("__size").over(Window.partitionBy(*group)),
            }
        ),
        "slice-summary",
    )
    # Global start and count of every edge value; a slice of one value contributes it once.
    first_edge = summary.select(
        *group, F.col("__first").alias("__v"), F.col("__offset").alias("__start"), F.col("__first_count").alias("__c")
    )
    last_edge = summary.filter(F.col("__first") != F.col("__last")).select(
        *group,
        F.col("__last").alias("__v"),
        (F.col("__offset") + F.col("__size") - F.col("__last_count")).alias("__start"),
        F.col("__last_count").alias("__c"),
    )
    runs = (
        first_edge.unionByName(last_edge)
        .groupBy(*group, "__v")
        .agg(F.min("__start").alias("__start"), F.sum("__c").alias("__c"))
    )
    for edge in ("first", "last"):
        own = runs.select(
            *group,
            F.col("__v").alias(f"__{edge}"),
            (F.col("__start") + 1).alias(f"__{edge}_rank"),
            F.col("__c").alias(f"__{edge}_ties"),
        )
        summary = _null_safe_join(summary, own, [*group, f"__{edge}"])
    return summary
