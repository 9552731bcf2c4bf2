"""Table-driven checks: expected versus actual counts, evaluated by one job per suite."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.bitmaps import bitmaps

OK, FAIL = "OK", "FAIL"


@dataclass(frozen=True, eq=False)
class Measure:
    """A number of a table: an aggregate over all its rows. Measures of one DataFrame share one pass over it.

    ``distinct`` names the column whose distinct values are counted, if any. With ``bits`` it is counted by bitmaps: ``value``
    is then an aggregate over (n, bits), the rows and bits of one bucket, and its sum over the buckets is the number.
    """

    df: DataFrame
    value: Column
    distinct: str | None = None
    bits: bool = False

    def rows(self) -> DataFrame:
        """What ``value`` is an aggregate of."""
        return bitmaps(self.df, [], [self.distinct]) if self.bits else self.df

    def frame(self) -> DataFrame:
        """The number as a table of one row."""
        return self.rows().agg(F.coalesce(self.value, F.lit(0)).cast("long").alias("n"))


@dataclass(frozen=True)
class Check:
    """Parts of a side are added up: integers, measures, or DataFrames with one row and one numeric column."""

    kind: str
    name: str
    expected: Sequence[int | Measure | DataFrame] = field(default_factory=list)
    actual: Sequence[int | Measure | DataFrame] = field(default_factory=list)


class CheckFailure(AssertionError):
    """One or more checks of a suite did not hold."""


def row_count(df: DataFrame, factor: int = 1) -> Measure:
    return Measure(df, F.count(F.lit(1)) * factor)


def count_where(df: DataFrame, condition: Column) -> Measure:
    return Measure(df, F.count_if(condition))


def distinct_count(df: DataFrame, column: str) -> Measure:
    return Measure(df, F.countDistinct(column), distinct=column)


def distinct_ids(df: DataFrame, column: str) -> Measure:
    """Distinct values of a whole-number key given out in sequence, by bitmaps: exact, and no row of the table is shuffled."""
    return Measure(df, F.sum(F.bitmap_count("bits")), distinct=column, bits=True)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> Measure:
    """How many keys occur more than once."""
    return row_count(df.groupBy(*keys).count().filter(F.col("count") > 1))


def surplus_rows(df: DataFrame, key: str) -> Measure:
    """Rows beyond one per distinct key, in one pass. NULL keys are surplus."""
    return Measure(df, F.count(F.lit(1)) - F.countDistinct(key), distinct=key)


def surplus_ids(df: DataFrame, key: str) -> Measure:
    """As :func:`surplus_rows` for a whole-number key given out in sequence, by bitmaps."""
    return Measure(df, F.sum(F.col("n") - F.bitmap_count("bits")), distinct=key, bits=True)


def has_rows(df: DataFrame) -> Measure:
    return Measure(df, (F.count(F.lit(1)) > 0).cast("int"))


def suite(
    spark: SparkSession,
    checks: Iterable[Check],
    executed_at: Column,
    identity: dict[str, Column] | None = None,
) -> DataFrame:
    """All checks as rows. Each part becomes one long row, so sides are summed by a tiny aggregate, never joined.

    All plain measures of one DataFrame come from one aggregate over it. Those that count distinct values have one for
    each column counted: several of them in one aggregate would multiply the rows it shuffles. Those counted by bitmaps
    share one pass again, which shuffles bits.
    """
    parts: DataFrame | None = None
    literals: list[tuple[str, str, int, int]] = []
    by_pass: dict[tuple[int, str | None], list[tuple[Check, str, Measure]]] = {}
    by_bits: dict[int, list[tuple[Check, str, Measure]]] = {}

    def add(rows: DataFrame) -> None:
        nonlocal parts
        parts = rows if parts is None else parts.unionAll(rows)

    def as_row(check: Check, side: str, number: Column) -> list[Column]:
        nothing = F.lit(0).cast("long")
        return [
            F.lit(check.kind).alias("check_type"),
            F.lit(check.name).alias("object_name"),
            (number if side == "e" else nothing).alias("expected_value"),
            (number if side == "a" else nothing).alias("actual_value"),
        ]

    for check in checks:
        for side, values in (("e", check.expected), ("a", check.actual)):
            for part in values:
                if isinstance(part, int):
                    literals.append((check.kind, check.name, part if side == "e" else 0, part if side == "a" else 0))
                elif isinstance(part, Measure) and part.bits:
                    by_bits.setdefault(id(part.df), []).append((check, side, part))
                elif isinstance(part, Measure):
                    by_pass.setdefault((id(part.df), part.distinct), []).append((check, side, part))
                else:
                    add(part.select(*as_row(check, side, F.col(part.columns[0]).cast("long"))))
    for measures in by_pass.values():
        numbers = [m.value.cast("long").alias(f"n{i}") for i, (_, _, m) in enumerate(measures)]
        wide = measures[0][2].df.agg(*numbers)
        rows = [F.struct(*as_row(check, side, F.col(f"n{i}"))) for i, (check, side, _) in enumerate(measures)]
        add(wide.select(F.inline(F.array(*rows))))
    for measures in by_bits.values():
        columns = sorted({m.distinct for _, _, m in measures})
        # One row for each column, so that numbers of the other columns are null there and count as nothing.
        each = bitmaps(measures[0][2].df, [], columns).groupBy("counted")
        own = [F.sum(F.when(F.col("counted") == m.distinct, 0)) + m.value for _, _, m in measures]
        wide = each.agg(*(F.coalesce(v, F.lit(0)).cast("long").alias(f"n{i}") for i, v in enumerate(own)))
        rows = [F.struct(*as_row(check, side, F.col(f"n{i}"))) for i, (check, side, _) in enumerate(measures)]
        add(wide.select(F.inline(F.array(*rows))))
        literals += [(check.kind, check.name, 0, 0) for check, _, _ in measures]  # a table without rows has no buckets
    if literals:
        rows = F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("check_type"),
                        F.lit(name).alias("object_name"),
                        F.lit(expected).cast("long").alias("expected_value"),
                        F.lit(actual).cast("long").alias("actual_value"),
                    )
                    for kind, name, expected, actual in literals
                ]
            )
        )
        fixed = spark.range(1).select(rows)
        parts = fixed if parts is None else parts.unionAll(fixed)
    if parts is None:
        raise ValueError("a suite needs at least one check")
    summed = parts.groupBy("check_type", "object_name").agg(
        F.sum("expected_value").alias("expected_value"), F.sum("actual_value").alias("actual_value")
    )
    return summed.withColumns(
        {
            "status": F.when(F.col("expected_value") == F.col("actual_value"), OK).otherwise(FAIL),
            **(identity or {}),
            "executed_at": executed_at,
        }
    )


def gate(results: DataFrame) -> None:
    """Raise when a check failed. Only the failing rows of a suite (tens of rows at most) reach the driver."""
    failed = results.filter(F.col("status") != OK).orderBy("check_type", "object_name").collect()
    if failed:
        lines = [f"{r.check_type} {r.object_name}: expected {r.expected_value}, got {r.actual_value}" for r in failed]
        raise CheckFailure("\n".join(lines))
