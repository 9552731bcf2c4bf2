"""Numeric helpers: safe ratios, conditional means and statistics over a row of sibling columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import col


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL on a zero denominator instead of the ANSI error."""
    return F.try_divide(col(numerator), col(denominator))


def safe_percent(numerator: Column | str, denominator: Column | str) -> Column:
    return safe_ratio(numerator, denominator) * 100


def exact_sum(value: Column | str) -> Column:
    """Sum of doubles that the order of the rows does not change, so that equal groups have equal sums and tie in a ranking.

    Values of up to eight decimals are added as decimals and the sum is rounded once. A group that holds any other (more
    decimals, NaN, beyond the decimal type) is added as doubles.
    """
    c = col(value)
    decimal = c.try_cast("decimal(28,8)")
    decimal = F.when(decimal.cast("double") == c, decimal)
    exact = F.when(F.count(decimal) == F.count(c), F.try_sum(decimal).cast("double"))
    return F.coalesce(exact, F.sum(c))


def mean_where(condition: Column, value: Column | str) -> Column:
    """Average of ``value`` over the rows where ``condition`` holds."""
    return F.avg(F.when(condition, col(value)))


def weighted_mean_where(condition: Column, value: Column | str, weight: Column | str) -> Column:
    """Weighted mean over a condition. A row with a weight but no value still counts in the denominator."""
    return safe_ratio(
        F.sum(F.when(condition, col(value) * col(weight))),
        F.sum(F.when(condition, col(weight))),
    )


def outside(c: Column | str, low: float, high: float) -> Column:
    """Strictly outside the closed interval; NULL stays NULL. NaN sorts above every number, so it is outside."""
    return (col(c) < low) | (col(c) > high)


def present_count(columns: Sequence[str]) -> Column:
    """How many sibling columns of the row are filled (unrolled, so it stays in generated code)."""
    return reduce(add, (F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in columns)).cast("long")


def present_sum(columns: Sequence[str]) -> Column:
    """Row sum with NULL as zero."""
    return reduce(add, (F.coalesce(F.col(c), F.lit(0.0)) for c in columns))


def any_outside(columns: Sequence[str], low: float, high: float) -> Column:
    """Whether any filled sibling column leaves the interval."""
    return reduce(lambda a, b: a | b, (F.coalesce(outside(c, low, high), F.lit(False)) for c in columns))


def banded(c: Column | str, steps: Sequence[tuple[float, str]], top: str, missing: str) -> Column:
    """Label of the first upper bound the value is below; ``top`` when it is below none."""
    out = F.when(col(c).isNull(), missing)
    for bound, label in steps:
        out = out.when(col(c) < bound, label)
    return out.otherwise(top)
