"""Summaries that add up: distinct counts and quantiles of any span from stored ones of short spans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distinct counts: 2 ** 15 registers, a standard error of 0.6 % and hardly any for small numbers; at most 32 kB a sketch.
REGISTERS_LOG2 = 15
# Quantiles: the rank of an answer is off by 0.5 % of all rows at most, at a confidence of 99 %; about 8 kB a sketch.
QUANTILE_K = 800
RANK_ERROR = 0.005


def summarised(
    rows: DataFrame, keys: Sequence[str | Column], distinct: Mapping[str, str] | None = None, quantiles: Mapping[str, Column | str] | None = None
) -> DataFrame:
    """(keys, n, sketches): rows, and a sketch for each name of ``distinct`` (of a column's values) and ``quantiles`` (of whole numbers).

    Sketches are built before the shuffle, so a group of any size sends one for each task. Null values are not counted.
    Stored by day or hour, the rows serve :func:`united` for any span, and a late row needs its own group only.
    """
    sketches = [F.hll_sketch_agg(c, REGISTERS_LOG2).alias(n) for n, c in (distinct or {}).items()]
    for name, measure in (quantiles or {}).items():
        value = measure if isinstance(measure, Column) else F.col(measure)
        sketches.append(F.kll_sketch_agg_bigint(value.cast("long"), QUANTILE_K).alias(name))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sketches)


def united(
    summaries: DataFrame, keys: Sequence[str | Column], distinct: Sequence[str] = (), quantiles: Mapping[str, Sequence[float]] | None = None
) -> DataFrame:
    """(keys, n, estimates): stored summaries put together by coarser keys.

    A distinct sketch becomes its count, a quantile sketch a column for each quantile asked for (``name_p95`` for 0.95),
    null where no value was seen.
    """
    merged = [F.hll_union_agg(c).alias(c) for c in distinct] + [F.kll_merge_agg_bigint(c).alias(c) for c in quantiles or {}]
    out = summaries.groupBy(*keys).agg(F.sum("n").alias("n"), *merged)
    out = out.withColumns({c: F.hll_sketch_estimate(c) for c in distinct})
    for name, wanted in (quantiles or {}).items():
        out = out.withColumns({f"{name}_p{round(q * 100)}": F.when(F.kll_sketch_get_n_bigint(name) > 0, F.kll_sketch_get_quantile_bigint(F.col(name), F.lit(q))) for q in wanted}).drop(name)
    return out
