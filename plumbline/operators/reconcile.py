"""Full outer matching of two sources with a match-status column, and row-count reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_L, _R = "__l_", "__r_"


def match_outer(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_values: Mapping[str, str],
    right_values: Mapping[str, str],
    labels: tuple[str, str, str],
    residual: Callable[[Callable[[str], Column]], Column] | None = None,
    status: str = "integration_status",
    presence: str | None = None,
) -> DataFrame:
    """Full outer join keeping unmatched rows of both sides.

    ``left_values`` / ``right_values`` map output names to source columns; keys come out coalesced.
    ``labels`` are (both, left only, right only); a side counts as present when its ``presence`` key (default:
    the last of ``keys``) is not NULL. ``residual`` gets an accessor for the right side's columns and is part
    of the join condition, so right rows failing it stay in the result unmatched.

    Rows with a NULL key can never match. They carry a hash of the row as an extra join key so that they
    spread over all partitions instead of meeting in one.
    """
    presence = presence or keys[-1]

    def prepare(df: DataFrame, prefix: str) -> DataFrame:
        has_null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
        scatter = F.when(has_null, F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("long"))
        return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], scatter.alias(prefix + "__scatter"))

    # The hash would keep every column of a side alive; the left one needs no others than these.
    a, b = prepare(left.select(*dict.fromkeys([*keys, presence, *left_values.values()])), _L), prepare(right, _R)
    on = reduce(lambda x, y: x & y, (F.col(_L + k) == F.col(_R + k) for k in keys))
    on = on & (F.col(_L + "__scatter") == F.col(_R + "__scatter"))
    if residual is not None:
        on = on & residual(lambda name: F.col(_R + name))
    joined = a.join(b, on, "full")
    both, only_left, only_right = labels
    in_left, in_right = F.col(_L + presence).isNotNull(), F.col(_R + presence).isNotNull()
    return joined.select(
        *[F.coalesce(F.col(_L + k), F.col(_R + k)).alias(k) for k in keys],
        *[F.col(_L + src).alias(out) for out, src in left_values.items()],
        *[F.col(_R + src).alias(out) for out, src in right_values.items()],
        F.when(in_left & in_right, both).when(in_left, only_left).otherwise(only_right).alias(status),
    )
