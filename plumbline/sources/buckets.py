"""Tables bucketed by their keys, and joins of them that move no rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.reconcile import match_outer
from plumbline.session import stage

# A table is even if no bucket holds more than so many times the mean rows, small tables aside.
UNEVEN = 8
SMALL = 100_000


@dataclass(frozen=True)
class Bucketed:
    """Rows in buckets of ``keys`` and sorted by them; rows with a NULL key, which match nothing, lie apart."""

    keyed: DataFrame
    keyless: DataFrame
    keys: tuple[str, ...]
    buckets: int
    even: bool

    def rows(self) -> DataFrame:
        return self.keyed.unionAll(self.keyless)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> Bucketed:
    """A table written by :func:`write_bucketed`, registered in this session's catalog as ``name`` unless it is known there."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(map(_quoted, keys))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/keyed'"
    )
    even = spark.read.schema("even boolean").parquet(f"{path}/even").first()[0]
    return Bucketed(spark.table(name), spark.read.schema(schema).parquet(f"{path}/keyless"), tuple(keys), buckets, even)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> Bucketed:
    """Write ``df`` in ``buckets`` files, each with the rows of one bucket of ``keys``, under a new ``path``.

    One shuffle here saves one in every join and grouping by these keys later. It is meant for tables with about one
    row for each key. Whether a key or bucket is hot is measured and kept with the table; joins of such a
    table shuffle as others do, so its rows are never read by one task for each bucket.
    """
    spark = df.sparkSession
    staged = stage(df, "bucketed")
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    keyed = staged.where(~missing)
    sizes = keyed.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).count()
    most, total = sizes.agg(F.max("count"), F.sum("count")).first()
    even = (most or 0) <= max(SMALL, UNEVEN * (total or 0) / buckets)
    spark.range(1).select(F.lit(even).alias("even")).write.parquet(f"{path}/even")
    staged.where(missing).write.parquet(f"{path}/keyless")
    # The shuffle and the buckets use one hash, so each task writes whole buckets; an uneven table is spread by all its rows.
    dealt = keyed.repartition(buckets, *keys) if even else keyed
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path}/keyed").saveAsTable(_quoted(name))
    return open_bucketed(spark, name, path, df.schema, keys, buckets)


def attach_bucketed(left: Bucketed, right: Bucketed, values: Mapping[str, str]) -> Bucketed:
    """``left`` with columns of ``right`` (``{name: column}``, NULL where the key is missing there), still in its buckets.

    Rows stay where they are if both tables are even, so more tables can be attached or matched afterwards. A key
    that ``right`` holds several times multiplies the row, as in any join.
    """
    if left.keys != right.keys:
        raise ValueError(f"tables are bucketed by {left.keys} and {right.keys}")
    other = right.keyed.select(*[F.col(k).alias(f"__r_{k}") for k in left.keys], *[F.col(c).alias(o) for o, c in values.items()])
    on = reduce(lambda x, y: x & y, (left.keyed[k] == other[f"__r_{k}"] for k in left.keys))
    # Only even tables can be merged bucket by bucket; Spark chooses for others.
    base = left.keyed.hint("merge") if left.even and right.even else left.keyed
    keyed = base.join(other, on, "left").drop(*[f"__r_{k}" for k in left.keys])
    nothing = [F.lit(None).cast(t).alias(o) for o, t in other.dtypes if o in values]
    return replace(left, keyed=keyed, keyless=left.keyless.select("*", *nothing), even=left.even and right.even)


def match_bucketed(
    left: Bucketed, right: Bucketed, left_values: Mapping[str, str], right_values: Mapping[str, str], labels: tuple[str, str, str],
    status: str = "integration_status",
) -> DataFrame:
    """The rows of :func:`match_outer` on the common keys, without an exchange where both tables lie in even buckets."""
    if left.keys != right.keys:
        raise ValueError(f"tables are bucketed by {left.keys} and {right.keys}")
    keys = left.keys
    if not (left.even and right.even):
        return match_outer(left.rows(), right.rows(), keys, left_values, right_values, labels, status=status)
    both, only_left, only_right = labels
    a = left.keyed.select(*[F.col(k).alias(f"__l_{k}") for k in keys], *[F.col(c).alias(f"__a_{o}") for o, c in left_values.items()])
    b = right.keyed.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(c).alias(f"__b_{o}") for o, c in right_values.items()])
    on = reduce(lambda x, y: x & y, (F.col(f"__l_{k}") == F.col(f"__r_{k}") for k in keys))
    in_left, in_right = F.col(f"__l_{keys[-1]}").isNotNull(), F.col(f"__r_{keys[-1]}").isNotNull()
    # Sorted buckets are merged; the hint keeps a small side from being sent to all tasks first.
    matched = a.hint("merge").join(b, on, "full").select(
        *[F.coalesce(f"__l_{k}", f"__r_{k}").alias(k) for k in keys],
        *[F.col(f"__a_{o}").alias(o) for o in left_values], *[F.col(f"__b_{o}").alias(o) for o in right_values],
        F.when(in_left & in_right, both).when(in_left, only_left).otherwise(only_right).alias(status),
    )
    types = dict(matched.dtypes)

    def alone(rows: DataFrame, own: Mapping[str, str], label: str) -> DataFrame:
        values = [(F.col(own[o]) if o in own else F.lit(None).cast(types[o])).alias(o) for o in (*left_values, *right_values)]
        # A side is present, as in match_outer, if its last key is known.
        known = F.when(F.col(keys[-1]).isNotNull(), label).otherwise(only_right)
        return rows.select(*keys, *values, known.alias(status))

    return matched.unionAll(alone(left.keyless, left_values, only_left)).unionAll(alone(right.keyless, right_values, only_right))
