"""Do two tables hold the same rows? Hash sums of partitions and buckets, descended to the rows that differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Buckets of a partition; the sums of all buckets of a partition make the partition's.
BUCKETS = 4096

SAME, DIFFERENT, CHANGED, MISSING, EXTRA, REPEATED = "SAME", "DIFFERENT", "CHANGED", "MISSING", "EXTRA", "REPEATED"
_SUMS = ("n", "sum_a", "sum_b")


def _hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds two hashes of the whole row, which tell null from nothing and one column from the next, and a bucket."""
    cells = [x for c in rows.columns for x in (F.col(c).isNull(), F.col(c))]
    first, second = F.xxhash64(*cells), F.xxhash64(F.lit("second"), *cells)
    return rows.withColumns({"__a": first, "__b": second}).withColumn("__bucket", F.pmod(F.col("__a"), F.lit(buckets)).cast("int"))


def content_summary(rows: DataFrame, by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(by, bucket, n, sum_a, sum_b): the number of rows and the sums of their hashes, by partition columns and bucket.

    Sums depend on no order and count repeated rows. They are made before the shuffle, so a table of any size sends at
    most a row for each bucket and task; kept beside a table, they stand for it in later comparisons.
    """
    sums = {"sum_a": F.sum(F.col("__a").cast("decimal(38,0)")), "sum_b": F.sum(F.col("__b").cast("decimal(38,0)"))}
    grouped = _hashed(rows, buckets).groupBy(*by, F.col("__bucket").alias("bucket"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), *(c.alias(n) for n, c in sums.items()))


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_left, n_right, same) of two summaries; nulls in keys are values."""
    sides = left.withColumn("__side", F.lit(1)).unionByName(right.withColumn("__side", F.lit(-1)))
    own = {"n_left": 1, "n_right": -1}
    counts = [F.sum(F.when(F.col("__side") == s, F.col("n")).otherwise(0)).alias(n) for n, s in own.items()]
    rest = [F.sum(F.col(c) * F.col("__side")).alias(f"__{c}") for c in _SUMS]
    out = sides.groupBy(*keys).agg(*counts, *rest)
    same = (F.col("__n") == 0) & (F.col("__sum_a") == 0) & (F.col("__sum_b") == 0)
    return out.select(*keys, "n_left", "n_right", same.alias("same"))


def partition_differences(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n_left, n_right, status) for each partition of two summaries: SAME or DIFFERENT content."""
    status = F.when(F.col("same"), SAME).otherwise(DIFFERENT).alias("status")
    return _beside(left, right, by).select(*by, "n_left", "n_right", status)


def row_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], summaries: tuple[DataFrame, DataFrame] | None = None,
    by: Sequence[str] = (), buckets: int = BUCKETS,
) -> DataFrame:
    """(keys, n_left, n_right, status) for each key whose rows differ between two tables of the same columns.

    CHANGED: as many rows, other contents; MISSING: none on the right; EXTRA: none on the left; REPEATED: other numbers of
    rows. Only rows of buckets that differ are shuffled: the list of these is at most ``buckets`` for each partition
    that differs, and joined by its size. Null keys are values like others. ``summaries`` of both tables, by the same
    ``by`` and ``buckets``, spare making them here.
    """
    sums = summaries or (content_summary(left, by, buckets), content_summary(right, by, buckets))
    place = [*by, "bucket"]
    open_buckets = _beside(*sums, place).where("not same").select(*(F.col(c).alias(f"__open_{c}") for c in place))
    sides = []
    for rows, side in ((left, 1), (right, -1)):
        hashed = _hashed(rows, buckets)
        on = F.col("__bucket") == F.col("__open_bucket")
        for c in by:
            on = on & F.col(c).eqNullSafe(F.col(f"__open_{c}"))
        sides.append(hashed.join(open_buckets, on, "left_semi").withColumn("__side", F.lit(side)))
    each = sides[0].unionByName(sides[1])
    n_left, n_right = (F.sum((F.col("__side") == s).cast("long")).alias(n) for n, s in (("n_left", 1), ("n_right", -1)))
    differing = each.groupBy(*keys, "__a", "__b").agg(n_left, n_right).where("n_left <> n_right")
    out = differing.groupBy(*keys).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    status = F.when(F.col("n_right") == 0, MISSING).when(F.col("n_left") == 0, EXTRA).when(F.col("n_left") == F.col("n_right"), CHANGED)
    return out.select(*keys, "n_left", "n_right", status.otherwise(REPEATED).alias("status"))
