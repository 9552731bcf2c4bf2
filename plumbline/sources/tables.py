"""Product tables, views and append-only histories on Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from plumbline.session import stage


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


# Interleaved layouts: ranges of a column (a power of two), and about how many rows are looked at to find them.
RANGE_BITS = 6
RANGE_SAMPLE = 20_000


def _splits(sample: list, bits: int) -> list:
    """Values that cut the sorted sample into at most ``2 ** bits`` ranges of about equal numbers of rows."""
    known = sorted(v for v in sample if v is not None)
    count = 1 << bits
    return sorted({known[len(known) * i // count] for i in range(1, count)}) if known else []


def _range_number(column: Column, splits: list) -> Column:
    """The number of splits not above a value (null: 0), by halving: a few comparisons for each row."""

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(splits[middle]), below(middle + 1, high)).otherwise(below(low, middle))

    return below(0, len(splits))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = RANGE_BITS, sample: int = RANGE_SAMPLE) -> Column:
    """A key that is near for rows near in all of ``columns``: the bits of their range numbers, highest first, in turn.

    Ranges hold about equal numbers of rows, so skewed columns and texts are spread like any other. They are found from
    a sample of about ``sample`` rows, which decides where rows lie and nothing else.
    """
    share = min(1.0, sample / max(1, df.count()))
    some = df.select(*columns).sample(share, seed=7).collect()
    numbers = [_range_number(F.col(c), _splits([r[i] for r in some], bits)) for i, c in enumerate(columns)]
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for number in numbers:
            key = key * 2 + F.shiftright(number, bit).bitwiseAND(F.lit(1))
    return key


def clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str], interleave: bool = False, files: int | None = None) -> DataFrame:
    """Rows laid out for a partitioned, clustered write.

    Range partitioning on partition and cluster columns spreads each table partition over many tasks (hashing
    on a year would give one task per year). A row hash lets a hot cluster key be split as well, and the input
    partition number splits even exact copies of a row; both are stable when a lost task is run again. Sorted
    files give tight row-group statistics for skipping. Ranges are found by sampling, which would compute ``df`` a
    second time, so it is staged first.

    Sorted rows serve filters on the first cluster column; with ``interleave`` a filter on any of them skips files,
    each on fewer than the first alone would. ``files`` sets the number of ranges, else Spark does.
    """
    if not cluster_by:
        return df.hint("rebalance", *partition_by) if partition_by else df
    spread = ["__hash", "__origin"]
    staged = stage(df, "clustered")
    keyed = staged.withColumns({"__hash": F.xxhash64(*df.columns), "__origin": F.spark_partition_id()})
    order = list(cluster_by)
    if interleave and len(cluster_by) > 1:
        keyed = keyed.withColumn("__key", interleaved(staged, cluster_by))
        order = ["__key", *cluster_by]
    ranges = [] if files is None else [files]
    ranged = keyed.repartitionByRange(*ranges, *partition_by, *order, *spread)
    return ranged.sortWithinPartitions(*partition_by, *order).drop("__key", *spread)


class Store:
    """Tables of one run under ``base/<run id>/<table>``.

    A run writes only new folders, so a failed or repeated task never touches published data. ``publish``
    appends the run id to a small log and readers follow the newest entry: replacing every table at once.
    """

    LOG = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("published_at", T.TimestampType())])

    def __init__(self, spark: SparkSession, base: str, run_id: str):
        self.spark, self.base, self.run_id = spark, base, run_id

    def path(self, name: str) -> str:
        return f"{self.base}/{self.run_id}/{name}"

    def replace(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
        interleave: bool = False, files: int | None = None,
    ) -> DataFrame:
        writer = clustered(df, partition_by, cluster_by, interleave, files).write.mode("errorifexists").option("compression", "snappy")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.parquet(self.path(name))
        return df.select(*schema.names) if schema is not None else df

    def files_touched(self, name: str, column: str, low, high) -> int:
        """How many files may hold rows with ``column`` in a range, by each file's least and greatest value.

        The least is at most ``high`` where any value is, and so on. Two flags a file are summed up in place, while least and
        greatest texts would have each task sort its rows by the file's name.
        """
        value, file = F.col(column), F.input_file_name().alias("file")
        each = self.read(name).groupBy(file).agg(F.bool_or(value <= F.lit(high)).alias("starts"), F.bool_or(value >= F.lit(low)).alias("ends"))
        return each.where("starts AND ends").count()

    def publish(self) -> None:
        row = self.spark.range(1).select(
            F.lit(self.run_id).alias("run_id"), F.current_timestamp().alias("published_at")
        )
        row.write.mode("append").parquet(f"{self.base}/_published")

    @classmethod
    def current(cls, spark: SparkSession, base: str) -> Store:
        log = spark.read.schema(cls.LOG).parquet(f"{base}/_published")
        newest = log.agg(F.max_by("run_id", "published_at")).first()[0]
        if newest is None:
            raise LookupError(f"nothing published under {base}")
        return cls(spark, base, newest)


def create_table_if_absent(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty typed table folder unless one exists."""
    try:
        spark.read.schema(schema).parquet(path).schema
    except AnalysisException:
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def append_if_absent(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], day_of: str | None = None
) -> DataFrame:
    """Insert-only merge: append the rows whose keys the history lacks, and return the whole history.

    A NULL key matches nothing and is inserted every time. One writer per history is assumed. ``day_of`` names
    the timestamp whose date partitions the history; only partitions of the incoming days are searched.
    """
    incoming = rows
    partition = []
    if day_of:
        partition = ["__day"]
        incoming = rows.withColumn("__day", F.to_date(day_of))
    create_table_if_absent(spark, path, incoming.schema, partition)
    history = spark.read.schema(incoming.schema).parquet(path)
    on = [*keys, *partition]
    fresh = incoming.join(history.select(*on), on, "left_anti").select(*incoming.columns)
    # Files already listed in the plan above are what is searched; new files land beside them.
    writer = fresh.write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return spark.read.schema(incoming.schema).parquet(path).select(*rows.columns)
