"""Session defaults and staging in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def build_session(app: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI semantics, UTC timestamps and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # De-duplication state outgrows the heap; changes are checkpointed instead of whole snapshots.
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # The JVM never compiles a method above 8,000 bytes of code; smaller generated pieces run faster.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="plumbline-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder nobody has written to yet."""
    return f"{shared_folder(spark)}/plumbline/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a relation feeds several branches (clean rows and quarantine, rank offsets and ranked
    rows). The written copy cuts the lineage, so a lost executor costs one re-read instead of the whole
    upstream plan, and unlike a cached block it keeps Parquet column pruning and size statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in at least two tasks for each core, for work that is far heavier than reading its input.

    A few compact files are read by as few tasks, and what is planned behind them runs there too. Rows meet by a hash of
    ``keys``, so a lost task finds the same rows again. The number is given, as adaptive execution goes by size.
    """
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)
