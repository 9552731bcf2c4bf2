"""Exact distinct counts of whole-number keys from bitmaps: one bit a key, and bitmaps of short spans add up to long ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """(keys, counted, bucket, n, bits): for each of the whole-number ``columns``, its values as bits, 32,768 to a bucket.

    All columns come from one pass. Rows become bits before the shuffle, so a task sends 4 kB for each bucket it met,
    however many rows it read and however hot a key is. Meant for keys given out in sequence; of scattered ones (hashes),
    each may need a bucket of its own. Nulls are rows (``n``) without a bit, in a bucket that is null.
    """
    names = rows.select(*keys).columns
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("counted"),
                F.bitmap_bucket_number(F.col(c).cast("long")).alias("bucket"),
                F.bitmap_bit_position(F.col(c).cast("long")).alias("position"),
            )
            for c in columns
        ]
    )
    bits = F.bitmap_construct_agg("position").alias("bits")
    return rows.select(*keys, F.inline(cells)).groupBy(*names, "counted", "bucket").agg(F.count(F.lit(1)).alias("n"), bits)


def distinct_from_bitmaps(stored: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """(keys, counted, n, n_distinct): stored bitmaps put together by coarser keys; the counts are exact."""
    names = stored.select(*keys).columns
    united = stored.groupBy(*keys, "counted", "bucket").agg(F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*names, "counted").agg(F.sum("n").alias("n"), F.sum(F.bitmap_count("bits")).alias("n_distinct"))
