"""Interleaved table layouts: every row stays, and a filter on any cluster column skips files."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from plumbline.sources import tables


def test_range_numbers_follow_the_splits(spark):
    splits = tables._splits([*range(1000), None], 3)
    assert splits == [125, 250, 375, 500, 625, 750, 875] and tables._splits([None], 3) == [] and tables._splits([7] * 50, 3) == [7]
    rows = spark.createDataFrame([(v,) for v in (-5, 124, 125, 126, 874, 875, 9999, None)], "v int")
    got = [r[0] for r in rows.select(tables._range_number(F.col("v"), splits)).collect()]
    assert got == [0, 0, 1, 1, 6, 7, 7, 0]


def test_interleaved_key_takes_bits_in_turn(spark):
    rows = spark.range(64).select((F.col("id") % 8).alias("a"), F.format_string("t%d", F.floor(F.col("id") / 8)).alias("b"))
    for r in rows.withColumn("key", tables.interleaved(rows, ["a", "b"], bits=3)).collect():
        a, b = f"{r.a:03b}", f"{int(r.b[1:]):03b}"
        assert r.key == int("".join(x + y for x, y in zip(a, b)), 2)


def test_layouts_keep_all_rows_and_interleaving_skips_files(spark, tmp_path):
    """A hot value, nulls, exact copies and a partition column; filters on the second column and on the third."""
    n = F.col("id")
    rows = spark.range(20_000).select(
        F.when(n % 3 != 0, "hot").otherwise(F.format_string("k%05d", F.pmod(F.xxhash64(n), F.lit(9999)))).alias("k"),
        F.when(n % 50 != 0, F.pmod(F.xxhash64(n, F.lit(1)), F.lit(1000))).alias("v"),
        F.pmod(F.xxhash64(n, F.lit(2)), F.lit(1000)).alias("w"), (n % 2).alias("part"),
    ).unionAll(spark.range(500).select(F.lit("copy"), F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit(1).cast("long")))
    store = tables.Store(spark, str(tmp_path), "run")
    want = Counter(map(tuple, rows.collect()))
    touched = {}
    for name, interleave in (("sorted", False), ("interleaved", True)):
        out = store.replace(name, rows, ["part"], ["k", "v", "w"], interleave, files=64)
        assert Counter(map(tuple, out.collect())) == want
        touched[name] = [store.files_touched(name, c, 100, 120) for c in ("v", "w")]
    files = store.read("sorted").select(F.input_file_name()).distinct().count()
    # Sorted, the last column is spread over all files.
    assert touched["sorted"][1] > 0.8 * files and max(touched["interleaved"]) < 0.7 * files
    empty = store.replace("none", rows.where("false"), ["part"], ["k", "v"], True)
    assert empty.count() == 0 and empty.columns == rows.columns


def test_files_hold_few_rows_however_large_the_table(spark):
    from plumbline.plans.star.layout import FILES, ROWS_PER_FILE, layout_files

    assert layout_files(spark.range(10)) == FILES
    assert layout_files(spark.range(1000 * ROWS_PER_FILE + 1)) == 1001


def test_files_touched_goes_by_least_and_greatest_value_and_sorts_nothing(spark, tmp_path, monkeypatch):
    from plumbline.sources.tables import Store

    frame = type(spark.range(1))
    store, plans, count = Store(spark, str(tmp_path), "run"), [], frame.count

    def counted(df):
        plans.append(df._jdf.queryExecution().toString())
        return count(df)

    for rows in ([("a",), ("c",)], [("m",), (None,)], [("x",), ("z",)], [(None,)]):
        spark.createDataFrame(rows, "s string").coalesce(1).write.mode("append").parquet(store.path("t"))
    monkeypatch.setattr(frame, "count", counted)
    # A range between a file's values touches it too.
    assert [store.files_touched("t", "s", *r) for r in (("b", "b"), ("d", "l"), ("c", "m"), ("n", "zz"), ("a", "z"))] == [1, 0, 2, 1, 3]
    assert plans and not any("SortAggregate" in p for p in plans)
