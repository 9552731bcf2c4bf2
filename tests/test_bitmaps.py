from __future__ import annotations

import random

from pyspark.sql import functions as F

from plumbline.operators.bitmaps import bitmaps, distinct_from_bitmaps
from plumbline.operators.checks import Check, distinct_count, distinct_ids, row_count, suite, surplus_ids, surplus_rows

EDGE = [0, -1, 1, -32768, -32767, 32767, 32768, 32769, -32769, 2**62, -(2**62), 2**63 - 1, -(2**63)]


def test_counts_add_up_and_are_exact(spark):
    rng = random.Random(3)
    rows = [(d, rng.randint(-70_000, 70_000), rng.choice([*EDGE, None])) for d in range(30) for _ in range(300)]
    rows += [(5, 7, None)] * 2000  # a hot key
    df = spark.createDataFrame(rows, "day int, a int, b long").repartition(7)
    stored = bitmaps(df, ["day"], ["a", "b"])
    assert stored.schema.names == ["day", "counted", "bucket", "n", "bits"]
    out = distinct_from_bitmaps(stored, [F.floor(F.col("day") / 7).alias("week")]).collect()
    seen = {(r.week, r.counted): (r.n, r.n_distinct) for r in out}
    for week in range(5):
        for at, name in ((1, "a"), (2, "b")):
            own = [r[at] for r in rows if r[0] // 7 == week]
            assert seen[week, name] == (len(own), len(set(own) - {None}))
    assert len(out) == 10


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    assert [tuple(r) for r in distinct_from_bitmaps(bitmaps(df, [], ["a"]), []).collect()] == [("a", 3, 1)]
    assert distinct_from_bitmaps(bitmaps(df.limit(0), [], ["a"]), []).count() == 0


def test_suite_counts_by_bitmaps_without_expanding_rows(spark):
    rows = [(i % 50, i % 7, f"k{i % 11}") for i in range(200)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "a int, b long, s string")
    none = df.where(F.lit(False))
    checks = [
        Check("U", "a", [50], [distinct_ids(df, "a")]),
        Check("U", "b", [203 - 7], [surplus_ids(df, "b")]),
        Check("U", "s", [11], [distinct_count(df, "s")]),
        Check("U", "t", [203 - 11], [surplus_rows(df, "s")]),
        Check("U", "u", [203 - 50], [surplus_rows(df, "a")]),
        Check("U", "both", [row_count(df)], [surplus_ids(df, "a"), distinct_ids(df, "a")]),
        Check("U", "empty", [0], [surplus_ids(none, "a"), distinct_ids(none, "b")]),
        Check("U", "wrong", [1], [distinct_ids(df, "b")]),
    ]
    out = suite(spark, checks, F.current_timestamp())
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    seen = {r.object_name: (r.expected_value, r.actual_value, r.status) for r in out.collect()}
    assert len(seen) == len(checks) and seen.pop("wrong") == (1, 7, "FAIL")
    assert seen["empty"] == (0, 0, "OK") and {s for _, _, s in seen.values()} == {"OK"}
