"""Stored summaries put together against exact counts and ranks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import sketches


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(200_000).select(
        (n % 24).alias("hour"), (n % 3).alias("kind"), F.when(n % 5 != 0, F.pmod(F.xxhash64(n), F.lit(60_000))).alias("who"),
        F.when(n % 3 != 2, F.pmod(F.xxhash64(n, F.lit(1)), F.lit(10**6)) + F.when(n % 100 == 0, 10**9).otherwise(0)).alias("took"),
    )


def test_united_summaries_are_near_exact_values(rows):
    hourly = sketches.summarised(rows, ["hour", "kind"], {"people": "who"}, {"took": "took"})
    got = {r.kind: r for r in sketches.united(hourly, ["kind"], ["people"], {"took": [0.5, 0.95, 0.99]}).collect()}
    exact = {r.kind: r for r in rows.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("who").alias("people")).collect()}
    for kind, r in exact.items():
        assert got[kind].n == r.n and abs(got[kind].people - r.people) <= 0.02 * r.people
    for kind in (0, 1):
        for q in (50, 95, 99):
            value, mine = got[kind][f"took_p{q}"], rows.where(F.col("kind") == kind)
            below, upto = mine.agg(F.avg((F.col("took") < value).cast("double")), F.avg((F.col("took") <= value).cast("double"))).first()
            assert below - 2 * sketches.RANK_ERROR <= q / 100 <= upto + 2 * sketches.RANK_ERROR
    # A group without any value has no quantile.
    assert got[2].took_p50 is None


def test_summaries_come_in_any_order_and_twice_change_no_distinct_count(rows):
    parts = [sketches.summarised(rows.where(F.col("hour") % 2 == i), ["kind"], {"people": "who"}) for i in (0, 1)]
    one = sketches.united(parts[0].unionAll(parts[1]), ["kind"], ["people"])
    again = sketches.united(parts[1].unionAll(parts[0]).unionAll(parts[1]), ["kind"], ["people"])
    assert {r.kind: r.people for r in one.collect()} == {r.kind: r.people for r in again.collect()}


def test_no_rows_no_summaries(rows):
    none = sketches.summarised(rows.where("false"), ["kind"], {"people": "who"}, {"took": "took"})
    assert sketches.united(none, ["kind"], ["people"], {"took": [0.5]}).count() == 0
