"""Bucketed tables: joins without exchange, rows equal to those of plain joins, NULL and hot keys, several sessions."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.operators.reconcile import match_outer
from plumbline.plans.star.layout import exchanges
from plumbline.session import fresh_path
from plumbline.sources import buckets

KEYS = ["year", "entity"]
SIDES = ("MATCH", "ONLY_LEFT", "ONLY_RIGHT")


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def sides(spark):
    n = F.col("id")
    key = [(n % 7).cast("int").alias("year"), F.when(n % 11 != 0, F.format_string("e%d", n)).alias("entity")]
    left = spark.range(0, 3000).select(*key, (n * 2).alias("a"))
    right = spark.range(1000, 4000).select(*key, (n * 3).alias("b"))
    return left, right


def written(spark, df, label, n=8):
    path = fresh_path(spark, label)
    return buckets.write_bucketed(df, path.rpartition("/")[2].replace("-", "_"), path, KEYS, n)


def test_matching_moves_no_rows_and_equals_the_plain_match(spark, sides):
    left, right = sides
    a, b = written(spark, left, "left"), written(spark, right, "right")
    assert a.even and b.even and rows_of(a.rows()) == rows_of(left)
    assert a.keyless.count() == left.where("entity is null").count() > 0
    assert len(a.keyed.inputFiles()) <= 8
    got = buckets.match_bucketed(a, b, {"a": "a"}, {"b": "b"}, SIDES)
    assert exchanges(got) == 0
    want = match_outer(left, right, KEYS, {"a": "a"}, {"b": "b"}, SIDES)
    assert exchanges(want) > 0 and rows_of(got) == rows_of(want) and got.columns == want.columns


def test_attached_columns_stay_in_their_buckets(spark, sides):
    left, right = sides
    a, b = written(spark, left, "left"), written(spark, right, "right")
    both = buckets.attach_bucketed(buckets.attach_bucketed(a, b, {"b": "b"}), b, {"c": "b"})
    assert exchanges(both.keyed) == 0
    grouped = both.keyed.groupBy(*KEYS).agg(F.sum("b").alias("b"))
    assert exchanges(grouped) == 0
    want = left.join(right, KEYS, "left").select(*KEYS, "a", "b", F.col("b").alias("c"))
    assert rows_of(both.rows()) == rows_of(want)
    matched = buckets.match_bucketed(both, b, {"a": "a", "c": "c"}, {"b": "b"}, SIDES)
    assert exchanges(matched) == 0 and matched.count() == left.count() + right.count() - left.where("entity is not null").join(right, KEYS).count()


def test_a_hot_key_is_joined_as_usual(spark, sides, monkeypatch):
    monkeypatch.setattr(buckets, "SMALL", 100)
    monkeypatch.setattr(buckets, "UNEVEN", 2)
    left, right = sides
    hot = left.unionAll(spark.range(2000).select(F.lit(6).cast("int"), F.lit("e1000"), "id"))
    a, b = written(spark, hot, "hot"), written(spark, right, "right")
    assert not a.even and b.even
    got = buckets.match_bucketed(a, b, {"a": "a"}, {"b": "b"}, SIDES)
    assert rows_of(got) == rows_of(match_outer(hot, right, KEYS, {"a": "a"}, {"b": "b"}, SIDES))
    more = buckets.attach_bucketed(a, b, {"b": "b"})
    assert not more.even and rows_of(more.rows()) == rows_of(hot.join(right, KEYS, "left").select(*KEYS, "a", "b"))


def test_a_table_is_opened_again_by_another_catalog(spark, sides):
    left, _ = sides
    path = fresh_path(spark, "again")
    a = buckets.write_bucketed(left, "again_first", path, KEYS, 4)
    spark.sql("DROP TABLE again_first")  # the files stay
    b = buckets.open_bucketed(spark, "again_second", path, left.schema, KEYS, 4)
    assert a.even == b.even and rows_of(b.rows()) == rows_of(left)
    assert exchanges(b.keyed.groupBy(*KEYS).count()) == 0


def test_empty_tables_and_other_keys(spark, sides):
    left, right = sides
    none, b = written(spark, left.where("false"), "none"), written(spark, right, "right")
    assert none.even and none.rows().count() == 0
    got = buckets.match_bucketed(none, b, {"a": "a"}, {"b": "b"}, SIDES)
    assert rows_of(got) == rows_of(match_outer(left.where("false"), right, KEYS, {"a": "a"}, {"b": "b"}, SIDES))
    path = fresh_path(spark, "other")
    other = buckets.write_bucketed(right, path.rpartition("/")[2].replace("-", "_"), path, ["entity"], 4)
    with pytest.raises(ValueError):
        buckets.match_bucketed(b, other, {}, {}, SIDES)
