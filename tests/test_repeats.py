"""What is done to find repeated keys: how often rows are shuffled, and by what they are sorted."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from plumbline.operators.dedup import drop_repeats, mark_repeats
from plumbline.plans.literacy.silver import pupils_with_results
from plumbline.plans.star.literacy import LazyLayers

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def rows(spark):
    """Keys of few years and many ids; a third of all rows share one key, copies included, and some keys are NULL."""
    n = F.col("id")
    year = F.when(n % 50 == 0, None).otherwise(2023 + n % 3)
    key = F.when(n % 3 == 0, "hot").when(n % 7 == 0, None).otherwise((n / 2).cast("int").cast("string"))
    return spark.range(3000).select(year.alias("year"), key.alias("key"), (n % 10).alias("place"), (n % 4).cast("double").alias("score"))


def test_rows_kept_are_those_that_marking_leaves(rows):
    order = [F.desc("place")]
    marked = mark_repeats(rows, ["year", "key"], order).filter("NOT is_repeat").drop("is_repeat")
    kept = drop_repeats(rows, ["year", "key"], order)
    assert kept.columns == rows.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, marked.collect()))
    assert kept.count() == rows.select("year", "key").distinct().count()


def test_dropping_repeats_shuffles_once_and_limits_keys_before(rows):
    plan = plan_of(drop_repeats(rows, ["year", "key"], [F.desc("place")]))
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2


def test_sorts_begin_with_the_hash_of_the_key(rows):
    plan = plan_of(mark_repeats(rows, ["year", "key"], [F.desc("place")]))
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 2 and all("Sort [__hash" in line for line in sorts)


def test_clean_pupils_are_shuffled_once_and_named_afterwards(spark):
    plan = plan_of(LazyLayers(spark, SF, "alunos")["alunos"])
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1
    # Names are joined above the shuffle, so they are not part of the rows it moves.
    assert plan.index("serie_nome") < plan.index("Exchange hashpartitioning") and "serie_nome" not in plan[plan.index("WindowGroupLimit") :].split("BroadcastExchange")[0]


def test_pupils_are_summed_by_hash_before_they_meet_results(spark):
    layers = LazyLayers(spark, SF, "int_alunos_resultado_municipio")
    assert "SortAggregate" not in plan_of(pupils_with_results(layers, F.current_timestamp()))


def test_a_suite_stages_tagged_rows_and_not_what_is_filtered_from_them(spark):
    layers = LazyLayers(spark, SF, both_sides=True)
    plan = plan_of(layers["alunos"])
    assert "tagged-alunos" in plan and "/alunos-" not in plan
