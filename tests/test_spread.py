"""Heavy work on compact inputs runs on all cores."""

from __future__ import annotations

from plumbline.plans.star.events import event_messages
from plumbline.session import spread


def test_messages_of_one_small_file_are_made_and_judged_by_all_cores(spark):
    sf = "/root/testdata/sf0.001"
    assert spark.read.parquet(f"{sf}/events.parquet").rdd.getNumPartitions() == 1
    messages = event_messages(spark, sf)
    assert messages.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert messages.count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_spreading_keeps_every_row_and_no_task_holds_most_of_them(spark):
    rows = spark.range(0, 4000, 1, 1)
    out = spread(rows, "id")
    sizes = out.rdd.glom().map(len).collect()
    assert sum(sizes) == 4000 and max(sizes) < 2000
    assert sorted(r.id for r in out.collect()) == list(range(4000))
