"""Connected components of a link table, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round over links (hi, lo) with lo < hi.

    Large: every node hands its greater neighbours to its smallest one. Small: every node hands its smaller
    neighbours and itself to the smallest of them. The minimum is aggregated before the shuffle, so a node with very
    many neighbours costs one row per task there; in the join back its rows are split by adaptive execution.
    """
    if large:
        ends = links.select(F.col("hi").alias("node"), F.col("lo").alias("near")).unionAll(links.select(F.col("lo").alias("node"), F.col("hi").alias("near")))
    else:
        ends = links.select(F.col("hi").alias("node"), F.col("lo").alias("near"))
    least = ends.groupBy(F.col("node").alias("of")).agg(F.least(F.min("near"), F.first("node")).alias("least"))
    joined = ends.join(least, F.col("node") == F.col("of"))
    if large:
        return joined.where("near > node").select(F.col("near").alias("hi"), F.col("least").alias("lo"))
    moved = joined.where("near > least").select(F.col("near").alias("hi"), F.col("least").alias("lo"))
    return moved.unionAll(joined.select(F.col("node").alias("hi"), F.col("least").alias("lo")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots: root is the smallest node it reaches.

    The number of rounds grows with the logarithm of the longest path. Each round is written to the shared folder,
    which cuts the lineage. Self-links and repeated links are ignored; no links give no rows.
    """
    now = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links"
    )
    mark = None
    while True:
        after = stage(_star(_star(now, True), False).distinct(), "links")
        seen = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            return after.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        mark, now = seen, after
