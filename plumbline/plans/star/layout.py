"""Tables on disk: rows and files that a filter on each cluster column meets; content of a table and its snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.content import content_summary, partition_differences, row_differences
from plumbline.operators.quality import union_all
from plumbline.plans.star.base import Query, table
from plumbline.session import fresh_path, stage
from plumbline.sources.buckets import attach_bucketed, match_bucketed, write_bucketed
from plumbline.sources.snapshots import read_snapshot, write_snapshot
from plumbline.sources.tables import Store

# Filters on the three cluster columns of line items, each of which meets a small share of the rows.
FILTERS = {"l_shipdate": ("1995-01-01", "1995-01-31"), "l_extendedprice": (20000.0, 21000.0), "l_quantity": (7.0, 7.0)}
# A task sorts one file's rows, so files hold few rows however large the table is.
FILES, ROWS_PER_FILE = 128, 100_000


def layout_files(rows: DataFrame) -> int:
    return max(FILES, -(-rows.count() // ROWS_PER_FILE))


def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Line items written and read back sorted by three columns, and with these interleaved.

    For a filter on each column: its rows in both layouts, and whether the interleaved one meets at most half of the
    files; the sorted one does for its first column only.
    """
    rows = table(spark, sf, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    store, files, out = Store(spark, fresh_path(spark, "layout"), "run"), layout_files(rows), []
    for name, interleave in (("sorted", False), ("interleaved", True)):
        store.replace(name, rows, cluster_by=list(FILTERS), interleave=interleave, files=files)
    for column, (low, high) in FILTERS.items():
        found = {n: store.read(n).where(F.col(column).between(low, high)).agg(F.count(F.lit(1)).alias(f"n_{n}")) for n in ("sorted", "interleaved")}
        half = {n: store.files_touched(n, column, low, high) <= files // 2 for n in found}
        counts = [F.lit(f.first()[0]).alias(f"n_{n}") for n, f in found.items()]
        flags = [F.lit(v).alias(f"{n}_skips_half") for n, v in half.items()]
        out.append(spark.range(1).select(F.lit(column).alias("filtered"), *counts, *flags))
    return union_all(out)


LAYOUT_SQL = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS filtered, count(*) AS n_sorted, count(*) AS n_interleaved, {'true' if i == 0 else 'false'} AS sorted_skips_half, true AS interleaved_skips_half
FROM lineitem WHERE {"strftime(l_shipdate, '%Y-%m-%d')" if c == "l_shipdate" else c} BETWEEN {f"'{low}' AND '{high}'" if isinstance(low, str) else f"{low} AND {high}"}"""
    for i, (c, (low, high)) in enumerate(FILTERS.items())
)


def content_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a snapshot of them in which one is changed, one missing and one doubled: years and rows that differ.

    The summaries are taken once and serve both levels.
    """
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    second = orders.where(F.col("o_orderkey") > first).agg(F.min("o_orderkey")).first()[0]
    key = F.col("o_orderkey")
    copied = orders.where(key != last).withColumn("o_totalprice", F.col("o_totalprice") + F.when(key == first, 1.0).otherwise(0.0))
    at, batch = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc), "batch_1"
    folder = fresh_path(spark, "content")
    write_snapshot(copied.unionAll(copied.where(key == second)), folder, "orders", at, batch, "orders")
    snapshot = read_snapshot(spark, folder, "orders", at.date(), batch).select(*orders.columns)
    sums = tuple(stage(content_summary(rows, ["year"]), "summary") for rows in (orders, snapshot))
    years = partition_differences(*sums, ["year"]).select(F.lit("year").alias("level"), F.col("year").cast("long").alias("name"), "n_left", "n_right", "status")
    rows = row_differences(orders, snapshot, ["o_orderkey"], sums, ["year"])
    return years.unionAll(rows.select(F.lit("row").alias("level"), key.alias("name"), "n_left", "n_right", "status"))


CONTENT_SQL = """
WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders),
odd AS (SELECT min(o_orderkey) AS changed, max(o_orderkey) AS missing, (SELECT min(o_orderkey) FROM o WHERE o_orderkey > (SELECT min(o_orderkey) FROM o)) AS doubled FROM o),
s AS (
  SELECT o.* REPLACE (CASE WHEN o_orderkey = changed THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM o, odd WHERE o_orderkey <> missing
  UNION ALL SELECT o.* FROM o, odd WHERE o_orderkey = doubled),
diff AS ((FROM o EXCEPT ALL FROM s) UNION ALL (FROM s EXCEPT ALL FROM o)),
l AS (SELECT y, count(*) AS n FROM o GROUP BY 1), r AS (SELECT y, count(*) AS n FROM s GROUP BY 1)
SELECT 'year' AS level, y::BIGINT AS name, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right,
  CASE WHEN y IN (SELECT y FROM diff) THEN 'DIFFERENT' ELSE 'SAME' END AS status
FROM l FULL JOIN r USING (y)
UNION ALL SELECT 'row', changed, 1, 1, 'CHANGED' FROM odd
UNION ALL SELECT 'row', missing, 1, 0, 'MISSING' FROM odd
UNION ALL SELECT 'row', doubled, 1, 2, 'REPEATED' FROM odd"""

BUCKETS = 16
SIDES = ("MATCH", "ONLY_ORDERED", "ONLY_SHIPPED")


def exchanges(df: DataFrame) -> int:
    """Steps of the plan that move rows between tasks."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def bucketed_products(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and shipped lines of each customer and year, with lines that came back, matched by their common buckets.

    Three tables are joined; ``moved`` says whether the plan moves any row between tasks after they are written.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"), F.year("o_orderdate").alias("ordered"), "o_totalprice")
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.year("l_shipdate").alias("year"), "l_quantity", "l_returnflag")
    ordered = orders.groupBy(F.col("ordered").alias("year"), "customer").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("value"))
    shipped = stage(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("year", "customer", "l_quantity", "l_returnflag"), "shipped")
    quantity = shipped.groupBy("year", "customer").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    returned = shipped.where("l_returnflag = 'R'").groupBy("year", "customer").agg(F.count(F.lit(1)).alias("n_returned"))
    folder, keys = fresh_path(spark, "buckets"), ["year", "customer"]
    run = folder.rpartition("-")[2]
    a, b, c = (
        write_bucketed(rows, f"{name}_{run}", f"{folder}/{name}", keys, BUCKETS)
        for name, rows in (("ordered", ordered), ("quantity", quantity), ("returned", returned))
    )
    shipments = attach_bucketed(b, c, {"n_returned": "n_returned"})
    values = {n: n for n in ("n_lines", "quantity", "n_returned")}
    matched = match_bucketed(a, shipments, {"n_orders": "n_orders", "value": "value"}, values, SIDES, "match_status")
    out = matched.withColumns({"value": F.round("value", 2), "n_returned": F.coalesce("n_returned", F.lit(0))})
    return out.withColumn("moved", F.lit(exchanges(out) > 0))


BUCKETED_SQL = """
WITH o AS (SELECT year(o_orderdate) AS year, o_custkey AS customer, count(*) AS n_orders, sum(o_totalprice) AS value FROM orders GROUP BY ALL),
l AS (SELECT year(l_shipdate) AS year, o_custkey AS customer, count(*) AS n_lines, sum(l_quantity) AS quantity,
        count(*) FILTER (l_returnflag = 'R') AS n_returned
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT coalesce(o.year, l.year) AS year, coalesce(o.customer, l.customer) AS customer, n_orders, round(value, 2) AS value, n_lines, quantity,
       coalesce(n_returned, 0) AS n_returned,
       CASE WHEN l.year IS NULL THEN 'ONLY_ORDERED' WHEN o.year IS NULL THEN 'ONLY_SHIPPED' ELSE 'MATCH' END AS match_status, false AS moved
FROM o FULL JOIN l ON o.year = l.year AND o.customer = l.customer"""

QUERIES: dict[str, Query] = {
    "clustered_layout": Query(clustered_layout, LAYOUT_SQL),
    "bucketed_products": Query(bucketed_products, BUCKETED_SQL),
    "content_reconciliation": Query(content_reconciliation, CONTENT_SQL),
}
