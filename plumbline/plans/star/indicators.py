"""Aggregates, reconciling joins and the indicator products on the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numeric import banded, exact_sum, mean_where, safe_percent, weighted_mean_where
from plumbline.operators.checks import repeated_keys, row_count
from plumbline.operators.dedup import latest_per_key
from plumbline.operators.indicators import (
    change_from_previous, next_period, rank_block, share_of_total, target_status, value_label,
)
from plumbline.operators.quality import union_all
from plumbline.operators.reconcile import match_outer
from plumbline.operators.reshape import wide_to_long
from plumbline.plans.star.base import Query, rounded, table, values
from plumbline.session import stage

STATUS = ("NO_RESULT", "NO_TARGET", "REACHED", "MISSED")
QUARTILES = {1: "Q1", 2: "Q2", 3: "Q3", 4: "Q4"}
STATUS_SQL = """CASE WHEN result IS NULL THEN 'NO_RESULT' WHEN target IS NULL THEN 'NO_TARGET'
     WHEN result - target >= 0 THEN 'REACHED' ELSE 'MISSED' END"""

# --- aggregates -----------------------------------------------------------------------------------------------


def microdata_agg(spark: SparkSession, sf: str) -> DataFrame:
    returned, rows = F.col("l_returnflag") == "R", F.count(F.lit(1))
    out = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), "l_linestatus").agg(
        rows.alias("lines"),
        F.count_if(returned).alias("returned"),
        safe_percent(F.count_if(returned), rows).alias("returned_pct"),
        mean_where(returned, "l_extendedprice").alias("mean_returned_price"),
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
        F.min("l_suppkey").alias("any_supplier"),
    )
    return rounded(out, 4, "returned_pct", "mean_returned_price")


MICRODATA_SQL = """
SELECT year(l_shipdate) AS year, l_linestatus, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned,
       round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*), 4) AS returned_pct,
       round(avg(l_extendedprice) FILTER (l_returnflag = 'R'), 4) AS mean_returned_price,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, min(l_suppkey) AS any_supplier
FROM lineitem GROUP BY ALL"""


def weighted_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Price weighted by discount per year; a missing price (quantity 1) still counts in the weights."""
    rows = table(spark, sf, "lineitem").withColumn("price", F.when(F.col("l_quantity") > 1, F.col("l_extendedprice")))
    out = rows.groupBy(F.year("l_shipdate").alias("year"), "l_returnflag").agg(
        weighted_mean_where(F.col("l_linestatus") == "O", "price", "l_discount").alias("weighted_price"),
        weighted_mean_where(F.col("l_quantity") > 1000, "price", "l_discount").alias("nothing"),
    )
    return rounded(out, 4, "weighted_price")


WEIGHTED_SQL = """
SELECT year(l_shipdate) AS year, l_returnflag,
       round(sum(CASE WHEN l_quantity > 1 THEN l_extendedprice * l_discount END) FILTER (l_linestatus = 'O')
             / nullif(sum(l_discount) FILTER (l_linestatus = 'O'), 0), 4) AS weighted_price,
       NULL::DOUBLE AS nothing
FROM lineitem GROUP BY ALL"""


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct("l_partkey").alias("parts"),
        (F.count(F.lit(1)) - F.countDistinct("l_orderkey")).alias("surplus"),
    )


DISTINCT_SQL = """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
       count(*) - count(DISTINCT l_orderkey) AS surplus FROM lineitem GROUP BY 1"""


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    # Orders whose discounts add up to something else than 0.25, with a tolerance.
    off = (
        lines.groupBy("l_orderkey").agg(F.sum("l_discount").alias("s")).filter(F.abs(F.col("s") - 0.25) > 0.0001)
    ).agg(F.count(F.lit(1)).alias("n"))
    return union_all(
        df.select(F.lit(name).alias("check_name"), "n")
        for name, df in (
            ("line_key", repeated_keys(lines, ["l_orderkey", "l_linenumber"]).frame()),
            ("order_key", repeated_keys(table(spark, sf, "orders"), ["o_orderkey"]).frame()),
            ("discount_sum", off),
        )
    )


DUPLICATE_SQL = """
SELECT 'line_key' AS check_name, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'order_key', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'discount_sum', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING abs(sum(l_discount) - 0.25) > 0.0001)"""


def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    years = [("orders", "o_orderdate"), ("lineitem", "l_shipdate")]
    frames = [table(spark, sf, t).select(F.year(c).alias("year")).distinct() for t, c in years]
    return reduce(lambda a, b: a.union(b), frames).distinct()


def ordered_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The 100 dearest orders: a top-k report, merged from each task's own top 100."""
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select(
        "o_orderkey", "o_totalprice"
    )


# --- reconciling joins ----------------------------------------------------------------------------------------


def matched_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return match_outer(
        documents, table(spark, sf, "labels"), ["doc_id"], {"lang": "lang", "source": "source"},
        {"quality": "quality", "toxic": "toxic"}, ("MATCH", "ONLY_DOCUMENT", "ONLY_LABEL"), status="match_status",
    )


MATCHED_SQL = """matched AS (
  SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, d.source, l.quality, l.toxic,
         CASE WHEN d.doc_id IS NULL THEN 'ONLY_LABEL' WHEN l.doc_id IS NULL THEN 'ONLY_DOCUMENT' ELSE 'MATCH' END AS match_status
  FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages against labels: each side has numbers that the other lacks."""
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("number"), "url")
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "number")
    sides = ("MATCH", "ONLY_PAGE", "ONLY_LABEL")
    return match_outer(pages, labels, ["number"], {"url": "url"}, {"quality": "quality", "toxic": "toxic"}, sides, status="match_status")


LABELLED_PAGES_SQL = """
SELECT coalesce(page_id, doc_id) AS number, url, quality, toxic,
       CASE WHEN page_id IS NULL THEN 'ONLY_LABEL' WHEN doc_id IS NULL THEN 'ONLY_PAGE' ELSE 'MATCH' END AS match_status
FROM pages FULL JOIN labels ON page_id = doc_id"""


def outer_match_residual(spark: SparkSession, sf: str) -> DataFrame:
    """Ordering customers against building customers: the segment test sits in the join, not before it."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return match_outer(
        orders.withColumnRenamed("o_custkey", "custkey"),
        table(spark, sf, "customer").withColumnRenamed("c_custkey", "custkey"),
        ["custkey"], {"n_orders": "n_orders"}, {"segment": "c_mktsegment"}, ("MATCH", "ONLY_ORDERS", "ONLY_CUSTOMER"),
        residual=lambda right: right("c_mktsegment") == "BUILDING", status="match_status",
    )


RESIDUAL_SQL = """
SELECT coalesce(o.k, c.c_custkey) AS custkey, o.n AS n_orders, c.c_mktsegment AS segment,
       CASE WHEN o.k IS NOT NULL AND c.c_custkey IS NOT NULL THEN 'MATCH' WHEN o.k IS NOT NULL THEN 'ONLY_ORDERS'
            ELSE 'ONLY_CUSTOMER' END AS match_status
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) o
FULL JOIN customer c ON o.k = c.c_custkey AND c.c_mktsegment = 'BUILDING'"""

# --- products -------------------------------------------------------------------------------------------------

# Targets are set from this year on.
FIRST_TARGET_YEAR = 1996


def status_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Mean order value per year and status against a long-form target of the same year, with change and bands."""
    orders = table(spark, sf, "orders")
    years = [y for y in values(orders, F.year("o_orderdate")) if y >= FIRST_TARGET_YEAR]
    wide = orders.groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(
        (F.avg("o_totalprice") / 5000).alias("result"),
        safe_percent(F.count_if(F.col("o_orderpriority") != "5-LOW"), F.count(F.lit(1))).alias("participation"),
        *[(F.min("o_totalprice") / 1000 + 48 + (y - 1995) * 0.5).alias(f"target_{y}") for y in years],
    )
    long = wide_to_long(wide, {y: f"target_{y}" for y in years}, "target_year", "target")
    results = long.select("year", "o_orderstatus", "result", "participation").distinct()
    same_year = latest_per_key(
        long.filter("target_year = year").select("year", "o_orderstatus", "target", "target_year"),
        ["year", "o_orderstatus"], ["target_year"],
    ).drop("target_year")
    joined = results.join(same_year, ["year", "o_orderstatus"], "left").withColumn("gap", F.col("result") - F.col("target"))
    changed = change_from_previous(joined, ["o_orderstatus"], "year", "result", "change")
    return changed.withColumns(
        {
            "status": target_status("result", "target", "gap", STATUS),
            "band": banded("participation", [(79, "LOW"), (81, "MID")], "HIGH", "NONE"),
        }
    )


KPI_NUMBERS = ["result", "target", "gap", "change"]


def g1_kpi_yoy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(status_kpi(spark, sf), 6, *KPI_NUMBERS, "participation")


G1_SQL = f"""g1 AS (
  SELECT year, o_orderstatus, result, target, result - target AS gap,
         result - lag(result) OVER (PARTITION BY o_orderstatus ORDER BY year) AS change, participation,
         {STATUS_SQL} AS status,
         CASE WHEN participation < 79 THEN 'LOW' WHEN participation < 81 THEN 'MID' ELSE 'HIGH' END AS band
  FROM (SELECT *, CASE WHEN year >= 1996 THEN lowest / 1000 + 48 + (year - 1995) * 0.5 END AS target
        FROM (SELECT year(o_orderdate) AS year, o_orderstatus, avg(o_totalprice) / 5000 AS result, min(o_totalprice) AS lowest,
                     100.0 * count(*) FILTER (o_orderpriority <> '5-LOW') / count(*) AS participation
              FROM orders GROUP BY ALL)))"""


def nation_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per nation and year: change, share of the year's total, rank, percent rank and quartile."""
    orders = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        exact_sum("o_totalprice").alias("revenue")
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("year", "c_nationkey")
        .agg(exact_sum("revenue").alias("revenue"))
    )
    # A constant condition on the right side: only the finished-orders row of each year is compared with.
    finished = (
        table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").groupBy(F.year("o_orderdate").alias("year"))
        .agg((F.sum("o_totalprice") / 10).alias("target"))
    )
    base = (
        change_from_previous(per_nation, ["c_nationkey"], "year", "revenue", "change")
        .join(finished, ["year"], "left")
        .withColumn("gap", F.col("revenue") - F.col("target"))
    )
    base = stage(base, "nation-base")
    ranked = rank_block(base, ["year"], "revenue", ["c_nationkey"], "position", "percentile", "quartile")
    return ranked.withColumns(
        {
            "band": value_label("quartile", QUARTILES, "NONE"),
            "status": target_status("revenue", "target", "gap", STATUS),
        }
    )


def nation_years_check(spark: SparkSession, sf: str) -> DataFrame:
    """How many (year, nation) pairs the orders hold: the grain the product has to reproduce."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey").distinct()
    pairs = years.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("year", "c_nationkey").distinct()
    return row_count(pairs)


def g2_rank_quartile(spark: SparkSession, sf: str) -> DataFrame:
    out = rounded(nation_kpi(spark, sf), 3, "revenue", "change", "target", "gap")
    return rounded(out, 8, "percentile")


G2_SQL = """g2_base AS (
  SELECT r.year, c_nationkey, revenue, revenue - lag(revenue) OVER (PARTITION BY c_nationkey ORDER BY r.year) AS change, f.target
  FROM (SELECT year(o_orderdate) AS year, c_nationkey, sum(o_totalprice) AS revenue
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) r
  LEFT JOIN (SELECT year(o_orderdate) AS year, sum(o_totalprice) / 10 AS target FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f
    ON f.year = r.year),
g2 AS (
  SELECT year, c_nationkey, revenue, change, target, revenue - target AS gap,
         rank() OVER (PARTITION BY year ORDER BY revenue DESC) AS position,
         percent_rank() OVER (PARTITION BY year ORDER BY revenue) AS percentile,
         ntile(4) OVER (PARTITION BY year ORDER BY revenue DESC, c_nationkey) AS quartile
  FROM g2_base),
g2_full AS (SELECT *, 'Q' || quartile AS band, CASE WHEN target IS NULL THEN 'NO_TARGET' WHEN gap >= 0 THEN 'REACHED' ELSE 'MISSED' END AS status FROM g2)"""


def customer_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: customer indicators per year from orders, line items and segment targets.

    Line items are summed per order before they meet the orders (their own key), orders per (customer, year)
    after; the ranking of a year is exact and never needs the whole year in one task. Results are exact sums, so customers
    of equal orders share a position in whatever order their orders are read.
    """
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.sum("l_extendedprice").alias("priced"),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year"), "o_totalprice"
    )
    per_year = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left").groupBy("year", "custkey").agg(
        exact_sum("o_totalprice").alias("result"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("lines").alias("lines"),
        safe_percent(F.sum("returned"), F.sum("lines")).alias("returned_pct"),
        F.sum("priced").alias("priced"),
    )
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    base = per_year.join(customers, ["custkey"], "left")
    base = stage(change_from_previous(base, ["custkey"], "year", "result", "change"), "customer-base")
    # Segment means of even years, deflated by three percent, serve as targets; odd years have none.
    targets = base.filter(F.col("year") % 2 == 0).groupBy("year", "segment").agg((F.avg("result") / 1.03).alias("target"))
    ranked = rank_block(base, ["year"], "result", ["custkey"], "position", "percentile", "quartile")
    out = ranked.join(targets, ["year", "segment"], "left").withColumn(
        "gap_pct", safe_percent(F.col("result") - F.col("target"), "target")
    )
    return out.withColumns(
        {
            "band": value_label("quartile", QUARTILES, "NONE"),
            "status": target_status("result", "target", "gap_pct", STATUS),
            "gap_band": banded("gap_pct", [(-50, "FAR_BELOW"), (-10, "BELOW"), (0, "NEAR")], "ABOVE", "NONE"),
        }
    )


CUSTOMER_NUMBERS = ["result", "returned_pct", "priced", "change", "gap_pct"]


def g3_entity_kpi(spark: SparkSession, sf: str) -> DataFrame:
    out = rounded(customer_kpi(spark, sf), 4, *CUSTOMER_NUMBERS)
    return rounded(rounded(out, 6, "target"), 8, "percentile")


G3_SQL = """g3_base AS (
  SELECT year(o_orderdate) AS year, o_custkey AS custkey, c_mktsegment AS segment, sum(o_totalprice) AS result, count(*) AS orders,
         sum(lines)::BIGINT AS lines, 100.0 * sum(returned) / nullif(sum(lines), 0) AS returned_pct,
         sum(priced) AS priced
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned,
           sum(l_extendedprice) AS priced FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
g3_ranked AS (
  SELECT *, result - lag(result) OVER (PARTITION BY custkey ORDER BY year) AS change,
         CASE WHEN year % 2 = 0 THEN avg(result) OVER (PARTITION BY year, segment) / 1.03 END AS target,
         rank() OVER (PARTITION BY year ORDER BY result DESC) AS position,
         percent_rank() OVER (PARTITION BY year ORDER BY result) AS percentile,
         ntile(4) OVER (PARTITION BY year ORDER BY result DESC, custkey) AS quartile
  FROM g3_base),
g3 AS (
  SELECT *, 'Q' || quartile AS band, CASE WHEN target IS NULL THEN 'NO_TARGET' WHEN gap_pct >= 0 THEN 'REACHED' ELSE 'MISSED' END AS status,
         CASE WHEN gap_pct IS NULL THEN 'NONE' WHEN gap_pct < -50 THEN 'FAR_BELOW' WHEN gap_pct < -10 THEN 'BELOW'
              WHEN gap_pct < 0 THEN 'NEAR' ELSE 'ABOVE' END AS gap_band
  FROM (SELECT *, 100.0 * (result - target) / target AS gap_pct FROM g3_ranked))"""
G3_COLUMNS_SQL = """year, custkey, segment, round(result, 4) AS result, orders, lines, round(returned_pct, 4) AS returned_pct,
  round(priced, 4) AS priced, round(change, 4) AS change, round(target, 6) AS target, round(gap_pct, 4) AS gap_pct,
  position, round(percentile, 8) AS percentile, quartile, band, status, gap_band"""


def g4_coverage_share(spark: SparkSession, sf: str) -> DataFrame:
    counted = union_all(
        df.groupBy("category", "match_status").agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit(level))
        for level, df in (
            ("DOCUMENT", matched_documents(spark, sf).withColumn("category", F.coalesce("lang", F.lit("unknown")))),
            ("CUSTOMER", outer_match_residual(spark, sf).withColumn("category", F.coalesce("segment", F.lit("unknown")))),
        )
    )
    return rounded(share_of_total(counted, ["level", "category"], "n", "share"), 6, "share")


G4_SQL = f"""WITH {MATCHED_SQL}, residual AS ({RESIDUAL_SQL}), counted AS (
  SELECT 'DOCUMENT' AS level, coalesce(lang, 'unknown') AS category, match_status, count(*) AS n FROM matched GROUP BY ALL
  UNION ALL SELECT 'CUSTOMER', coalesce(segment, 'unknown'), match_status, count(*) FROM residual GROUP BY ALL)
SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY level, category), 6) AS share FROM counted"""


def g5_level_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Share of quantity bands per region and year as long rows; an empty band is NULL and says so."""
    band = F.floor(F.col("l_quantity") / 10)
    found = values(table(spark, sf, "lineitem"), band)
    bands = {b: f"band_{b}" for b in range(min(found, default=0), max(found, default=-1) + 1)}
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(band == b).alias(c) for b, c in bands.items()],
    )
    places = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "n_regionkey")
    wide = lines.join(places, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("year", "n_regionkey").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in bands.values()]
    )
    shares = wide.select(
        "year", "n_regionkey", *[safe_percent(F.nullif(c, F.lit(0)), F.col("n")).alias(c) for c in bands.values()]
    )
    long = wide_to_long(shares, bands, "level", "share")
    return rounded(long.withColumn("available", F.col("share").isNotNull()), 6, "share")


G5_SQL = """
WITH l AS (SELECT year(l_shipdate) AS year, n_regionkey, floor(l_quantity / 10)::BIGINT AS band FROM lineitem
           JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
cells AS (SELECT year, n_regionkey, unnest(range((SELECT min(band) FROM l), (SELECT max(band) + 1 FROM l))) AS level, count(*) AS n FROM l GROUP BY year, n_regionkey)
SELECT c.year, c.n_regionkey, c.level, round(100.0 * nullif(coalesce(b.k, 0), 0) / c.n, 6) AS share,
       coalesce(b.k, 0) > 0 AS available
FROM cells c LEFT JOIN (SELECT year, n_regionkey, band, count(*) AS k FROM l GROUP BY ALL) b
  ON b.year = c.year AND b.n_regionkey = c.n_regionkey AND b.band = c.level"""


def _summary(kpi: DataFrame, result: str, prefix: str) -> DataFrame:
    return kpi.groupBy("year").agg(
        F.count(result).alias(f"{prefix}_with_result"),
        F.count_if(F.col("target").isNotNull() & F.col(result).isNotNull()).alias(f"{prefix}_comparable"),
        F.count_if(F.col("status") == STATUS[2]).alias(f"{prefix}_reached"),
        F.avg(result).alias(f"{prefix}_mean"),
        F.min(result).alias(f"{prefix}_min"),
        F.max(result).alias(f"{prefix}_max"),
    )


def exec_summary(spark: SparkSession, sf: str) -> DataFrame:
    status, nations = stage(status_kpi(spark, sf), "status-kpi"), stage(nation_kpi(spark, sf), "nation-kpi")
    customers = stage(customer_kpi(spark, sf), "customer-kpi")
    years = reduce(lambda a, b: a.union(b), (df.select("year") for df in (status, nations, customers))).distinct()
    national = status.filter(F.col("o_orderstatus") == "F").groupBy("year").agg(
        F.min("result").alias("result"), F.min("target").alias("target"), F.min("gap").alias("gap")
    )
    out = years.join(national, ["year"], "left")
    for side in (_summary(nations, "revenue", "nations"), _summary(customers, "result", "customers")):
        out = out.join(side, ["year"], "left")
    reached: list[Column] = [
        safe_percent(f"{p}_reached", f"{p}_comparable").alias(f"{p}_reached_pct") for p in ("nations", "customers")
    ]
    return out.select("*", *reached)


SUMMARY_NUMBERS = ["result", "target", "gap"] + [
    f"{p}_{m}" for p in ("nations", "customers") for m in ("mean", "min", "max", "reached_pct")
]


def g6_exec_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(exec_summary(spark, sf), 6, *SUMMARY_NUMBERS)


def _summary_sql(name: str, result: str, prefix: str) -> str:
    return f"""(SELECT year, count({result}) AS {prefix}_with_result,
      count(*) FILTER (target IS NOT NULL AND {result} IS NOT NULL) AS {prefix}_comparable,
      count(*) FILTER (status = 'REACHED') AS {prefix}_reached, avg({result}) AS {prefix}_mean, min({result}) AS {prefix}_min,
      max({result}) AS {prefix}_max FROM {name} GROUP BY year)"""


def _g6_sql(digits: int) -> str:
    return f"""WITH {G1_SQL}, {G2_SQL}, {G3_SQL}, years AS (
  SELECT year FROM g1 UNION SELECT year FROM g2 UNION SELECT year FROM g3)
SELECT year, round(n.result, {digits}) AS result, round(n.target, {digits}) AS target, round(n.gap, {digits}) AS gap,
  nations_with_result, nations_comparable, nations_reached, round(nations_mean, {digits}) AS nations_mean,
  round(nations_min, {digits}) AS nations_min, round(nations_max, {digits}) AS nations_max,
  round(100.0 * nations_reached / nullif(nations_comparable, 0), {digits}) AS nations_reached_pct,
  customers_with_result, customers_comparable, customers_reached, round(customers_mean, {digits}) AS customers_mean,
  round(customers_min, {digits}) AS customers_min, round(customers_max, {digits}) AS customers_max,
  round(100.0 * customers_reached / nullif(customers_comparable, 0), {digits}) AS customers_reached_pct
FROM years LEFT JOIN (SELECT year, min(result) AS result, min(target) AS target, min(gap) AS gap FROM g1
                      WHERE o_orderstatus = 'F' GROUP BY year) n USING (year)
LEFT JOIN {_summary_sql("g2_full", "revenue", "nations")} USING (year)
LEFT JOIN {_summary_sql("g3", "result", "customers")} USING (year)"""


def g7_lead_features(spark: SparkSession, sf: str) -> DataFrame:
    kpi = customer_kpi(spark, sf).select("year", "custkey", "result", "change", "status", "returned_pct")
    ahead = next_period(
        kpi, ["custkey"], "year", {"target_year": "year", "target_result": "result", "target_status": "status"}
    )
    follows = (F.col("target_year") == F.col("year") + 1) & F.col("target_result").isNotNull()
    return rounded(ahead.withColumn("has_next_year", follows), 4, "result", "change", "returned_pct", "target_result")


G7_SQL = f"""WITH {G3_SQL}, led AS (
  SELECT year, custkey, result, change, status, returned_pct, lead(year) OVER w AS target_year,
         lead(result) OVER w AS target_result, lead(status) OVER w AS target_status
  FROM g3 WINDOW w AS (PARTITION BY custkey ORDER BY year))
SELECT year, custkey, round(result, 4) AS result, round(change, 4) AS change, status, round(returned_pct, 4) AS returned_pct,
       target_year, round(target_result, 4) AS target_result, target_status,
       coalesce(target_year = year + 1, FALSE) AS has_next_year
FROM led"""


def dashboard_round(spark: SparkSession, sf: str) -> DataFrame:
    """The summary as shown: two decimals, and the status from the exact gap."""
    exact = exec_summary(spark, sf)
    shown = exact.withColumn("status", F.when(F.col("target").isNull(), STATUS[1]).when(F.col("gap") >= 0, STATUS[2]).otherwise(STATUS[3]))
    return rounded(shown, 2, *SUMMARY_NUMBERS)


QUERIES: dict[str, Query] = {
    "microdata_agg": Query(microdata_agg, MICRODATA_SQL),
    "weighted_mean": Query(weighted_mean, WEIGHTED_SQL),
    "distinct_counts": Query(distinct_counts, DISTINCT_SQL),
    "duplicate_keys": Query(duplicate_keys, DUPLICATE_SQL),
    "union_distinct": Query(
        union_distinct, "SELECT year(o_orderdate) AS year FROM orders UNION SELECT year(l_shipdate) FROM lineitem"
    ),
    "ordered_limit": Query(
        ordered_limit, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"
    ),
    "outer_match_both_sides": Query(labelled_pages, LABELLED_PAGES_SQL),
    "outer_match": Query(matched_documents, f"WITH {MATCHED_SQL} SELECT * FROM matched"),
    "outer_match_residual": Query(outer_match_residual, RESIDUAL_SQL),
    "g1_kpi_yoy": Query(
        g1_kpi_yoy,
        f"""WITH {G1_SQL} SELECT year, o_orderstatus, round(result, 6) AS result, round(target, 6) AS target, round(gap, 6) AS gap,
        round(change, 6) AS change, round(participation, 6) AS participation, status, band FROM g1""",
    ),
    "g2_rank_quartile": Query(
        g2_rank_quartile,
        f"""WITH {G2_SQL} SELECT year, c_nationkey, round(revenue, 3) AS revenue, round(change, 3) AS change, round(target, 3) AS target,
        round(gap, 3) AS gap, position, round(percentile, 8) AS percentile, quartile, band, status FROM g2_full""",
    ),
    "g3_entity_kpi": Query(g3_entity_kpi, f"WITH {G3_SQL} SELECT {G3_COLUMNS_SQL} FROM g3"),
    "g4_coverage_share": Query(g4_coverage_share, G4_SQL),
    "g5_level_distribution": Query(g5_level_distribution, G5_SQL),
    "g6_exec_summary": Query(g6_exec_summary, _g6_sql(6)),
    "g7_lead_features": Query(g7_lead_features, G7_SQL),
    "dashboard_round": Query(
        dashboard_round,
        _g6_sql(2).replace("SELECT year, round(n.result", "SELECT year, CASE WHEN n.target IS NULL THEN 'NO_TARGET' "
                           "WHEN n.gap >= 0 THEN 'REACHED' ELSE 'MISSED' END AS status, round(n.result"),
    ),
}
