"""Row-level operators: snapshots, decoding, predicates, repeats, rules, quarantine, reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numeric import any_outside, outside, present_count, present_sum
from plumbline.functions.text import full_match, joined_key, strip
from plumbline.operators.checks import Check, row_count, suite
from plumbline.operators.decode import decode_columns, grouped_label
from plumbline.operators.dedup import latest_per_key, mark_repeats
from plumbline.operators.indicators import value_label
from plumbline.operators.quality import Rule, RuleBook, broken_ids, clean_rows, quarantine_rows
from plumbline.operators.reshape import wide_to_long
from plumbline.plans.star.base import Query, rounded, stamp, table, values
from plumbline.session import fresh_path, stage
from plumbline.sources.snapshots import batch_id_at, read_snapshot, snapshot_checks, write_snapshot

AT = dt.datetime(2026, 7, 12, 1, 11, 34)
NOW = "2026-07-12 01:11:34"


def _now():
    return F.lit(NOW).cast("timestamp")


# --- snapshots ------------------------------------------------------------------------------------------------


def _snapshot(spark: SparkSession, sf: str, name: str, lost: str = "false") -> DataFrame:
    base, batch = fresh_path(spark, "bronze"), batch_id_at(AT)
    write_snapshot(table(spark, sf, name).where(f"not ({lost})"), base, name, AT, batch, f"star.{name}")
    return read_snapshot(spark, base, name, AT.date(), batch)


def snapshot_lineage(spark: SparkSession, sf: str) -> DataFrame:
    snap = _snapshot(spark, sf, "orders")
    return snap.select(
        "o_orderkey", "o_totalprice", stamp("_ingestion_timestamp").alias("ingested"),
        F.col("_batch_id").alias("lineage_batch"), F.col("_source_table").alias("lineage_source"),
        F.col("ingestion_date").cast("string").alias("ingestion_date"), "batch_id",
    )


SNAPSHOT_SQL = """
SELECT o_orderkey, o_totalprice, '2026-07-12 01:11:34' AS ingested, 'batch_20260712T011134Z' AS lineage_batch,
       'star.orders' AS lineage_source, '2026-07-12' AS ingestion_date, 'batch_20260712T011134Z' AS batch_id
FROM orders"""


def snapshot_row_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Three tables against their snapshots, of which that of customers lost rows."""
    lost = {"orders": "false", "customer": "c_custkey % 50 = 7", "nation": "false"}
    pairs = {n: (table(spark, sf, n), _snapshot(spark, sf, n, rows)) for n, rows in lost.items()}
    return snapshot_checks(spark, pairs, _now()).drop("executed_at")


SNAPSHOT_RECONCILIATION_SQL = """
SELECT 'RECONCILIATION' AS check_type, name AS object_name, n AS expected_value, kept AS actual_value, CASE WHEN n = kept THEN 'OK' ELSE 'FAIL' END AS status
FROM (SELECT 'orders' AS name, count(*) AS n, count(o_orderkey) AS kept FROM orders
      UNION ALL SELECT 'customer', count(*), count(*) FILTER (c_custkey % 50 <> 7) FROM customer
      UNION ALL SELECT 'nation', count(*), count(n_nationkey) FROM nation)"""

# --- decoding and predicates --------------------------------------------------------------------------------


def code_table(spark: SparkSession, sf: str) -> DataFrame:
    """Nation and region names as a long code table; some codes of the facts have no region."""
    def rows(df: DataFrame, column: str, key: str, label: str) -> DataFrame:
        return df.select(
            F.lit("customer").alias("id_tabela"), F.lit(column).alias("nome_coluna"),
            F.col(key).cast("string").alias("chave"), F.col(label).alias("valor"),
        )

    nations = table(spark, sf, "nation")
    regions = table(spark, sf, "region")
    return rows(nations, "nation", "n_nationkey", "n_name").union(rows(regions, "region", "r_regionkey", "r_name"))


def dictionary_decode(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit("\t"), F.col("c_nationkey").cast("string"), F.lit(" \n"))
    facts = table(spark, sf, "customer").select(
        "c_custkey", strip(padded).alias("nation_code"), (F.col("c_nationkey") % 7).cast("string").alias("region_code")
    )
    decoded = decode_columns(
        facts, code_table(spark, sf), "customer",
        {"nation_name": ("nation_code", "nation"), "region_name": ("region_code", "region")},
    )
    undecoded = broken_ids(
        [Rule("NATION_UNKNOWN", F.col("nation_name").isNull()), Rule("REGION_UNKNOWN", F.col("region_name").isNull())]
    )
    return decoded.withColumn("undecoded", F.array_join(undecoded, ";"))


DECODE_SQL = """
SELECT c_custkey, c_nationkey::VARCHAR AS nation_code, (c_nationkey % 7)::VARCHAR AS region_code,
       n.n_name AS nation_name, r.r_name AS region_name,
       concat_ws(';', CASE WHEN n.n_name IS NULL THEN 'NATION_UNKNOWN' END,
                      CASE WHEN r.r_name IS NULL THEN 'REGION_UNKNOWN' END) AS undecoded
FROM customer LEFT JOIN nation n ON n.n_nationkey = c_nationkey
LEFT JOIN region r ON r.r_regionkey = c_nationkey % 7"""


def network_grouping(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        grouped_label("o_orderpriority", {"1-URGENT": "Top", "2-HIGH": "Top", "5-LOW": "Low"}, {"4-": "Open"}).alias(
            "priority_group"
        ),
        value_label(F.lower("o_orderstatus"), {"f": "Finished", "o": "Open"}, F.upper("o_orderstatus")).alias("status"),
    )


GROUPING_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Top' WHEN o_orderpriority = '5-LOW' THEN 'Low'
            WHEN starts_with(o_orderpriority, '4-') THEN 'Open' ELSE o_orderpriority END AS priority_group,
       CASE lower(o_orderstatus) WHEN 'f' THEN 'Finished' WHEN 'o' THEN 'Open' ELSE upper(o_orderstatus) END AS status
FROM orders"""


def predicates_regex(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        full_match("p_brand", r"Brand#\d").alias("one_digit_brand"),
        F.col("p_size").between(10, 20).alias("medium_size"),
        (~F.col("p_type").isin("SMALL", "LARGE")).alias("other_type"),
        F.col("p_name").startswith("red").alias("is_red"),
        outside("p_retailprice", 950, 1000).alias("price_out"),
    )


PREDICATES_SQL = """
SELECT p_partkey, regexp_full_match(p_brand, 'Brand#[0-9]') AS one_digit_brand, p_size BETWEEN 10 AND 20 AS medium_size,
       p_type NOT IN ('SMALL', 'LARGE') AS other_type, starts_with(p_name, 'red') AS is_red,
       p_retailprice < 950 OR p_retailprice > 1000 AS price_out
FROM part"""


def row_array_stats(spark: SparkSession, sf: str) -> DataFrame:
    measures = ["l_quantity", "discount", "tax"]
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )
    return rows.select(
        "l_orderkey", "l_linenumber", present_count(measures).alias("filled"),
        F.round(present_sum(measures), 4).alias("total"), any_outside(measures, 0.02, 40).alias("any_outside"),
    )


ARRAY_STATS_SQL = """
WITH m AS (SELECT l_orderkey, l_linenumber, [l_quantity, nullif(l_discount, 0), nullif(l_tax, 0)] AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, len(list_filter(v, lambda x: x IS NOT NULL))::BIGINT AS filled,
       round(list_sum(v), 4) AS total, len(list_filter(v, lambda x: x < 0.02 OR x > 40)) > 0 AS any_outside
FROM m"""

# --- repeats and latest rows ----------------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER_SQL = """l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
  l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
  l_linestatus NULLS FIRST"""


def marked_lines(spark: SparkSession, sf: str) -> DataFrame:
    return mark_repeats(table(spark, sf, "lineitem"), LINE_KEY, [F.desc("l_shipdate")])


def dedup_rank(spark: SparkSession, sf: str) -> DataFrame:
    return marked_lines(spark, sf).select(*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice", "is_repeat")


DEDUP_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) > 1 AS is_repeat
FROM lineitem"""


def latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest_per_key(table(spark, sf, "events"), ["user_id", "event_type"], ["ts"])
    return newest.select("user_id", "event_type", "event_id", "value", stamp("ts").alias("seen_at"))


LATEST_SQL = """
SELECT user_id, event_type, event_id, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen_at FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"""

# --- rules, split, quarantine ---------------------------------------------------------------------------------


def line_rules() -> RuleBook:
    return RuleBook(
        critical=(
            Rule("L001_QUANTITY_LOW", F.col("l_quantity") < 3),
            Rule("L002_PRICE_OUT_OF_RANGE", outside("l_extendedprice", 1000, 100000)),
            Rule("L003_REPEATED_LINE", F.col("is_repeat")),
        ),
        alert=(
            Rule("A001_NO_DISCOUNT", F.nullif("l_discount", F.lit(0.0)).isNull()),
            Rule("A002_HIGH_TAX", F.col("l_tax") > 0.06),
            Rule("A003_RETURNED_BUT_OPEN", (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")),
        ),
    )


def tagged_lines(spark: SparkSession, sf: str) -> DataFrame:
    lineage = {"ingestion_date": F.lit(AT.date()), "batch_id": F.lit(batch_id_at(AT))}
    return line_rules().tag(marked_lines(spark, sf).withColumns(lineage))


TAGGED_SQL = f"""
tagged AS (
  SELECT *, concat_ws(';', CASE WHEN l_quantity < 3 THEN 'L001_QUANTITY_LOW' END,
      CASE WHEN l_extendedprice < 1000 OR l_extendedprice > 100000 THEN 'L002_PRICE_OUT_OF_RANGE' END,
      CASE WHEN rn > 1 THEN 'L003_REPEATED_LINE' END) AS critical,
    concat_ws(';', CASE WHEN nullif(l_discount, 0) IS NULL THEN 'A001_NO_DISCOUNT' END,
      CASE WHEN l_tax > 0.06 THEN 'A002_HIGH_TAX' END,
      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'A003_RETURNED_BUT_OPEN' END) AS alerts
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn
        FROM lineitem))"""


def rule_tagging(spark: SparkSession, sf: str) -> DataFrame:
    return tagged_lines(spark, sf).select(
        *LINE_KEY, "l_partkey", F.array_join("critical_rules", ";").alias("critical"),
        F.array_join("alert_rules", ";").alias("alerts"),
    )


def clean_split(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rows(tagged_lines(spark, sf), ["is_repeat"]).select(
        *LINE_KEY, "l_partkey", "l_quantity", "quality_status", F.array_join("quality_alerts", ";").alias("alerts")
    )


CLEAN_SQL = f"""WITH {TAGGED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN alerts = '' THEN 'VALID' ELSE 'ALERT' END AS quality_status,
       alerts FROM tagged WHERE critical = ''"""


def _line_quarantine(tagged: DataFrame) -> DataFrame:
    key = joined_key(*[F.col(c).cast("string") for c in LINE_KEY])
    return quarantine_rows(tagged, "lineitem", key, _now(), ["is_repeat"])


def quarantined_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _line_quarantine(tagged_lines(spark, sf)).select(
        "source_table", F.col("ingestion_date").cast("string").alias("ingestion_date"), "batch_id", "record_key",
        "quality_severity", F.array_join("quality_rules", ";").alias("rules"), "quality_message",
    )


QUARANTINE_SQL = f"""WITH {TAGGED_SQL}
SELECT 'lineitem' AS source_table, '2026-07-12' AS ingestion_date, 'batch_20260712T011134Z' AS batch_id,
       l_orderkey || '|' || l_linenumber AS record_key, 'CRITICAL' AS quality_severity, critical AS rules,
       'Registro rejeitado pelas regras: ' || replace(critical, ';', '; ') AS quality_message
FROM tagged WHERE critical <> ''"""


def quarantine_payload_json(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected customers with their original fields as JSON; the text is read back to compare field by field."""
    customers = table(spark, sf, "customer").withColumns(
        {
            "ingestion_date": F.lit(AT.date()), "batch_id": F.lit(batch_id_at(AT)),
            "balance_band": F.when(F.col("c_acctbal") < -500, "deep"),
        }
    )
    book = RuleBook((Rule("C001_NEGATIVE_BALANCE", F.col("c_acctbal") < 0),))
    rejected = quarantine_rows(book.tag(customers), "customer", F.col("c_custkey").cast("string"), _now())
    fields = F.from_json(
        "payload_json", "c_custkey long, c_name string, c_acctbal double, c_mktsegment string, balance_band string"
    )
    return rejected.select(
        "record_key", fields.alias("p"), F.col("payload_json").contains('"balance_band":').alias("keeps_null_field")
    ).select("record_key", "p.*", "keeps_null_field")


PAYLOAD_SQL = """
SELECT c_custkey::VARCHAR AS record_key, c_custkey, c_name, c_acctbal, c_mktsegment,
       CASE WHEN c_acctbal < -500 THEN 'deep' END AS balance_band, TRUE AS keeps_null_field
FROM customer WHERE c_acctbal < 0"""


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Source rows = clean + quarantined rows, per suite row; the tagged rows are staged once for both sides."""
    tagged = stage(tagged_lines(spark, sf), "tagged")
    clean, rejected = clean_rows(tagged, ["is_repeat"]), _line_quarantine(tagged)
    orders = table(spark, sf, "orders")
    wide = {1: "a", 2: "b", 3: "c"}
    long = wide_to_long(
        orders.select("o_orderkey", *[F.col("o_totalprice").alias(c) for c in wide.values()]), wide, "k", "v"
    )
    checks = [
        Check("RECONCILIATION", "lineitem", [row_count(table(spark, sf, "lineitem"))], [row_count(clean), row_count(rejected)]),
        Check("RECONCILIATION", "orders_expanded", [row_count(orders, 3)], [row_count(long)]),
        Check("VALIDITY", "clean_is_smaller", [row_count(table(spark, sf, "lineitem"))], [row_count(clean)]),
    ]
    return suite(spark, checks, _now()).drop("executed_at")


RECONCILIATION_SQL = f"""WITH {TAGGED_SQL}, n AS (
  SELECT count(*) AS lines, count(*) FILTER (critical = '') AS clean FROM tagged)
SELECT 'RECONCILIATION' AS check_type, 'lineitem' AS object_name, lines AS expected_value, lines AS actual_value, 'OK' AS status FROM n
UNION ALL SELECT 'RECONCILIATION', 'orders_expanded', 3 * count(*), 3 * count(*), 'OK' FROM orders
UNION ALL SELECT 'VALIDITY', 'clean_is_smaller', lines, clean, CASE WHEN lines = clean THEN 'OK' ELSE 'FAIL' END FROM n"""

# --- reshaping --------------------------------------------------------------------------------------------------


def nation_year_wide(spark: SparkSession, sf: str, years: list[int]) -> DataFrame:
    """Revenue per nation with one column per year; partial sums per (customer, year) shuffle before the join."""
    orders = table(spark, sf, "orders")
    per_customer = orders.groupBy("o_custkey").agg(
        *[F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))).alias(f"revenue_{y}") for y in years]
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    joined = per_customer.join(customers, per_customer.o_custkey == customers.c_custkey)
    return joined.groupBy("c_nationkey").agg(*[F.sum(f"revenue_{y}").alias(f"revenue_{y}") for y in years])


def nation_years_long(spark: SparkSession, sf: str) -> DataFrame:
    years = values(table(spark, sf, "orders"), F.year("o_orderdate"))
    long = wide_to_long(nation_year_wide(spark, sf, years), {y: f"revenue_{y}" for y in years}, "year", "revenue")
    return rounded(long, 2, "revenue")


WIDE_TO_LONG_SQL = """
SELECT n AS c_nationkey, y::BIGINT AS year, round(sum(o_totalprice), 2) AS revenue
FROM (SELECT DISTINCT c_nationkey AS n FROM customer JOIN orders ON o_custkey = c_custkey) a
CROSS JOIN (SELECT DISTINCT year(o_orderdate) AS y FROM orders) b
LEFT JOIN (SELECT c_nationkey, year(o_orderdate) AS oy, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey) o
  ON o.c_nationkey = a.n AND o.oy = b.y
GROUP BY ALL"""

QUERIES: dict[str, Query] = {
    "snapshot_lineage": Query(snapshot_lineage, SNAPSHOT_SQL),
    "snapshot_row_reconciliation": Query(snapshot_row_reconciliation, SNAPSHOT_RECONCILIATION_SQL),
    "dictionary_decode": Query(dictionary_decode, DECODE_SQL),
    "network_grouping": Query(network_grouping, GROUPING_SQL),
    "predicates_regex": Query(predicates_regex, PREDICATES_SQL),
    "row_array_stats": Query(row_array_stats, ARRAY_STATS_SQL),
    "dedup_rank": Query(dedup_rank, DEDUP_SQL),
    "latest_per_key": Query(latest_event_per_user, LATEST_SQL),
    "rule_tagging": Query(rule_tagging, f"WITH {TAGGED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, critical, alerts FROM tagged"),
    "clean_split": Query(clean_split, CLEAN_SQL),
    "quarantine_rows": Query(quarantined_lines, QUARANTINE_SQL),
    "quarantine_payload_json": Query(quarantine_payload_json, PAYLOAD_SQL),
    "reconciliation": Query(reconciliation, RECONCILIATION_SQL),
    "wide_to_long": Query(nation_years_long, WIDE_TO_LONG_SQL),
}
