"""Check suites, histories, health, usage and profiling on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import observe, profile
from plumbline.operators.checks import Check, count_where, has_rows, repeated_keys, row_count, suite, surplus_ids
from plumbline.operators.quality import union_all
from plumbline.plans.star.base import Query, rounded, stamp, table
from plumbline.plans.star.indicators import G2_SQL, MATCHED_SQL, matched_documents, nation_kpi, nation_years_check
from plumbline.session import fresh_path, stage
from plumbline.sources.tables import append_if_absent

# --- check suite ------------------------------------------------------------------------------------------------


def check_suite(spark: SparkSession, sf: str) -> DataFrame:
    """One suite with every kind of check; two of them fail on purpose of the data (repeated lines, low prices)."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    matched = stage(matched_documents(spark, sf), "matched")
    kpi = stage(nation_kpi(spark, sf), "nation-kpi")
    contradicting = ((F.col("status") == "REACHED") & (F.col("gap") < 0)) | ((F.col("status") == "MISSED") & (F.col("gap") >= 0))
    checks = [
        Check("RECONCILIATION", "nation_years", [nation_years_check(spark, sf)], [row_count(kpi)]),
        Check("RECONCILIATION", "matched_documents", [row_count(table(spark, sf, "labels"))],
              [count_where(matched, F.col("match_status") != "ONLY_DOCUMENT")]),
        Check("UNIQUENESS", "orders", [0], [repeated_keys(orders, ["o_orderkey"])]),
        Check("UNIQUENESS", "lines", [0], [repeated_keys(lines, ["l_orderkey", "l_linenumber"])]),
        Check("UNIQUENESS", "order_surplus", [0], [surplus_ids(orders, "o_orderkey")]),
        Check("VALIDITY", "prices", [0], [count_where(orders, F.col("o_totalprice") < 2000),
                                          count_where(lines, F.col("l_extendedprice") < 1000)]),
        Check("CONSISTENCY", "nation_status", [0], [count_where(kpi, contradicting)]),
        Check("RECONCILIATION", "has_events", [1], [has_rows(table(spark, sf, "events"))]),
    ]
    return suite(spark, checks, F.lit("2026-07-12 01:11:34").cast("timestamp"), {"batch_id": F.lit("b1")}).drop("executed_at")


SUITE_SQL = f"""
WITH {G2_SQL}, {MATCHED_SQL}, c AS (
  SELECT 'RECONCILIATION' AS check_type, 'nation_years' AS object_name,
    (SELECT count(*) FROM (SELECT DISTINCT year(o_orderdate), c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey)) AS expected_value,
    (SELECT count(*) FROM g2_full) AS actual_value
  UNION ALL SELECT 'RECONCILIATION', 'matched_documents', (SELECT count(*) FROM labels), (SELECT count(*) FROM matched WHERE match_status <> 'ONLY_DOCUMENT')
  UNION ALL SELECT 'UNIQUENESS', 'orders', 0, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
  UNION ALL SELECT 'UNIQUENESS', 'lines', 0, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL SELECT 'UNIQUENESS', 'order_surplus', 0, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders)
  UNION ALL SELECT 'VALIDITY', 'prices', 0, (SELECT count(*) FROM orders WHERE o_totalprice < 2000) + (SELECT count(*) FROM lineitem WHERE l_extendedprice < 1000)
  UNION ALL SELECT 'CONSISTENCY', 'nation_status', 0, (SELECT count(*) FROM g2_full WHERE (status = 'REACHED' AND gap < 0) OR (status = 'MISSED' AND gap >= 0))
  UNION ALL SELECT 'RECONCILIATION', 'has_events', 1, (SELECT least(count(*), 1) FROM events))
SELECT *, CASE WHEN expected_value = actual_value THEN 'OK' ELSE 'FAIL' END AS status, 'b1' AS batch_id FROM c"""

# --- histories and health -----------------------------------------------------------------------------------------


def order_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Check rows made of the orders: per year (the run) and priority, all orders against those above 2,000."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("object_name"))
        .agg(
            F.count(F.lit(1)).alias("expected_value"),
            F.count_if(F.col("o_totalprice") >= 2000).alias("actual_value"),
            F.max("o_orderdate").cast("timestamp").alias("executed_at"),
        )
        .select(
            F.lit("VALIDITY").alias("check_type"), "object_name", "expected_value", "actual_value",
            F.when(F.col("expected_value") == F.col("actual_value"), "OK").otherwise("FAIL").alias("status"),
            F.concat(F.lit("batch_"), F.col("year")).alias("batch_id"), "executed_at",
        )
    )


CHECK_ROWS_SQL = """checks AS (
  SELECT *, CASE WHEN expected_value = actual_value THEN 'OK' ELSE 'FAIL' END AS status
  FROM (SELECT 'VALIDITY' AS check_type, o_orderpriority AS object_name, 'batch_' || year(o_orderdate) AS batch_id, count(*) AS expected_value,
          count(*) FILTER (o_totalprice >= 2000) AS actual_value, max(o_orderdate) AS executed_at FROM orders GROUP BY ALL))"""
RUN_KEYS = ["batch_id", "check_type", "object_name", "executed_at"]


def history_append(spark: SparkSession, sf: str) -> DataFrame:
    """The same check rows appended twice, then a later run of them: each row is in the history once per run."""
    path = fresh_path(spark, "history")
    rows = stage(order_checks(spark, sf), "checks")
    append_if_absent(spark, path, rows, RUN_KEYS, "executed_at")
    append_if_absent(spark, path, rows, RUN_KEYS, "executed_at")
    later = rows.withColumn("executed_at", F.col("executed_at") + F.expr("interval 1 day"))
    history = append_if_absent(spark, path, rows.unionByName(later), RUN_KEYS, "executed_at")
    return history.withColumn("executed_at", stamp("executed_at"))


HISTORY_SQL = f"""WITH {CHECK_ROWS_SQL}
SELECT check_type, object_name, expected_value, actual_value, status, batch_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS executed_at
FROM (SELECT *, executed_at AS moment FROM checks UNION ALL SELECT *, executed_at + INTERVAL 1 DAY FROM checks)"""


def _health(spark: SparkSession, sf: str) -> DataFrame:
    rows, at = stage(order_checks(spark, sf), "checks"), F.lit("2026-07-12 00:00:00").cast("timestamp")
    return observe.health_of(rows, "silver_batch", at, "batch_id").unionByName(observe.health_of(rows, "gold_batch", at))


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("executed_at", stamp("executed_at")).drop("collected_at")


HEALTH_SQL = f"""{CHECK_ROWS_SQL}, health AS (
  SELECT *, CASE WHEN checks_failed = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS pipeline_status
  FROM (SELECT 'silver_batch' AS pipeline_name, batch_id AS run_id, max(executed_at) AS executed_at, count(*) AS checks_total,
          count(*) FILTER (status = 'OK') AS checks_ok, count(*) FILTER (status <> 'OK') AS checks_failed FROM checks GROUP BY batch_id
        UNION ALL SELECT 'gold_batch', 'gold_' || strftime(max(executed_at), '%Y%m%dT%H%M%SZ'), max(executed_at), count(*),
          count(*) FILTER (status = 'OK'), count(*) FILTER (status <> 'OK') FROM checks))"""
HEALTH_COLUMNS = """pipeline_name, run_id, strftime(executed_at, '%Y-%m-%d %H:%M:%S') AS executed_at, checks_total, checks_ok,
  checks_failed, pipeline_status"""


def failure_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(order_checks(spark, sf), "checks")
    feed = observe.failure_feed(
        {"silver": (rows, F.col("batch_id")), "gold": (rows, observe.stamped_id("gold", "executed_at"))}
    )
    return feed.withColumn("executed_at", stamp("executed_at"))


FEED_COLUMNS = "check_type, object_name, expected_value, actual_value, status, strftime(executed_at, '%Y-%m-%d %H:%M:%S') AS executed_at"
FEED_SQL = f"""WITH {CHECK_ROWS_SQL}
SELECT 'silver' AS pipeline_layer, batch_id AS run_id, {FEED_COLUMNS} FROM checks WHERE status <> 'OK'
UNION ALL SELECT 'gold', 'gold_' || strftime(executed_at, '%Y%m%dT%H%M%SZ'), {FEED_COLUMNS} FROM checks WHERE status <> 'OK'"""

# --- usage --------------------------------------------------------------------------------------------------------


def job_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events read as a job log."""
    value, kind = F.col("value"), F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("creation_time"),
        F.concat(F.lit("user"), F.col("user_id") % 20).alias("user_email"),
        F.when(kind == "view", "SELECT").when(kind == "signup", "SCRIPT").when(kind == "error", "INSERT")
        .when(kind == "purchase", "MERGE").alias("statement_type"),
        F.when(value < 1, "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(value > 200, "RUNNING").otherwise("DONE").alias("state"),
        F.when((kind == "error") & (value > 50), "failed").alias("error_result"),
        F.floor(value * 1_000_000).alias("total_bytes_processed"),
        F.when(value >= 5, F.ceil(value) * 10_485_760).alias("total_bytes_billed"),
        F.when(value >= 2, F.floor(value * 100)).alias("total_slot_ms"),
        F.when(value < 40, value < 10).alias("cache_hit"),
    )


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2024-07-05 12:00:00").cast("timestamp")
    return observe.usage_daily(job_log(spark, sf), as_of, as_of).drop("collected_at")


def usage_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).withColumn("usage_date", F.col("usage_date").cast("string"))


def usage_summary(spark: SparkSession, sf: str) -> DataFrame:
    return observe.usage_summary(_daily(spark, sf)).withColumns(
        {c: F.col(c).cast("string") for c in ("first_usage_date", "last_usage_date")}
    )


def usage_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return observe.usage_by_day(_daily(spark, sf)).withColumn("usage_date", F.col("usage_date").cast("string"))


DAILY_SQL = """daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS usage_date, 'user' || (user_id % 20) AS user_email,
    CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'error' THEN 'INSERT' WHEN 'purchase' THEN 'MERGE' ELSE 'UNKNOWN' END AS statement_type,
    count(*) AS query_jobs, count(*) FILTER (event_type = 'error' AND value > 50) AS failed_jobs,
    sum(floor(value * 1000000))::BIGINT AS total_bytes_processed,
    coalesce(sum(ceil(value) * 10485760) FILTER (value >= 5), 0)::BIGINT AS total_bytes_billed,
    round(coalesce(sum(ceil(value) * 10485760) FILTER (value >= 5), 0) / 1099511627776.0, 8) AS total_tib_billed,
    coalesce(sum(floor(value * 100)) FILTER (value >= 2), 0)::BIGINT AS total_slot_ms, count(*) FILTER (value < 10) AS cache_hit_jobs
  FROM events WHERE ts >= TIMESTAMP '2024-01-07 12:00:00' AND value >= 1 AND value <= 200 AND event_type <> 'signup'
  GROUP BY 1, 2, 3)"""
USAGE_SUMS = """sum(query_jobs)::BIGINT AS query_jobs, sum(failed_jobs)::BIGINT AS failed_jobs,
  sum(total_bytes_processed)::BIGINT AS total_bytes_processed, sum(total_bytes_billed)::BIGINT AS total_bytes_billed,
  sum(total_slot_ms)::BIGINT AS total_slot_ms, sum(cache_hit_jobs)::BIGINT AS cache_hit_jobs,
  round(sum(total_bytes_billed) / 1099511627776.0, 8) AS total_tib_billed"""

# --- profiling ----------------------------------------------------------------------------------------------------

PROFILED = ["region", "nation", "customer", "supplier", "part", "orders"]


def profile_query(spark: SparkSession, sf: str) -> DataFrame:
    return union_all(
        profile.profile_columns(table(spark, sf, name), name, exact_distinct=True) for name in PROFILED
    )


PROFILED_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
}
PROFILE_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) AS distinct_count FROM {t}"
    for t, columns in PROFILED_COLUMNS.items()
    for c in columns.split()
)


def column_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """NULLs, smallest and largest value per column of the line items, in one pass."""
    numbers = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return profile.profile_columns(table(spark, sf, "lineitem").select(*numbers), "lineitem").drop("distinct_count")


RANGES_SQL = "\nUNION ALL ".join(
    f"SELECT 'lineitem' AS table_name, count(*) AS row_count, '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    f"min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value FROM lineitem"
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
)


def temporal_coverage(spark: SparkSession, sf: str) -> DataFrame:
    def years(name: str, column: str) -> tuple[DataFrame, str]:
        return table(spark, sf, name).select(F.year(column).alias("ano")), "ano"

    return profile.temporal_coverage(
        {"orders": years("orders", "o_orderdate"), "lineitem": years("lineitem", "l_shipdate"), "events": years("events", "ts")}
    )


COVERAGE_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabela, min(year({c})) AS primeiro_ano, max(year({c})) AS ultimo_ano, count(DISTINCT year({c})) AS quantidade_anos FROM {t}"
    for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
)
CATEGORIES = {
    "orders": "o_orderpriority", "lineitem": "l_linenumber", "customer": "c_mktsegment", "part": "p_size",
    "documents": "lang", "labels": "quality", "conversations": "role", "events": "event_type",
}


def category_freq(spark: SparkSession, sf: str) -> DataFrame:
    return profile.category_frequency({t: (table(spark, sf, t), c) for t, c in CATEGORIES.items()})


CATEGORY_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabela, {c}::VARCHAR AS rede, count(*) AS quantidade FROM {t} GROUP BY 2" for t, c in CATEGORIES.items()
)


def table_volume(spark: SparkSession, sf: str) -> DataFrame:
    names = [*CATEGORIES, "region", "nation", "supplier", "embeddings", "pages", "benchmark"]
    return profile.table_volume({t: table(spark, sf, t) for t in names})


VOLUME_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabela, count(*) AS quantidade_linhas FROM {t}"
    for t in [*CATEGORIES, "region", "nation", "supplier", "embeddings", "pages", "benchmark"]
)
SEARCHED = "(licen[sc]e|password|secret)"


def text_search(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and conversation turns whose row, as JSON, mentions one of the words."""
    documents = profile.search_rows(table(spark, sf, "documents"), SEARCHED, keep=["doc_id"])
    turns = profile.search_rows(table(spark, sf, "conversations"), SEARCHED, keep=["conv_id"])
    return union_all(
        df.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("hits")).withColumn("tabela", F.lit(name))
        for name, df, key in (("documents", documents, "doc_id"), ("conversations", turns, "conv_id"))
    )


SEARCH_SQL = f"""
SELECT doc_id AS id, count(*) AS hits, 'documents' AS tabela FROM documents
WHERE regexp_matches(lower(concat_ws(' ', doc_id, text, lang, source, n_chars)), '{SEARCHED}') GROUP BY 1
UNION ALL SELECT conv_id, count(*), 'conversations' FROM conversations
WHERE regexp_matches(lower(concat_ws(' ', conv_id, turn, role, text)), '{SEARCHED}') GROUP BY 1"""


def targets_preview(spark: SparkSession, sf: str) -> DataFrame:
    yearly = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"orders_{s.lower()}") for s in "FOP"],
        F.avg("o_totalprice").alias("mean_price"),
    )
    return profile.preview(rounded(yearly, 6, "mean_price"), ["year", "orders_f", "orders_o", "orders_p", "mean_price"], ["year"])


PREVIEW_SQL = """
SELECT year(o_orderdate) AS year, count(*) FILTER (o_orderstatus = 'F') AS orders_f, count(*) FILTER (o_orderstatus = 'O') AS orders_o,
  count(*) FILTER (o_orderstatus = 'P') AS orders_p, round(avg(o_totalprice), 6) AS mean_price FROM orders GROUP BY 1 ORDER BY 1"""

QUERIES: dict[str, Query] = {
    "check_suite": Query(check_suite, SUITE_SQL),
    "history_append": Query(history_append, HISTORY_SQL),
    "pipeline_health": Query(lambda spark, sf: _shown(_health(spark, sf)), f"WITH {HEALTH_SQL} SELECT {HEALTH_COLUMNS} FROM health"),
    "health_latest": Query(
        lambda spark, sf: _shown(observe.latest_health(_health(spark, sf))),
        f"""WITH {HEALTH_SQL} SELECT {HEALTH_COLUMNS} FROM health
        QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY health.executed_at DESC, run_id DESC) = 1""",
    ),
    "failure_feed": Query(failure_feed, FEED_SQL),
    "usage_daily": Query(usage_daily, f"WITH {DAILY_SQL} SELECT * FROM daily"),
    "usage_summary": Query(
        usage_summary,
        f"WITH {DAILY_SQL} SELECT min(usage_date) AS first_usage_date, max(usage_date) AS last_usage_date, {USAGE_SUMS} FROM daily",
    ),
    "usage_by_day": Query(
        usage_by_day,
        f"""WITH {DAILY_SQL} SELECT usage_date, {USAGE_SUMS}, round(sum(total_bytes_billed) / 1073741824.0, 4) AS total_gib_billed
        FROM daily GROUP BY usage_date""",
    ),
    "profile_columns": Query(profile_query, PROFILE_SQL),
    "column_ranges": Query(column_ranges, RANGES_SQL),
    "table_volume": Query(table_volume, VOLUME_SQL),
    "temporal_coverage": Query(temporal_coverage, COVERAGE_SQL),
    "category_freq": Query(category_freq, CATEGORY_SQL),
    "text_search": Query(text_search, SEARCH_SQL),
    "targets_preview": Query(targets_preview, PREVIEW_SQL),
}
