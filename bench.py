"""Time the registered headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumbline.plans.star import all_queries  # noqa: E402
from plumbline.session import build_session  # noqa: E402

HEADLINE = [
    "g3_entity_kpi", "g2_rank_quartile", "g6_exec_summary", "g7_lead_features", "g1_kpi_yoy", "g4_coverage_share",
    "g5_level_distribution", "dictionary_decode", "dedup_rank", "latest_per_key", "rule_tagging", "clean_split",
    "quarantine_rows", "reconciliation", "microdata_agg", "wide_to_long", "outer_match", "distinct_counts",
    "check_suite", "history_append", "event_contract_errors", "event_routing_counts", "event_summary",
    "event_latency_p95", "threshold_alert", "streaming_end_to_end", "usage_daily", "profile_columns", "text_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "plumbline-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    names = chosen.split(",") if chosen else [n for n in HEADLINE if n in registered]
    # One untimed scan starts the JVM's Parquet and code-generation paths.
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().collect()
    # A dry run of the first query pays for what is compiled once.
    for name in names[:1]:
        registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
