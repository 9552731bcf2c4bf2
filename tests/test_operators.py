from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.numeric import banded, exact_sum, safe_percent
from plumbline.functions.text import full_match, row_json, sorted_map_json, spaced_json, strip
from plumbline.operators import observe, profile
from plumbline.operators.checks import Check, CheckFailure, gate, has_rows, repeated_keys, row_count, suite, surplus_rows
from plumbline.operators.decode import decode_columns
from plumbline.operators.dedup import drop_repeats, latest_per_key, mark_repeats
from plumbline.operators.indicators import next_period, rank_block, share_of_total
from plumbline.operators.quality import Rule, RuleBook
from plumbline.operators.reconcile import match_outer
from plumbline.operators.reshape import wide_to_long
from plumbline.sources.tables import append_if_absent, empty_like
from plumbline.streaming.alerts import AlertPolicy, sustained_breaches


def test_strip_takes_all_unicode_space(spark):
    values = ["\t a b ", " x\n", "", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r[0] for r in df.select(strip("s")).collect()] == ["a b", "x", "", None]


def test_full_match_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("1234567",), ("1234567\n",), ("123456",)], "s string")
    assert [r[0] for r in df.select(full_match("s", r"\d{7}")).collect()] == [True, False, False]


def test_json_text_matches_python(spark):
    value = {"b": "x, y: \"z\"", "a": [1, 2, {"k": "v,w"}], "c": None, "é": "\\"}
    compact = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    df = spark.createDataFrame([(compact, {"z": "1,2", "a": "ção\n"})], "s string, m map<string,string>")
    row = df.select(spaced_json(F.col("s")), sorted_map_json("m"), row_json("s")).first()
    assert row[0] == json.dumps(value, ensure_ascii=False, sort_keys=True)
    assert row[1] == json.dumps({"z": "1,2", "a": "ção\n"}, ensure_ascii=False, sort_keys=True)


def test_rule_ids_keep_declared_order_and_ignore_null(spark):
    df = spark.createDataFrame([(1, 1), (None, 9), (5, 9)], "a int, b int")
    book = RuleBook((Rule("Z", F.col("a") > 3), Rule("A", F.col("b") > 3)))
    assert [r.critical_rules for r in book.tag(df).collect()] == [[], ["A"], ["Z", "A"]]
    with pytest.raises(ValueError):
        Rule("a,b", F.lit(True))


@pytest.mark.parametrize("how", [dict(spread=1), dict(spread=3), dict(spread=64), {}])
def test_repeats_with_a_hot_key_and_exact_copies(spark, how):
    rng = random.Random(4)
    rows = [(1, 5, "same")] * 400 + [(1, rng.randint(0, 3), "x") for _ in range(200)]
    rows += [(k, rng.randint(0, 9), str(rng.randint(0, 2))) for k in range(2, 200) for _ in range(rng.randint(1, 3))]
    rows += [(None, i, "n") for i in range(5)]
    df = spark.createDataFrame(rows, "k int, t int, v string").repartition(16)
    out = mark_repeats(df, ["k"], [F.desc("t")], **how).collect()
    assert len(out) == len(rows)
    best = {}
    for k, t, v in rows:
        if k not in best or (-t, v) < best[k]:
            best[k] = (-t, v)
    firsts = [(r.k, (-r.t, r.v)) for r in out if not r.is_repeat]
    assert len(firsts) == len(best) and dict(firsts) == best
    assert drop_repeats(df, ["k"], [F.desc("t")]).count() == len(best)


def test_latest_per_key_null_is_oldest(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("b", None, 3), (None, 1, 4)], "k string, t int, v int")
    assert {(r.k, r.v) for r in latest_per_key(df, ["k"], ["t"]).collect()} == {("a", 2), ("b", 3), (None, 4)}


def brute_ranks(rows, tiles=4):
    out = {}
    for g in {r[0] for r in rows}:
        members = sorted(((v, k) for gg, k, v in rows if gg == g and v is not None), key=lambda x: (-x[0], x[1]))
        n = len(members)
        for pos, (v, k) in enumerate(members):
            rank = 1 + sum(1 for w, _ in members if w > v)
            below = sum(1 for w, _ in members if w < v)
            size, extra = divmod(n, tiles)
            tile = pos // (size + 1) + 1 if pos < (size + 1) * extra else extra + (pos - (size + 1) * extra) // max(size, 1) + 1
            out[(g, k)] = (rank, below / (n - 1) if n > 1 else 0.0, tile)
    return out


def test_rank_block_agrees_with_brute_force_and_keeps_every_row(spark):
    rng = random.Random(7)
    rows = [(2023, i, 50.0 if i % 3 else float(rng.randint(0, 40))) for i in range(600)]
    rows += [(2024, i, float(rng.randint(0, 5))) for i in range(43)] + [(2025, 1, 7.0), (2026, 1, None), (2026, 2, 1.0), (2026, 3, 1.0)]
    rows += [(None, i, float(i % 7)) for i in range(50)] + [(None, 50, None)]
    df = spark.createDataFrame(rows, "y int, k int, v double").repartition(5).withColumn("extra", F.col("k") * 2)
    out = rank_block(df, ["y"], "v", ["k"])
    assert out.columns == [*df.columns, "rank", "percent_rank", "tile"]
    got = {(r.y, r.k): (r["rank"], r["percent_rank"], r["tile"]) for r in out.collect()}
    want = brute_ranks(rows)
    assert got.keys() == {(y, k) for y, k, _ in rows}
    assert all(got[y, k] == (None, None, None) for y, k, v in rows if v is None)
    for key, (rank, percent, tile) in want.items():
        assert got[key][0] == rank and got[key][2] == tile and abs(got[key][1] - percent) < 1e-12, key


def test_rank_block_takes_nan_and_signed_zeros_as_window_functions_do(spark):
    from pyspark.sql import Window

    values = [float("nan"), float("nan"), 0.0, -0.0, 1.0, -1.0, float("inf"), 0.0, None]
    df = spark.createDataFrame([(g, i, v) for g in ("a", None) for i, v in enumerate(values)], "g string, k int, v double")
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    want = {(r.g, r.k): (r["r"], r["p"]) for r in df.filter("v is not null").withColumn("r", F.rank().over(w))
            .withColumn("p", F.percent_rank().over(Window.partitionBy("g").orderBy("v"))).collect()}
    got = {(r.g, r.k): (r["rank"], r["percent_rank"]) for r in rank_block(df, ["g"], "v", ["k"]).filter("v is not null").collect()}
    assert got == want


def test_rank_block_agrees_with_spark_ntile(spark):
    from pyspark.sql import Window

    df = spark.range(1, 78).select((F.col("id") % 3).alias("g"), "id", (F.col("id") * 7 % 11).cast("double").alias("v"))
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    want = {(r.g, r.id): r.t for r in df.withColumn("t", F.ntile(4).over(w)).collect()}
    got = {(r.g, r.id): r.tile for r in rank_block(df, ["g"], "v", ["id"]).collect()}
    assert got == want


def test_exact_sum_is_the_same_in_any_order_and_takes_every_double(spark):
    odd = [float("nan"), 1e300, 1e-300, None]
    rows = [("a", v) for v in (0.1, 0.2, 0.3)] + [("b", v) for v in (0.3, 0.2, 0.1)] + [("c", 1e300), ("c", -1e300), ("c", 0.1)]
    rows += [(f"odd {v}", v) for v in odd] + [("big", 9e19), ("big", 9e19)]
    got = {r.k: r.s for r in spark.createDataFrame(rows, "k string, v double").coalesce(1).groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got["a"] == got["b"] == 0.6 and got["c"] == 0.1 and got["big"] == 1.8e20
    assert str(got["odd nan"]) == "nan" and [got[f"odd {v}"] for v in odd[1:]] == odd[1:]


def test_customers_of_equal_orders_share_a_position(spark, tmp_path):
    from plumbline.plans.star.indicators import customer_kpi

    prices = {1: (0.1, 0.2, 0.3), 2: (0.3, 0.2, 0.1), 3: (0.5,)}
    orders = [(10 * c + i, c, p, dt.datetime(1996, 1, 1)) for c, ps in prices.items() for i, p in enumerate(ps)]
    tables = {
        "customer": ([(c, "BUILDING") for c in prices], "c_custkey long, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
        "lineitem": ([(o[0], "R", 1.0) for o in orders], "l_orderkey long, l_returnflag string, l_extendedprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.custkey: (r.position, r.percentile) for r in customer_kpi(spark, str(tmp_path)).collect()}
    assert got == {1: (1, 0.5), 2: (1, 0.5), 3: (3, 0.0)}


def test_match_outer_null_keys_never_match(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, r string")
    out = match_outer(left, right, ["k"], {"l": "l"}, {"r": "r"}, ("MATCH", "L", "R"))
    assert sorted((r.l or "", r.r or "", r.integration_status) for r in out.collect()) == [
        ("", "y", "R"), ("", "z", "R"), ("a", "x", "MATCH"), ("b", "", "R"), ("c", "", "L"),
    ]


def test_decode_keeps_rows_without_a_label(spark):
    codes = spark.createDataFrame([("t", "c", str(i), f"L{i}") for i in range(5)], "id_tabela string, nome_coluna string, chave string, valor string")
    facts = spark.createDataFrame([("1",), ("9",), (None,)], "c string")
    out = decode_columns(facts, codes, "t", {"c_nome": ("c", "c")})
    assert [(r.c, r.c_nome) for r in out.orderBy("c").collect()] == [(None, None), ("1", "L1"), ("9", None)]


def test_wide_to_long_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "id int, a double, b double")
    assert [tuple(r) for r in wide_to_long(df, {10: "a", 20: "b"}, "k", "v").collect()] == [(1, 10, None), (1, 20, 2.0)]


def test_share_band_and_next(spark):
    df = spark.createDataFrame([("a", 2023, 1), ("a", 2025, 3), ("b", 2023, 0)], "g string, y int, n int")
    shares = {(r.g, r.y): r.s for r in share_of_total(df, ["g"], "n", "s").collect()}
    assert shares == {("a", 2023): 25.0, ("a", 2025): 75.0, ("b", 2023): None}
    ahead = {(r.g, r.y): r.t for r in next_period(df, ["g"], "y", {"t": "y"}).collect()}
    assert ahead == {("a", 2023): 2025, ("a", 2025): None, ("b", 2023): None}
    bands = spark.createDataFrame([(79.99,), (80.0,), (90.0,), (None,)], "p double")
    label = banded("p", [(80, "low"), (90, "mid")], "high", "none")
    assert [r[0] for r in bands.select(label).collect()] == ["low", "mid", "high", "none"]
    assert spark.range(1).select(safe_percent(F.lit(1), F.lit(0))).first()[0] is None


def test_suite_sums_parts_and_gate_lists_failures(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    checks = [
        Check("RECONCILIATION", "a", [row_count(df)], [2, row_count(df.limit(1))]),
        Check("UNIQUENESS", "b", [0], [repeated_keys(df, ["k"])]),
        Check("UNIQUENESS", "c", [0], [surplus_rows(df, "k")]),
        Check("RECONCILIATION", "d", [1], [has_rows(df.limit(0))]),
    ]
    out = suite(spark, checks, F.lit(None).cast("timestamp"))
    got = {r.object_name: (r.expected_value, r.actual_value, r.status) for r in out.collect()}
    assert got == {"a": (3, 3, "OK"), "b": (0, 1, "FAIL"), "c": (0, 1, "FAIL"), "d": (1, 0, "FAIL")}
    with pytest.raises(CheckFailure, match="UNIQUENESS b: expected 0, got 1"):
        gate(out)
    gate(out.filter("status = 'OK'"))


T0 = dt.datetime(2026, 7, 12, 1, 0, 0)


def check_rows(spark, run, statuses, at=T0):
    return spark.createDataFrame(
        [("T", f"o{i}", 1, 1, s, run, at) for i, s in enumerate(statuses)],
        "check_type string, object_name string, expected_value long, actual_value long, status string,"
        " batch_id string, executed_at timestamp",
    )


def test_history_append_is_idempotent_but_null_keys_repeat(spark, tmp_path):
    path = str(tmp_path / "h")
    keys = ["batch_id", "check_type", "object_name", "executed_at"]
    first = check_rows(spark, "b1", ["OK", "FAIL"])
    assert append_if_absent(spark, path, first, keys, "executed_at").count() == 2
    assert append_if_absent(spark, path, first, keys, "executed_at").count() == 2
    more = first.union(check_rows(spark, None, ["OK"]))
    assert append_if_absent(spark, path, more, keys, "executed_at").count() == 3
    assert append_if_absent(spark, path, more, keys, "executed_at").count() == 4
    assert empty_like(first).count() == 0 and empty_like(first).schema == first.schema


def test_health_failures_and_latest(spark):
    at = F.lit("2026-07-12 02:00:00").cast("timestamp")
    silver, gold = check_rows(spark, "b1", ["OK", "FAIL", "OK"]), check_rows(spark, None, ["OK"])
    h = observe.health_of(silver, "silver_batch", at, "batch_id").union(observe.health_of(gold, "gold_batch", at))
    rows = {r.pipeline_name: r for r in h.collect()}
    assert (rows["silver_batch"].checks_failed, rows["silver_batch"].pipeline_status) == (1, "FAILED")
    assert rows["gold_batch"].run_id == "gold_20260712T010000Z" and rows["gold_batch"].pipeline_status == "SUCCEEDED"
    empty = observe.health_of(gold.limit(0), "gold_batch", at).collect()
    assert len(empty) == 1 and empty[0].run_id is None and empty[0].pipeline_status == "SUCCEEDED"
    feed = observe.failure_feed({"silver": (silver, F.col("batch_id")), "gold": (gold, F.lit("g"))}).collect()
    assert [(r.pipeline_layer, r.object_name) for r in feed] == [("silver", "o1")]
    later = h.withColumn("executed_at", F.col("executed_at") + F.expr("interval 1 hour"))
    assert observe.latest_health(h.union(later)).filter(F.hour("executed_at") == 2).count() == 2


def test_usage_window_and_rollup(spark):
    def job(days, status="SELECT", state="DONE", kind="QUERY", error=None, billed=1 << 40, cached=True):
        return (dt.datetime(2026, 7, 12) - dt.timedelta(days=days), "u", status, kind, state, error, 10, billed, 5, cached)

    jobs = spark.createDataFrame(
        [job(0), job(0, None), job(180), job(181), job(1, "SCRIPT"), job(1, state="RUNNING"), job(1, kind="LOAD"),
         job(0, error="x", billed=None, cached=None)],
        "creation_time timestamp, user_email string, statement_type string, job_type string, state string,"
        " error_result string, total_bytes_processed long, total_bytes_billed long, total_slot_ms long, cache_hit boolean",
    )
    now = F.lit("2026-07-12 00:00:00").cast("timestamp")
    daily = observe.usage_daily(jobs, now, now)
    got = {(str(r.usage_date), r.statement_type): (r.query_jobs, r.failed_jobs, r.total_tib_billed, r.cache_hit_jobs) for r in daily.collect()}
    assert got == {("2026-07-12", "SELECT"): (2, 1, 1.0, 1), ("2026-07-12", "UNKNOWN"): (1, 0, 1.0, 1),
                   ("2026-01-13", "SELECT"): (1, 0, 1.0, 1)}
    total = observe.usage_summary(daily).first()
    assert total.query_jobs == 4 and total.total_tib_billed == 3.0
    assert observe.usage_summary(daily.limit(0)).first().query_jobs is None
    assert observe.usage_by_day(daily).filter("usage_date = '2026-07-12'").first().total_gib_billed == 2048.0


def test_sustained_alert_needs_five_full_minutes(spark):
    base = dt.datetime(2026, 1, 1)
    samples = [("hot", base + dt.timedelta(minutes=m, seconds=10), 150.0) for m in range(6)]
    samples += [("dip", base + dt.timedelta(minutes=m), 150.0 if m != 2 else 100.0) for m in range(6)]
    samples += [("gap", base + dt.timedelta(minutes=m), 150.0) for m in (0, 1, 2, 4, 5)]
    df = spark.createDataFrame(samples, "series string, ts timestamp, value double")
    out = sustained_breaches(df, AlertPolicy("backlog", 100)).orderBy("breach_start").collect()
    assert [(r.series, r.breach_start.minute, r.breach_end.minute) for r in out] == [("hot", 0, 5), ("hot", 1, 6)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "n int, s string")
    exact = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in
             profile.profile_columns(df, "t", exact_distinct=True).collect()}
    assert exact == {"n": (3, 0, 2), "s": (3, 1, 2)}
    estimated = {r.column_name: (r.distinct_count, r.min_value, r.max_value) for r in profile.profile_columns(df, "t").collect()}
    assert estimated == {"n": (2, "1", "2"), "s": (2, "a", "b")}
    assert profile.search_rows(df, r'"s":"a"').count() == 1
    assert profile.column_inventory({"t": df}).count() == 2
    assert profile.sample_rows(df, 2).count() == 2 and profile.table_volume({"t": df}).first()[1] == 3
