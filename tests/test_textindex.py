from __future__ import annotations

import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.operators.profile import search_rows
from plumbline.operators.textindex import TextIndex, ways_to_match


def trigrams(text):
    return {text[i : i + 3] for i in range(len(text) - 2)}


@pytest.mark.parametrize(
    ("pattern", "ways"),
    [
        ("abcd", [{"abc", "bcd"}]),
        ("licen[sc]e", [{"lic", "ice", "cen", "enc", "nce"}, {"lic", "ice", "cen", "ens", "nse"}]),
        ("abc.def", [{"abc", "def"}]),
        ("x(abc)+d", [{"xab", "abc"}]),
        ("abc|defg", [{"abc"}, {"def", "efg"}]),
        ("abc|d.", [set(), {"abc"}]),
        ("(abc)?", [set()]),
        (r"\bname\b", [{"nam", "ame"}]),
        ("(?i)ABC", [set()]),
        ("[abc[def]]xyz", [set()]),
        ("abc(", [set()]),
        ("(a|b|c|d)(a|b|c|d)(a|b|c|d)(a|b|c|d)", [set()]),
    ],
)
def test_ways_to_match(pattern, ways):
    assert sorted(map(sorted, ways_to_match(pattern))) == sorted(map(sorted, ways))


PIECES = st.sampled_from(["a", "b", "ab", "[ab]", "[^a]", "(ab|ba)", "(?:a|bb)?", "(ab)+", ".", "a*", "b{2}", "$", "^", "(aab|b)"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=6).map("".join), st.text("abc", max_size=12))
def test_every_match_has_what_a_way_needs(pattern, text):
    if re.search(pattern, text):
        assert any(way <= trigrams(text) for way in ways_to_match(pattern))


def test_search_reads_only_files_that_may_match(spark, tmp_path):
    table, index = f"{tmp_path}/t", None
    rows = [(i, f"row {i} says nothing", None if i % 3 else "ção") for i in range(200)]
    rows[17] = (17, 'The "SECRET"\nword', None)
    rows[150] = (150, None, "secret ção")
    schema = "id int, s string, z string"
    spark.createDataFrame(rows, schema).repartitionByRange(20, "id").write.parquet(table)
    index = TextIndex(spark, table, f"{tmp_path}/index")
    n = len(index.files())
    assert len(index.candidates("secret")) == n  # nothing is indexed yet
    assert index.refresh() == n and index.refresh() == 0
    assert len(index.candidates("secret")) == 2
    assert len(index.candidates("zzzz")) == 0 and index.search("zzzz", keep=["id"]).count() == 0
    for pattern in ("secret", "(secret|row 12)", r'"secret\\"\\nword', "ção", "s.y", "row 1[0-9]{2} "):
        whole = {tuple(r) for r in search_rows(spark.read.parquet(table), pattern, keep=["id"]).collect()}
        assert {tuple(r) for r in index.search(pattern, keep=["id"]).collect()} == whole
    # Only what holds all trigrams is read: checked against the files' own text.
    per_file: dict = {}
    for r in spark.read.parquet(table).selectExpr("input_file_name() f", "id", "s", "z").collect():
        line = json.dumps({"id": r.id, "s": r.s, "z": r.z}, ensure_ascii=False, separators=(",", ":")).lower()
        per_file.setdefault(r.f, set()).update(trigrams(line))
    assert set(index.candidates("row 12")) == {f for f, has in per_file.items() if trigrams("row 12") <= has}


def test_new_files_are_searched_before_they_are_indexed(spark, tmp_path):
    table = f"{tmp_path}/t"
    frame = lambda *rows: spark.createDataFrame(list(rows), "id int, s string")
    frame((1, "one"), (2, "needle two")).coalesce(1).write.parquet(table)
    index = TextIndex(spark, table, f"{tmp_path}/index")
    assert index.refresh() == 1
    frame((3, "a needle"), (4, "")).coalesce(1).write.mode("append").parquet(table)
    assert {r.id for r in index.search("needle", keep=["id"]).collect()} == {2, 3}
    assert index.refresh() == 1 and len(index.indexed()) == 2
    assert {r.id for r in index.search("needle", keep=["id"]).collect()} == {2, 3}


def test_partition_columns_and_empty_table(spark, tmp_path):
    table = f"{tmp_path}/t"
    spark.createDataFrame([(1, "x y", 2020), (2, "needle", 2021)], "id int, s string, year int").write.partitionBy("year").parquet(table)
    index = TextIndex(spark, table, f"{tmp_path}/index")
    index.refresh()
    assert [tuple(r) for r in index.search("needle", keep=["id", "year"]).select("id", "year").collect()] == [(2, 2021)]
    assert index.search('"year":2020', keep=["id"]).first().id == 1
    empty = f"{tmp_path}/e"
    spark.createDataFrame([], "id int, s string").write.parquet(empty)
    index = TextIndex(spark, empty, f"{tmp_path}/index2")
    index.refresh()
    assert index.search("needle").count() == 0


def test_a_grown_table_still_has_files_to_spare(spark, tmp_path):
    from plumbline.plans.star.search import text_search_indexed

    said = "if(id % 150 = 0, 'a secret', 'nothing') AS text"
    spark.range(20_000).selectExpr("id AS doc_id", said, "'en' AS lang", "'s' AS source", "8 AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(10).selectExpr("id AS conv_id", "1 AS turn", "'user' AS role", said).write.parquet(f"{tmp_path}/conversations.parquet")
    whole = {r.tabela: (r.hits, r.files_spared) for r in text_search_indexed(spark, str(tmp_path)).where("id IS NULL").collect()}
    assert whole == {"documents": (134, True), "conversations": (1, True)}
