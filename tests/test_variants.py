"""Texts of JSON members read beside their variants, and helpers of the event contract on long and odd texts."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from plumbline.functions.text import spaced_json, strip, strip_column
from plumbline.functions.variants import member_columns, members_of, texts_of

NAMES = ["a", "b"]
ODD = [
    '{"a": "x", "b": "y"}', '{"a": " é\\u00e9\\n\\"q\\" ", "b": ""}', '{"a": 130.0, "b": 1e3}', '{"a": true, "b": null}', '{"b": "only"}',
    '{"a": {"k": "v"}, "b": ["1"]}', '{"a": "x", "a": "y"}', '{"a": "x", "b": "cut', "[1]", '"text"', "", "no json", "{}", None,
    '{"a": "130.0", "b": 12345678901234567890}', '{"a": "\\ud83d\\ude00", "b": -0.0}',
]


def test_texts_read_beside_variants_are_those_of_the_variants(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    read = df.select("i", members_of(F.col("t"), NAMES).alias("m"), texts_of(F.col("t"), NAMES).alias("s"))
    names = {n: n for n in NAMES}
    rows = read.withColumns(member_columns("m", names, "s")).withColumns({f"old_{k}": c for k, c in member_columns("m", names).items()}).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        for c in ("a__kind", "a__text", "b__kind", "b__text"):
            assert r[c] == r[f"old_{c}"], (ODD[r.i], c)


def test_stripping_a_column_is_stripping(spark):
    texts = ["", " ", "x", " x", "x ", "　x ", "é", " é", "x\x00", "\x00", "a b", "\tx y\n", None, "x́", "~!"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.a for r in df.select(strip_column("t").alias("a")).collect()] == [r.a for r in df.select(strip("t").alias("a")).collect()]


def test_long_strings_are_spaced(spark):
    value = {"a": "x,:" * 60_000, "b": [1, 'q"\\,'], "c": {"d": None}}
    text = json.dumps(value, separators=(",", ":"))
    assert spark.createDataFrame([(text,)], "t string").select(spaced_json(F.col("t")).alias("s")).first().s == json.dumps(value)
