from __future__ import annotations

import pytest

ODD = [
    (3, "same text here", "en"), (3, "same text here", "en"), (3, "another text under one id", None), (None, "no id at all, but words", "fr"),
    (None, None, None), (1, None, "en"), (2, "", "de"), (4, "   \n\t ", "en"), (5, "wörter 你好 ok " * 3000, "de"), (6, "x" * 50_000, "zz"), (7, "a", ""),
]
CLASHING = ["doc", "marks", "part", "version", "first", "windows", "print", "ids", "key", "score", "spans", "kept", "id", "chunk", "anchor"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, and extra columns named like internal ones."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    return rows.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.fixture(scope="session")
def none(odd):
    """The same columns without a row."""
    return odd.where("false")
