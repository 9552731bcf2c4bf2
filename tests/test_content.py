"""Content differences of two tables against a comparison row by row."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from plumbline.operators import content

SCHEMA = "k int, part string, a string, b string, v double"


def slow(left, right):
    out = {}
    counts = Counter(left), Counter(right)
    for k in {r[0] for r in left + right}:
        own = [Counter({r: n for r, n in c.items() if r[0] == k}) for c in counts]
        gone, new = own[0] - own[1], own[1] - own[0]
        if gone or new:
            differing = set(gone) | set(new)
            n = [sum(c[r] for r in differing) for c in own]
            out[k] = (*n, "MISSING" if not n[1] else "EXTRA" if not n[0] else "CHANGED" if n[0] == n[1] else "REPEATED")
    return out


@pytest.mark.parametrize("buckets, by", [(4096, []), (1, ["part"]), (7, ["part"])])
def test_differences_equal_a_comparison_row_by_row(spark, buckets, by):
    rng = random.Random(buckets)
    row = lambda k: (k, rng.choice(["x", "y", None]), rng.choice(["s", None, ""]), rng.choice(["s", None, ""]), rng.choice([0.5, None]))
    left = [row(k) for k in range(200)] + [(None, None, "s", None, 1.0)] * 3
    right = [r for r in left if r[0] is None or r[0] % 40]
    right += [(900 + i, "x", "new", None, 1.0) for i in range(3)] + right[7:9] + [(None, None, "s", None, 1.0)]
    # A null that changes its column, and two values that change places.
    right[10], right[11] = (*right[10][:2], "s", None, 0.5), (*right[11][:2], None, "s", 0.5)
    rng.shuffle(right)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (left, right)]
    got = {r.k: (r.n_left, r.n_right, r.status) for r in content.row_differences(*frames, ["k"], by=by, buckets=buckets).collect()}
    assert got == slow(left, right) and {s for *_, s in got.values()} >= {"MISSING", "EXTRA", "REPEATED"}
    if by:
        sums = [content.content_summary(f, by, buckets) for f in frames]
        parts = {r.part: r for r in content.partition_differences(*sums, by).collect()}
        for part in ("x", "y", None):
            own = [Counter(r for r in rows if r[1] == part) for rows in (left, right)]
            assert (parts[part].status == "SAME") == (own[0] == own[1]) and parts[part].n_left == sum(own[0].values())


def test_equal_and_empty_tables_have_no_differences(spark):
    rows = spark.createDataFrame([(1, "x", None, "s", 0.5)] * 5 + [(2, None, "", None, None)], SCHEMA)
    assert content.row_differences(rows, rows.repartition(3), ["k"]).count() == 0
    none = rows.where("false")
    assert content.row_differences(none, none, ["k"]).count() == 0
    assert {(r.k, r.status) for r in content.row_differences(none, rows, ["k"]).collect()} == {(1, "EXTRA"), (2, "EXTRA")}
