"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import spelling
from plumbline.llm.queries import op12_spelling_variants
from test_duplicates import frame


def slow_counts(docs, damage):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(n):
    near = {w: [v for v in n if one_apart(v, w)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n.get(form[w]), root)
    return out


def words_of(seed, size):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(rng.choice("eeaonéÿ÷zß") for _ in range(rng.choice([6, 7, 8, 30, 31, 32, 40])))
        words.add(w)
        for _ in range(rng.randint(0, 3)):
            at, c = rng.randrange(len(w)), rng.choice("eaonxé")
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])
            if len(w) >= 6:
                words.add(w)
    return {w: 5 * 5 ** rng.randint(0, 4) + rng.randint(0, 1) for w in sorted(words)}


def as_rows(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("seed, upper, chunk, block", [(1, 5, 50_000, 200_000), (2, 1, 3, 1), (3, 2, 7, 20), (4, 16, 1, 5)])
def test_variants_equal_brute_force(spark, seed, upper, chunk, block):
    n = words_of(seed, 300)
    got = as_rows(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), upper=upper, chunk=chunk, block=block))
    assert got == slow_variants(n)
    assert sum(r[2] is not None for r in got.values()) > 20


def test_both_directions_of_each_pair_once(spark):
    n = words_of(5, 200)
    rows = spelling.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), upper=3, chunk=20).collect()
    pairs = [(r.word, r.near) for r in rows]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in n for b in n if one_apart(a, b)}
    assert all((r.n, r.near_n) == (n[r.word], n[r.near]) for r in rows)


def test_counts_of_letters_at_their_top_hide_nothing(spark):
    """More of a letter than a count holds: equal vectors, and vectors that show one change of two."""
    words = ["e" * k + "a" * m for k in (14, 15, 16, 17, 18) for m in (14, 15, 16, 17)] + ["x" * 50_000, "x" * 49_999]
    got = as_rows(spelling.variants(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), upper=1))
    assert {w: r[1] for w, r in got.items()} == {w: sum(one_apart(w, v) for v in words) for w in words}


@pytest.mark.parametrize("damage", [None, 7])
def test_word_counts_equal_brute_force(spark, damage):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["Straße", "ÉCLAIRS", "éclairs", "x1Garden", "GARDEN", "garden-hose", "×÷×÷×÷×", "tiny", "a"]) for _ in range(40))) for i in range(30)]
    docs += [(None, "garden " * 7), (3, None), (4, "")]
    got = spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), damage=damage)
    assert {r.word: r.n for r in got.collect()} == slow_counts(docs, damage)


def test_letters_beyond_the_groups_are_compared_too():
    words = ["αβγδεζ", "αβγδεη", "αβγδε𐍈", "a" * 40, "a" * 41]
    a, b = np.array([0, 0, 3, 3]), np.array([1, 2, 4, 0])
    assert spelling.Spelled(words).one_apart(a, b).tolist() == [True, True, True, False]


def test_spelling_of_odd_and_empty_tables(spark, odd, none, tmp_path):
    rows = odd.select("doc_id", "text").collect()
    got = as_rows(spelling.variants(spelling.word_counts(odd, damage=199)))
    assert got == slow_variants(slow_counts([(r.doc_id, r.text) for r in rows], 199))
    assert spelling.variants(spelling.word_counts(none)).count() == 0
    frame(spark, ["garden garden", None]).write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_spelling_variants(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spelling.word_counts(none), ratio=1)
