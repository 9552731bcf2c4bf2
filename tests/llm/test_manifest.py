"""The manifest against a tree built by hand."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import manifest
from plumbline.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def slow_leaf(r, text):
    fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def slow_tree(leaves):
    """The root, and for each leaf its (left, right) siblings upwards."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, p in enumerate(at):
            start = p - p % 8
            steps[i].append(("".join(nodes[start:p]), "".join(nodes[p + 1 : start + 8])))
        at = [p // 8 for p in at]
        nodes = [H(*nodes[s : s + 8]) for s in range(0, len(nodes), 8)]
    return nodes[0], steps


def slow_manifest(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [(r["doc_id"] is not None, r["doc_id"] or 0, slow_leaf(r, r["text"]), i) for i, r in enumerate(rows) if r["lang"] == lang]
        own.sort()
        trees[lang] = (own, *slow_tree([x[2] for x in own]))
    root, above = slow_tree([trees[lang][1] for lang in langs])
    out = []
    for lang, up in zip(langs, above):
        own, subroot, steps = trees[lang]
        for (_, _, leaf, i), below in zip(own, steps):
            r, way = rows[i], below + up
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = text.translate(LOWER)
            h = slow_leaf(r, text)
            for left, right in way:
                h = H(left, h, right)
            out.append((r["doc_id"], leaf, subroot, root, H(*(a + b for a, b in way)), h, h == root))
    return sorted(out, key=str)


def check(spark, rows, folder, parts=7):
    spark.createDataFrame(rows, SCHEMA).withColumn("hash", F.lit("own")).repartition(parts).write.parquet(f"{folder}/documents.parquet")
    out = op13_merkle_manifest(spark, folder)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == slow_manifest([dict(zip([f.split()[0] for f in SCHEMA.split(", ")], r)) for r in rows])
    return got


def documents(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        text = rng.choice([None, "", "Some Text", "ÄÖ small é", "lower only", f"No {i}"])
        rows.append((i, text, rng.choice(["en"] * 6 + ["de", None]), rng.choice([None, "", "web"]), rng.choice([None, 0, 7])))
    return rows


@pytest.mark.parametrize("count", [1, 9, 700])
def test_proofs_equal_a_tree_by_hand(spark, tmp_path, count):
    check(spark, documents(count, count), str(tmp_path))


def test_more_than_one_block_of_blocks(spark, tmp_path, monkeypatch):
    """Blocks of eight nodes, so that 700 leaves need four trees one above the other."""
    monkeypatch.setattr(manifest, "DIGITS", 1)
    got = check(spark, documents(5, 700), str(tmp_path))
    assert 30 < sum(not r[-1] for r in got) < 500


def test_many_groups(spark, tmp_path):
    check(spark, [(i, "Text", f"l{i % 90}é", "s", 4) for i in range(200)], str(tmp_path))


def test_odd_rows_ties_and_empty_tables(spark, odd, none, tmp_path):
    rows = [(3, "Same", "en", "a", 4)] * 20 + [(3, "Other", "en", None, 5), (None, None, None, None, None), (None, "No id", "en", "", 0), (7, "X" * 200_000, "", "é", 1)]
    check(spark, rows, str(tmp_path))
    more = {"source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), "steps": F.lit("own")}
    assert manifest.proved(odd.withColumns(more)).count() == odd.count()
    assert manifest.proved(none.withColumns(more)).count() == 0


def test_blocks_are_nested_by_one_shuffle_and_proofs_need_no_join(spark):
    nodes = spark.range(2000).select((F.col("id") % 2).cast("string").alias("group"), (F.col("id") % 2 + 1000).alias("n"), F.col("id").alias("rank"), F.lit("h").alias("hash"), F.lit(0).alias("item"))
    plan = manifest._nested(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    blocks = manifest._nested(nodes).withColumns({"steps": F.array().cast(manifest._STEPS), "tops": F.array(F.lit("t"))})
    down = manifest._handed_down(blocks)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in down and down.count("Exchange") == plan.count("Exchange")
