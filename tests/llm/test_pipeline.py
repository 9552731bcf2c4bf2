"""Each pipeline stage against a brute-force version of it, on the rows that the stage before kept."""

from __future__ import annotations

import os

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import toxicity
from test_duplicates import slow_groups, slow_print, slow_windows
from test_texts import PIECES, slow_hits

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no data here")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_and_stand_in_order(steps):
    assert [s[0] for s in steps] == ["toxicity", "near-dedup", "substring-dedup", "decontamination", "sentencepiece"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    for _, before, after in steps:
        assert 0.8 * before.count() < after.count() <= before.count()


def test_toxic_documents_go(spark, steps):
    _, before, after = steps[0]
    model = toxicity.fit(before, spark.read.parquet(f"{FOLDER}/labels.parquet"), ~toxicity.held_out())
    reader = toxicity.Reader(model.terms, model.weights, model.rates)
    kept = {i for i, t in texts(before).items() if toxicity.probability(model, reader.features(t)) < corpus_pipeline.TOXIC}
    assert texts(after).keys() == kept


def test_one_document_of_each_group_stays(steps):
    _, before, after = steps[1]
    docs = sorted(texts(before).items())
    groups = slow_groups([slow_print(t) for _, t in docs], [i for i, _ in docs])
    assert texts(after).keys() == set(groups)


def test_repeated_passages_stay_once(steps):
    _, before, after = steps[2]
    old, new = texts(before), texts(after)
    for i, (_, removed, kept) in slow_windows(sorted(old.items()), 20).items():
        assert new[i].encode().split() == kept and (removed or new[i] == old[i])
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0


def test_documents_with_benchmark_passages_go(spark, steps):
    _, before, after = steps[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert texts(after).keys() == {i for i, t in texts(before).items() if not slow_hits(t, items)[1]}


def test_pieces_are_the_librarys(steps):
    _, before, after = steps[4]
    library, old = sentencepiece.SentencePieceProcessor(model_file=PIECES), texts(before)
    rows = after.collect()
    assert {r.doc_id for r in rows} == old.keys()
    assert all(r.ids == library.encode(old[r.doc_id]) and r.round_trip and r.n_tokens == len(r.ids) for r in rows)


def test_pipeline_runs_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    columns = ["doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), "version", "marks"]
    labels = spark.createDataFrame([(3, 0, 0), (7, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", odd), ("none", none)):
        docs.select(*columns).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([(1, "same text here"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r.round_trip for r in out) and (name == "odd") == bool(out)
        # The row that holds a whole benchmark item is gone, the other text under its id is not.
        library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        assert library.encode("same text here") not in [r.ids for r in out]
        assert name == "none" or library.encode("another text under one id") in [r.ids for r in out]
