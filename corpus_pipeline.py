"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, pieces.

Part of the ``llm`` subpackage. Each stage works on all that the stage before kept and its decisions take effect.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import contamination, pieces, simhash, substring, toxicity
from plumbline.session import fresh_path

# Documents with at least this score are rejected.
TOXIC = 0.3
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the label rows that are not held out."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~toxicity.held_out())
    return toxicity.scored(docs, model, keep_text=True).where(F.col("score") < TOXIC).select("doc.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by fingerprints of three-word shingles, at 3 or fewer differing bits, that with the smallest id."""
    return simhash.representatives(docs)


def trimmed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with repeated passages of twenty words and more cut wherever they do not occur first.

    A document that loses nothing stays as it is; one that loses all its words stays with an empty text.
    """
    out = substring.remove_repeats(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    same = F.col("n_removed") == 0
    columns = [F.when(same, F.col("doc")[c]).otherwise(new[c]).alias(c) if c in new else F.col("doc")[c].alias(c) for c in docs.columns]
    return out.select(*columns)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    out = contamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.where(F.size("spans") == 0).select("doc.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, and whether these decode to the text."""
    out = pieces.encoded(docs, MODEL)
    exact = F.col("decoded") == F.coalesce("doc.text", F.lit(""))
    return out.select("doc.doc_id", "doc.lang", "doc.source", "ids", F.size("ids").cast("long").alias("n_tokens"), exact.alias("round_trip"))


STAGES = [
    ("toxicity", clean),
    ("near-dedup", distinct),
    ("substring-dedup", trimmed),
    ("decontamination", unseen),
    ("sentencepiece", encoded),
]

# Learned scores, reachability over links and piece merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
