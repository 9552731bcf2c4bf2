"""Whole-row search through an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.quality import union_all
from plumbline.operators.textindex import TextIndex
from plumbline.plans.star.base import Query, table
from plumbline.session import fresh_path

SEARCHED = "(apache licen[sc]e|password|secret)"
# Words that a few rows in a thousand mention are in every large file, so files hold few rows however large the table is.
FILES, ROWS_PER_FILE = 128, 64


def text_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and conversation turns whose row, as JSON, mentions one of the words, read from the files that may hold them.

    ``hits`` per id; a last row per table, without an id, has all hits and says whether files were spared.
    """
    out = []
    for name, key in (("documents", "doc_id"), ("conversations", "conv_id")):
        folder = fresh_path(spark, f"searched-{name}")
        rows = table(spark, sf, name)
        rows.repartitionByRange(max(FILES, -(-rows.count() // ROWS_PER_FILE)), key).write.parquet(folder)
        index = TextIndex(spark, folder, fresh_path(spark, f"trigrams-{name}"))
        index.refresh()
        spared = len(index.candidates(SEARCHED)) < len(index.files())
        found = index.search(SEARCHED, keep=[key]).select(F.col(key).alias("id"))
        hits, tabela = F.count(F.lit(1)).alias("hits"), F.lit(name).alias("tabela")
        out.append(found.groupBy("id").agg(hits).select(tabela, "id", "hits", F.lit(None).cast("boolean").alias("files_spared")))
        out.append(found.agg(hits).select(tabela, F.lit(None).cast("long").alias("id"), "hits", F.lit(spared).alias("files_spared")))
    return union_all(out)


INDEXED_SQL = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS tabela, {key} AS id, count(*) AS hits, CASE WHEN grouping({key}) = 1 THEN true END AS files_spared FROM {name}
WHERE regexp_matches(lower(concat_ws(' ', {columns})), '{SEARCHED}') GROUP BY ROLLUP ({key})"""
    for name, key, columns in (("documents", "doc_id", "doc_id, text, lang, source, n_chars"), ("conversations", "conv_id", "conv_id, turn, role, text"))
)

QUERIES: dict[str, Query] = {"text_search_indexed": Query(text_search_indexed, INDEXED_SQL)}
