"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from plumbline.llm import bytepairs, contamination, editprint, exact, manifest, pages, pieces, simhash, spelling, substring, tokens, toxicity, warc
from plumbline.llm.common import table
from plumbline.session import fresh_path, stage

_SPACE = "[\\x20\\x09-\\x0D]+"


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    out = simhash.duplicate_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    return editprint.against_next(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark windows, and the items they come from."""
    out = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = contamination.n_hit("spans")
    return out.select(
        "doc.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing every window of twenty words that also starts earlier."""
    out = substring.remove_repeats(table(spark, sf_dir, "documents"))
    words = F.trim(F.regexp_replace(F.coalesce("kept", F.lit("")), _SPACE, " "))
    return out.select("doc.doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left after removing every string of 400 bytes that occurs more than once."""
    out = exact.remove_repeated_strings(table(spark, sf_dir, "documents"), keep_text=False)
    left = F.octet_length("kept").cast("long")
    return out.select("doc.doc_id", "n_bytes", (F.col("n_bytes") - left).alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each document, their number and digest, and whether decoding gives the text back."""
    out = pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc.doc_id", F.length(F.coalesce("doc.text", F.lit(""))).cast("long").alias("n_chars"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("doc.text", F.lit(""))).alias("round_trip"), "ids",
    )


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids in the token files."""
    path = fresh_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.token_spans(spark, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document by a model of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    out = toxicity.scored(docs, model)
    return out.select("doc.doc_id", toxicity.held_out("doc.doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    out = pages.extracted(table(spark, sf_dir, "pages"), keep_html=False)
    return out.select("doc.page_id", "doc.url", F.col("main").alias("text"), F.length("main").cast("long").alias("n_chars"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload size and digest and the kind of record of each page, as read back from the archives."""
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    size, digest = F.octet_length("payload").cast("long"), F.sha2("payload", 256)
    rows = stage(warc.read_archives(spark, path).select("type", "page", "refers_to", size.alias("size"), digest.alias("digest")), "warc-records")
    full = rows.where("type = 'response'").groupBy(F.col("page").alias("of")).agg(F.max("size").alias("full_size"), F.max("digest").alias("full_digest"))
    joined = rows.join(full, F.col("refers_to") == F.col("of"), "left")
    return joined.select(
        F.when(F.col("page") != "null", F.col("page").cast("long")).alias("page_id"), F.coalesce("size", "full_size").alias("payload_bytes"),
        F.coalesce("digest", "full_digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of each document's byte-level BPE ids, and the digest of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bytepairs.decoded(bytepairs.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path, keep_text=False), path)
    return out.select(
        "doc.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of the documents, with one occurrence in 199 misspelled."""
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), damage=199))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of each document, and whether the proof holds for it, tampered with where 3 divides a checksum."""
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", manifest.CAPITALS, manifest.CAPITALS.lower())
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, manifest.leaf({"text": lower}))
    out = manifest.proved(docs, extra={"tampered": tampered})
    folded = manifest.folded(F.coalesce("extra.tampered", "leaf"), F.col("steps"))
    rows = out.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest("steps").alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_token_output": op7_token_output,
    "op8_toxicity": op8_toxicity,
    "op9_html_extraction": op9_html_extraction,
    "op10_warc": op10_warc,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# CRC-32 of a list of bytes b, by the usual table.
_CRC_TABLE = """crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i)
)"""
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT)"


def _bytes_of(text: str) -> str:
    """The UTF-8 bytes of a text of characters up to U+07FF."""
    return (
        f"flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] "
        "ELSE [(192 | (unicode(x) >> 6))::BIGINT, (128 | (unicode(x) & 63))::BIGINT] END))"
    )


def _levels(tree: str, count: int) -> str:
    """CTEs of the levels above ``tree`` (g, i, h), ``{tree}_0`` and on, with the siblings of each node; the last has one node for each g."""
    out = []
    for k in range(count):
        source = tree if k == 0 else f"(SELECT g, i, any_value(up) AS h FROM (SELECT g, more, CASE WHEN more THEN i // 8 ELSE i END AS i, up FROM {tree}_{k - 1}) GROUP BY g, i)"
        out.append(f"""{tree}_{k} AS (
    SELECT *, CASE WHEN more THEN sha256(lft || h || rgt) ELSE h END AS up FROM (
        SELECT g, i, h, more, CASE WHEN more THEN coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS lft,
            CASE WHEN more THEN coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS rgt
        FROM (SELECT *, count(*) OVER (PARTITION BY g) > 1 AS more FROM {source})
    )
)""")
    return ",\n".join(out)


def _ways(rows: str, tree: str, count: int) -> str:
    """CTEs that lead ``rows`` (.., g, i, folded, proof) up the levels of ``tree``."""
    out = []
    for k in range(count):
        out.append(f"""{rows}_{k + 1} AS (
    SELECT a.* REPLACE (CASE WHEN more THEN a.i // 8 ELSE a.i END AS i, CASE WHEN more THEN sha256(lft || folded || rgt) ELSE folded END AS folded, proof || lft || rgt AS proof)
    FROM {rows}_{k} a JOIN {tree}_{k} b ON a.g IS NOT DISTINCT FROM b.g AND a.i = b.i
)""")
    return ",\n".join(out)


def _manifest_sql(levels: int = 8, above: int = 4) -> str:
    """The manifest for groups of at most 8 to the power of ``levels`` rows and as many groups."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    names = ["doc_id", "source", "lang", "n_chars"]
    whole = " || ".join(map(field, [*names, "text"]))
    lower = " || ".join(map(field, [*names, "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"]))
    return f"""
WITH {_CRC_TABLE},
leaves AS (
    SELECT doc_id, lang AS g, sha256({whole}) AS h, CASE WHEN coalesce({_CRC} % 3 = 0, false) THEN sha256({lower}) ELSE sha256({whole}) END AS folded
    FROM (SELECT *, {_bytes_of("doc_id::VARCHAR")} AS b FROM documents), crc_table
), docs_0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, '' AS proof FROM leaves),
lang AS (SELECT g, i, h FROM docs_0),
{_levels("lang", levels)},
{_ways("docs", "lang", levels)},
tops AS (SELECT g AS name, any_value(up) AS h FROM lang_{levels - 1} GROUP BY g),
crown AS (SELECT 0 AS g, row_number() OVER (ORDER BY encode(name) NULLS FIRST) - 1 AS i, h, name FROM tops),
{_levels("crown", above)},
all_0 AS (SELECT d.* REPLACE (c.g AS g, c.i AS i), c.h AS subroot FROM docs_{levels} d JOIN crown c ON d.g IS NOT DISTINCT FROM c.name),
{_ways("all", "crown", above)}
SELECT doc_id, h AS leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM all_{above}, (SELECT any_value(up) AS root FROM crown_{above - 1})
"""


SQL: dict[str, str] = {
    "op12_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
    SELECT w, k, {_CRC} AS h FROM (SELECT w, k, {_bytes_of("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS b FROM runs), crc_table
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, sum(k)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING sum(k) >= 5 AND length(word) >= 6
), gaps AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
shorter AS (SELECT DISTINCT gaps.word AS long, words.word AS short FROM gaps JOIN words ON a || b = words.word),
near AS (
    SELECT x.word, y.word AS near FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter
), best AS (
    SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, near, w.n AS near_n
    FROM near JOIN words w ON w.word = near QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, encode(near)) = 1
), forms AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word
), chain AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.next
)
SELECT forms.*, root FROM forms JOIN chain ON chain.word = forms.word WHERE next IS NULL
""",
    "op13_merkle_manifest": _manifest_sql(),
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, w[i:i + least(10, len(w)) - 1] AS words, least(10, len(w)) AS n
    FROM b, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS t(i)
), sizes AS (SELECT DISTINCT n FROM win),
own AS (SELECT doc_id, i, n, w[i:i + n - 1] AS words FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
found AS (SELECT doc_id, i, own.n, item_id FROM own JOIN win ON own.words = win.words),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
""",
    "op4_substring_dedup": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, hash(w[i:i + 19]) AS h, md5(array_to_string(w[i:i + 19], ' ')) AS m FROM d, unnest(range(1, greatest(len(w) - 18, 1))) AS t(i)),
again AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY h, m ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM again, unnest(range(i, i + 20)) AS t(p)),
kept AS (
    SELECT d.doc_id, string_agg(w[p], ' ' ORDER BY p) AS words, count(*) AS n
    FROM d, unnest(range(1, len(w) + 1)) AS t(p) WHERE NOT EXISTS (FROM gone g WHERE g.doc_id = d.doc_id AND g.p = t.p) GROUP BY d.doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
""",
    "op10_warc": """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
    CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
""",
}
