"""Benchmark decontamination with one Aho-Corasick automaton over word numbers.

Questions and answers are normalised, cut into windows of ten words, and all windows of a shard go into one automaton
whose alphabet is the benchmark's own vocabulary. Each text is normalised and scanned once; hits are word positions,
and only texts with hits are tokenised again for their offsets in the original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, groups, held, small_batches, with_doc
from plumbline.session import stage

WINDOW = 10
# Words of benchmark text in one automaton; a larger benchmark is scanned shard by shard.
SHARD_WORDS = 1_000_000

# Letters in lower case, digits and bytes beyond ASCII stay; everything else parts words.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text."""
    return text.translate(_TABLE).split(b" ")


def _split(text: bytes) -> list[bytes]:
    return [w for w in words(text) if w]


class Matcher:
    """The automaton of one shard of (item id as text, text) rows."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _split(text)]
            for start in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                owners.setdefault(tuple(ids[start : start + WINDOW]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, names in owners.items():
            self.automaton.add_word(window, (len(window), sorted(names)))
        self.shortest = min(map(len, owners), default=0)
        if owners:
            self.automaton.make_automaton()

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Hit word ranges, merged, and the items with a window in the text."""
        if not self.shortest or len(text_words) < self.shortest:
            return [], []
        get = self.vocabulary.get
        ranges: list[list[int]] = []
        items: set[str] = set()
        for end, (size, names) in self.automaton.iter(tuple([get(w, 0) for w in text_words])):
            items.update(names)
            start = end - size + 1
            while ranges and ranges[-1][0] >= start:
                ranges.pop()
            if ranges and ranges[-1][1] >= start:
                ranges[-1][1] = end + 1
            else:
                ranges.append([start, end + 1])
        return [(a, b) for a, b in ranges], sorted(items)


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shared)
        for batch in groups(batches, "text", 4 << 20, keep=_OWN):
            counts, spans, items = [], [], []
            for text, before, found in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                own = _split(text)
                counts.append(len(own))
                ranges, names = matcher.scan(own)
                if ranges:
                    found = sorted({*found, *names})
                    at = [m.span() for m in _WORD.finditer(text.decode())]
                    before = _merged(before, [{"first": a, "last": b - 1, "start": at[a][0], "end": at[b - 1][1]} for a, b in ranges], at)
                spans.append(before)
                items.append(found)
            kept = [n for n in batch.schema.names if n not in ("n_words", "spans", "items")]
            schema = batch.schema
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(counts, pa.int64()), pa.array(spans, schema.field("spans").type), pa.array(items, schema.field("items").type)],
                names=[*kept, "n_words", "spans", "items"],
            )

    return run


def _merged(before: list[dict], more: list[dict], at: list[tuple[int, int]]) -> list[dict]:
    """Word ranges of an earlier shard and of this one, overlaps joined."""
    out: list[dict] = []
    for span in sorted([*before, *more], key=lambda s: (s["first"], s["last"])):
        if out and out[-1]["last"] >= span["first"]:
            last = max(out[-1]["last"], span["last"])
            out[-1] = out[-1] | {"last": last, "end": at[last][1]}
        else:
            out.append(span)
    return out


_OWN = "contamination"


def _matcher(shared) -> Matcher:
    """The automaton of a broadcast shard, kept in a Python worker from task to task."""
    items = shared.value
    return held(_OWN, items, lambda: Matcher(items))


def _shards(benchmark: DataFrame, shard_words: int) -> list[DataFrame]:
    """The benchmark in pieces of bounded size; one piece unless it outgrows the bound."""
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = named.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    n = 1 + size // (2 * shard_words)
    return [named if n == 1 else named.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def contaminated(docs: DataFrame, benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns) with ``text``, ``n_words``, ``spans`` and ``items``.

    ``spans`` are the hit passages as word ranges (first, last) and code point ranges (start, end) of the original
    text, in order, overlaps joined; ``items`` the ids, as text and sorted, of the benchmark items that have a window
    of ten words (all words of a shorter item) in the text. A null text has no words and no spans; items without
    words, null ones too, match nothing; an item given twice counts once; a null item id reads "null"; an empty
    benchmark matches nothing; rows of ``docs`` are judged one by one, repeated or not.
    Shards bound what is sent to the executors: each is collected with at most about ``shard_words`` words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    span = "struct<first: int, last: int, start: int, end: int>"
    state = docs.select(
        F.struct("*").alias("doc"), "text", F.lit(0).cast("long").alias("n_words"),
        F.array().cast(f"array<{span}>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    schema = with_doc(docs, f"text string, n_words long, spans array<{span}>, items array<string>")
    shards = _shards(benchmark, shard_words)
    for i, shard in enumerate(shards):
        if i:
            state = stage(state, "contamination")
        rows = [(r.item, r.text.encode()) for r in shard.distinct().collect()]
        state = state.mapInArrow(_scanner(spark.sparkContext.broadcast(rows)), schema)
    return state


def n_hit(spans: str = "spans"):
    """The number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``text`` by what is left of it around the spans."""
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            at, pieces = 0, []
            for s in spans:
                pieces.append(text[at : s["start"]])
                at = s["end"]
            texts.append("".join([*pieces, text[at:]]) if spans else text)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], names=["doc", "kept"])
