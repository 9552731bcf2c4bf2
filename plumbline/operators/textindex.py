"""Whole-row search through an index of trigrams: files that cannot hold a match are never opened."""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Sequence
from functools import reduce
from operator import or_
from re import _constants as op
from re import _parser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import frame_row_json
from plumbline.operators.profile import search_rows

# A pattern with more ways to match than this is searched by what all of them have in common.
WAYS = 64
ANYTHING: list[frozenset[str]] = [frozenset()]
# Classes inside classes and octal escapes mean different things to the two regex dialects.
_AMBIGUOUS = re.compile(r"\[[^\]]*(?<!\\)\[|\\0")


def ways_to_match(pattern: str) -> list[frozenset[str]]:
    """The trigrams a text needs to match, for each way to match; an empty set where a way needs none.

    Never more than the pattern demands: what cannot be read for certain demands nothing.
    """
    try:
        if _AMBIGUOUS.search(pattern):
            return ANYTHING
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            tree = _parser.parse(pattern)
    except (re.error, Warning, OverflowError, RecursionError):
        return ANYTHING
    if tree.state.flags & ~re.UNICODE:
        return ANYTHING
    return sorted({needed for needed, _ in _follow(tree, {(frozenset(), "")})}, key=sorted)


def _follow(nodes, states: set[tuple[frozenset[str], str]]) -> set[tuple[frozenset[str], str]]:
    """Extend (trigrams needed so far, literal text just before) by a sequence of pattern nodes."""

    def letter(states, c: str):
        out = set()
        for needed, tail in states:
            text = (tail + c)[-3:]
            out.add((needed | {text} if len(text) == 3 else needed, text[-2:]))
        return out

    def gap(states):
        return {(needed, "") for needed, _ in states}

    for kind, value in nodes:
        if kind is op.LITERAL:
            states = letter(states, chr(value))
        elif kind is op.IN and len(value) <= 4 and all(k is op.LITERAL for k, _ in value):
            states = set().union(*(letter(states, chr(v)) for _, v in value))
        elif kind is op.BRANCH:
            states = set().union(*(_follow(branch, states) for branch in value[1]))
        elif kind is op.SUBPATTERN and not value[1] and not value[2]:
            states = _follow(value[3], states)
        elif kind is op.ATOMIC_GROUP:
            states = _follow(value, states)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inner = value
            states = _follow(inner, states) if low else states
            states = states if low == high == 1 else gap(states)
        elif kind is not op.AT:
            states = gap(states)
        if len(states) > WAYS:
            states = {(frozenset.intersection(*(needed for needed, _ in states)), "")}
    return states


class TextIndex:
    """Which trigrams of the lower-cased row JSON occur in which file of a Parquet table.

    ``refresh`` reads only files it has not indexed yet. Its postings are written before the list of files they stand for, so a
    run that dies in between leaves postings nobody relies on. Searching is exact at any time: files without postings are
    read, files that are gone are not. Files must not be rewritten under their old name, and Spark never does so.
    Postings are sorted by trigram, so a lookup reads the row groups of the pattern's trigrams only; what comes to the
    driver are names of the table's own files, whose list it holds for every scan. Postings name a file by its hash, which is
    shorter; files of one hash would share their postings and be read together.
    """

    def __init__(self, spark: SparkSession, table: str, folder: str):
        self.spark, self.table, self.folder = spark, table, folder

    def _read(self, files: Sequence[str] | None = None) -> DataFrame:
        whole = self.spark.read.parquet(self.table)
        if files is None:
            return whole
        if not files:
            return whole.where(F.lit(False))
        return self.spark.read.schema(whole.schema).option("basePath", self.table).parquet(*files)

    def files(self) -> list[str]:
        """All files of the table."""
        return sorted(self._read().inputFiles())

    def _part(self, name: str, schema: str) -> DataFrame:
        """Postings or file list of all refreshes; empty before the first."""
        folder = f"{self.folder}/{name}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{folder}/*") if there else self.spark.createDataFrame([], schema)

    def indexed(self) -> set[str]:
        """Files with postings."""
        return {r.file for r in self._part("files", "file string").distinct().collect()}

    def refresh(self) -> int:
        """Index the files that are not indexed yet; returns how many these were."""
        known = self.indexed()
        new = [f for f in self.files() if f not in known]
        if not new:
            return 0
        rows = self._read(new)
        text = rows.select(F.xxhash64(F.input_file_name()).alias("file"), F.split(F.lower(frame_row_json(rows)), "").alias("c"))
        grams = F.transform(F.sequence(F.lit(1), F.size("c") - 2), lambda i: F.concat(F.get("c", i - 1), F.get("c", i), F.get("c", i + 1)))
        # A row names each trigram once and a task each pair once, so the shuffle carries files times trigrams, not text.
        pairs = text.where(F.size("c") >= 3).select("file", F.explode(F.array_distinct(grams)).alias("trigram")).distinct()
        run = uuid.uuid4().hex
        pairs.sort("trigram", "file").write.parquet(f"{self.folder}/postings/{run}")
        self.spark.createDataFrame([(f,) for f in new], "file string").write.parquet(f"{self.folder}/files/{run}")
        return len(new)

    def candidates(self, pattern: str) -> list[str]:
        """Files that may hold a match: those with all trigrams of one way to match it, and those not indexed."""
        files, ways = self.files(), ways_to_match(pattern)
        if not all(ways):
            return files
        wanted = sorted(frozenset.union(*ways))
        postings = self._part("postings", "file long, trigram string").where(F.col("trigram").isin(wanted))
        found = postings.groupBy("file").agg(F.collect_set("trigram").alias("has"))  # the pattern's trigrams at most
        met = [F.size(F.array_intersect("has", F.array(*map(F.lit, sorted(way))))) == len(way) for way in ways]
        hits = {r.file for r in found.where(reduce(or_, met)).select("file").collect()}
        known = {r.file: r.h for r in self._part("files", "file string").select("file", F.xxhash64("file").alias("h")).collect()}
        return [f for f in files if f not in known or known[f] in hits]

    def search(self, pattern: str, out: str = "registro", keep: Sequence[str] = ()) -> DataFrame:
        """As :func:`search_rows` on the whole table."""
        return search_rows(self._read(self.candidates(pattern)), pattern, out, keep)
