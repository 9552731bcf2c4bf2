"""Document fingerprints by randomised edit embedding.

One random walk, shared by all texts, runs over the characters: at step j it puts out the character it stands on, and
a bit drawn for (j, character) says whether it moves on. Texts a few edits apart fall into step again after each edit,
so their edit distance becomes a Hamming distance of the outputs. A fingerprint samples the output at places shared by
all texts, on the scale next to the text's length and on the one above, so that it also compares with a text of up to
twice the length over all of that text.

The bits repeat every 64 steps, so the walk is an automaton with 64 states. A text is read by indexing state after
state, which Python does in C, and steps and samples are array operations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, groups, id_key, parts, small_batches, with_doc
from plumbline.llm.components import components
from plumbline.session import stage

PERIOD = 64
SAMPLES = 128  # per scale
BAND = 6  # samples in a band key
ALIKE = 0.8
# Prints under a band key that are compared with another at once; those already in its group are then left out.
BLOCK = 512

_PAD = ord("-")
_SYMBOLS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_DRAW = np.random.Generator(np.random.PCG64(20260101))

_MOVES = _DRAW.integers(0, 2, (PERIOD, 256)).astype(bool)
_MOVES[15::16] = True  # no character holds the walk for more than sixteen steps
_STEPS = np.ones((PERIOD, 256), np.int64)
for _ in range(16):
    _STEPS += np.take_along_axis(_MOVES, (np.arange(PERIOD)[:, None] + _STEPS - 1) % PERIOD, axis=0) == 0
_STATES: list[list] = [[] for _ in range(PERIOD)]
for _p, _state in enumerate(_STATES):
    _state.extend(_STATES[int(q)] for q in (_p + _STEPS[_p]) % PERIOD)
    _state.append(_p)
_AT = np.sort(_DRAW.random(SAMPLES))
_SALT = _DRAW.integers(1, 1 << 32, SAMPLES, dtype=np.uint64)


def classes(text: str) -> np.ndarray:
    """Characters as numbers below 256: ASCII as it is, others hashed."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points, 128 + ((points * np.uint32(2654435761)) >> np.uint32(25))).astype(np.uint8)


class Walk:
    """The walk over a text: which state each character is met in, and after how many steps."""

    def __init__(self, codes: np.ndarray, phases: np.ndarray | None = None):
        self.codes = codes
        self.phases = _phases(codes, 0) if phases is None else phases
        self.ends = np.cumsum(_STEPS[self.phases[:-1], codes])

    def spliced(self, keep: int, more: np.ndarray) -> Walk:
        """The walk over the first ``keep`` characters followed by ``more``; only the new part is walked."""
        tail = _phases(more, int(self.phases[keep]))
        return Walk(np.concatenate((self.codes[:keep], more)), np.concatenate((self.phases[:keep], tail)))

    def fingerprint(self) -> str:
        """Two digits of scale, the samples on the scale above, and those on it."""
        n = len(self.codes)
        scale = max(1, (max(1, n) - 1).bit_length())
        return f"{scale:02d}" + "".join(self._sample(s) for s in (scale + 1, scale))

    def _sample(self, scale: int) -> str:
        steps = (_AT * float(2 << scale)).astype(np.int64)
        where = np.searchsorted(self.ends, steps, side="right")
        inside = where < len(self.codes)
        seen = self.codes[np.minimum(where, max(0, len(self.codes) - 1))] if len(self.codes) else np.zeros(SAMPLES, np.uint8)
        mixed = ((seen.astype(np.uint64) + np.uint64(1)) * _SALT * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
        return np.where(inside, _SYMBOLS[mixed], _PAD).astype(np.uint8).tobytes().decode()


def _phases(codes: np.ndarray, start: int) -> np.ndarray:
    return np.fromiter(map(itemgetter(256), accumulate(codes.tobytes(), getitem, initial=_STATES[start])), np.uint8, len(codes) + 1)


def likeness(a: str, b: str) -> float:
    """Share of equal samples on the larger text's scale, its padding different; 1 for two empty texts, 0 without a scale."""
    if a == b:
        return 1.0
    p, q = int(a[:2]), int(b[:2])
    if abs(p - q) > 1:
        return 0.0
    scale = max(p, q)
    x, y = (np.frombuffer(f.encode(), np.uint8)[2 + SAMPLES * (own + 1 - scale) :][:SAMPLES] for f, own in ((a, p), (b, q)))
    any_ = (x != _PAD) | (y != _PAD)
    return float(((x == y) & any_).sum() / max(1, any_.sum()))


def _printer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "text", 8 << 20):
        prints = [Walk(classes(t or "")).fingerprint() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(prints, pa.string())], names=["doc", "print"])


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns) with ``print``; a null text counts as empty.

    Equal texts have equal fingerprints. Whole texts are walked; rows are read one by one, repeated or not.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.struct("*").alias("doc"), "text").mapInArrow(_printer, with_doc(docs, "print string"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of a part, in order, against the one that follows it; guests only follow."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    waiting = None
    for batch in groups(batches, "text", 4 << 20, 512):
        rows = []
        for part, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
            text = text or ""
            walk = Walk(classes(text))
            own = walk.fingerprint()
            if waiting is not None and waiting[0] == part:
                _, before_id, before, before_walk, before_print = waiting
                n = len(before)
                k = n // 3
                edited = before_walk.spliced(n - k, walk.codes[:k]).fingerprint()
                digest = hashlib.sha256((before[: n - k] + text[:k]).encode()).hexdigest()
                rows.append((before_id, n, digest, before_print, edited, likeness(before_print, edited), likeness(before_print, own)))
            waiting = None if guest else (part, doc_id, text, walk, own)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def against_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to each other and to the next document's.

    The order is descending doc_id (null last), then text hash; after the last comes the first, a single document
    follows itself. The edited text has its last third replaced by the beginning of the next document. Rows repeated
    are documents of their own.

    Ids are cut into ranges at quantiles. A range is one stretch of the order, and its last document finds the next
    one in a copy of the following range's first, so each text is shuffled once, and one text per range twice.
    """
    spark = docs.sparkSession
    small_batches(spark)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_key().alias("key"), F.xxhash64("text").alias("version"), "text")
    n = parts(spark)
    # Several ranges to a task, so that tasks which happen to get one more are not much longer.
    m = 4 * n
    bounds = named.approxQuantile("key", [i / m for i in range(1, m)], 0.25 / m)
    limits = sorted({int(b) for b in bounds})
    part = F.size(F.filter(F.array(*(F.lit(b).cast("long") for b in limits)), lambda b: b <= F.col("key"))) if limits else F.lit(0)
    placed = named.withColumn("part", part)
    # One row per range.
    heads = sorted(placed.groupBy("part").agg(F.max(F.struct("key", "version")).alias("h")).collect(), key=lambda r: -r.part)
    follow = [(h.h.key, h.h.version, heads[i - 1].part) for i, h in enumerate(heads)]
    guests = spark.createDataFrame(follow, "head long, head_version long, before int")
    both = placed.join(F.broadcast(guests), (F.col("key") == F.col("head")) & (F.col("version") == F.col("head_version")), "left")
    target = F.explode(F.filter(F.array(F.struct("part", F.lit(False).alias("guest")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("part"), F.lit(True).alias("guest")))), lambda x: x.isNotNull()))
    dealt = both.select("doc_id", "key", "version", "text", target.alias("to")).select("to.part", "to.guest", "doc_id", "key", "version", "text")
    ordered = dealt.repartition(n, "part").sortWithinPartitions("part", "guest", F.desc("key"), F.desc("version"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("part", "guest", "doc_id", "text").mapInArrow(_neighbours, schema)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, print): one key for each band of each scale that holds more than padding."""
    for batch in batches:
        keys, prints = [], []
        for p in batch.column("print").to_pylist():
            top = int(p[:2])
            for scale, at in ((top + 1, 2), (top, 2 + SAMPLES)):
                for band in range(0, SAMPLES - BAND + 1, BAND):
                    found = p[at + band : at + band + BAND]
                    if found != "-" * BAND:
                        keys.append(xxhash.xxh64_intdigest(f"{scale}/{band}/{found}"))
                        prints.append(p)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(prints, pa.string())], names=["key", "print"])


class _Held:
    """The prints of one key as rows, each with the number of its group so far."""

    def __init__(self):
        self.prints: list[str] = []
        self.rows, self.tops, self.label = np.empty((4, 2 * SAMPLES), np.uint8), np.empty(4, np.int64), np.empty(4, np.int64)

    def add(self, text: str, least: float, block: int) -> list[str]:
        """Add a print; returns prints it is alike, one of each group that holds such a print."""
        n = len(self.prints)
        if n == len(self.rows):
            self.rows, self.tops, self.label = (np.concatenate((x, np.empty_like(x))) for x in (self.rows, self.tops, self.label))
        top, row = int(text[:2]), np.frombuffer(text.encode(), np.uint8)[2:]
        out = []
        for start in range(0, n, block):
            at = np.arange(start, min(start + block, n))
            # What is in its group already adds nothing.
            at = at[self.label[at] != n]
            for step in (-1, 0, 1):
                same = at[self.tops[at] == top + step]
                if not len(same):
                    continue
                x = row[SAMPLES:] if step < 1 else row[:SAMPLES]
                y = self.rows[same, SAMPLES:] if step > -1 else self.rows[same, :SAMPLES]
                any_ = (y != _PAD) | (x != _PAD)
                near = ((y == x) & any_).sum(axis=1) / np.maximum(1, any_.sum(axis=1)) >= least
                for j in same[near].tolist():
                    if self.label[j] != n:
                        self.label[:n][self.label[:n] == self.label[j]] = n
                        out.append(self.prints[j])
        self.prints.append(text)
        self.rows[n], self.tops[n], self.label[n] = row, top, n
        return out


def _linker(least: float, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Verified links (a, b) that join the prints of a key as all its alike pairs do, not all pairs."""
        key, held = None, _Held()
        for batch in batches:
            a, b = [], []
            keys = batch.column("key").to_numpy()
            lone = np.zeros(len(keys), bool)
            heads = cut(keys)
            tails = np.append(heads[1:], len(keys))
            lone[heads[(tails - heads == 1) & (heads > 0) & (tails < len(keys))]] = True
            for k, p, skip in zip(keys.tolist(), batch.column("print").to_pylist(), lone.tolist()):
                if skip:
                    continue
                if k != key:
                    key, held = k, _Held()
                found = held.add(p, least, block)
                a += found
                b += [p] * len(found)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return run


def near_groups(docs: DataFrame, least: float = ALIKE, block: int = BLOCK) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns) with ``print`` and ``group``, equal for near duplicates.

    Prints are distinct first, so copies cost nothing. Prints that agree in all samples of a band are candidates and
    are linked if their likeness is ``least`` or more; a pair at 0.8 is a candidate with probability 0.99. Groups are
    what links reach; ``group`` is the smallest 64-bit hash of a print in it.
    """
    spark = docs.sparkSession
    named = stage(fingerprinted(docs), "edit-prints")
    distinct = named.select("print").distinct()
    keyed = distinct.repartition(parts(spark), "print").mapInArrow(_banded, "key long, print string")
    linked = keyed.repartition(parts(spark), "key").sortWithinPartitions("key", "print").mapInArrow(_linker(least, block), "a string, b string")
    roots = components(linked.distinct().select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")))
    joined = named.join(roots, F.xxhash64("print") == F.col("node"), "left")
    return joined.select("doc", "print", F.coalesce("root", F.xxhash64("print")).alias("group"))
