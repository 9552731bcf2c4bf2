"""Near duplicates by SimHash and Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The perfect binary Golay code assigns to each 23-bit
word the one codeword within three bits, so a segment has a 12-bit index; the indices of a segment and of its 23
neighbours (one or six different ones) contain the index of every segment one bit away. Three errors over three
segments leave, by pigeonhole, either one segment exact and another with one error at most, or one error in each.
The first case is found with (exact segment, index) keys, the second with keys of three indices. Fingerprints that
share a key are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, cut, groups, id_key, parts, small_batches
from plumbline.llm.components import components
from plumbline.session import stage

SHINGLE = 3
RADIUS = 3
# A key shared by more fingerprints than this is not compared pairwise but through common neighbours.
BLOCK = 2048

_WIDTHS = (23, 23, 18)
_GENERATOR = 0b101011100011  # fixed value: a generator polynomial of the binary Golay code of length 23
_SEED = 42
_STEP = 1 << 18


def fingerprint(text: bytes) -> int:
    """SimHash over the word shingles of a text, repeats included; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), _SEED)
    total = len(words) - SHINGLE + 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, total, _STEP):
        b = min(a + _STEP, total)
        spans = zip(starts[a:b].tolist(), (ends[a + SHINGLE - 1 : b + SHINGLE - 1] - 1).tolist())
        hashes = np.fromiter((digest(joined[i:j], _SEED) for i, j in spans), np.uint64, b - a)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "text", 8 << 20):
        prints = np.array([fingerprint(t) for t in as_bytes(batch.column("text"))], np.uint64).view(np.int64)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(prints)], names=[*names, "print"])


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where((rest >> bit) & 1, _GENERATOR << (bit - 11), 0)
    return rest


def _corrections() -> np.ndarray:
    """The error pattern of at most three bits behind each syndrome: the code is perfect, so there is exactly one."""
    ones = np.int64(1) << np.arange(23, dtype=np.int64)
    two = (ones[:, None] | ones).reshape(-1)
    patterns = np.unique(np.concatenate(([0], (two[:, None] | ones).reshape(-1))))
    table = np.zeros(2048, np.int64)
    table[_syndromes(patterns)] = patterns
    return table


_FIX = _corrections()


def index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    return (words ^ _FIX[_syndromes(words)]) >> 11


def near_indices(words: np.ndarray) -> np.ndarray:
    """Indices of each word's ball of radius one, a column each; a repeated index is -1."""
    balls = words[:, None] ^ np.concatenate(([0], np.int64(1) << np.arange(23, dtype=np.int64)))
    found = np.sort(index(balls.reshape(-1)).reshape(balls.shape), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    found = -np.sort(-found, axis=1)
    return found[:, :6]


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs such that prints within three bits of each other share a key."""
    bits = prints.view(np.uint64)
    segment, shift = [], 0
    for width in _WIDTHS:
        segment.append(((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    own = [index(s) for s in segment]
    near = [near_indices(s) for s in segment]
    row = np.arange(len(prints))
    rows, found = [], []

    def add(tag: int, columns: list[np.ndarray]) -> None:
        """Keys from columns of alternatives; -1 is no alternative."""
        key = np.full((len(prints), 1), tag, np.int64)
        for c, bits_ in columns:
            c = c.reshape(len(prints), -1)
            wide = (key[:, :, None] << bits_) | c[:, None, :]
            key = np.where((key[:, :, None] < 0) | (c[:, None, :] < 0), -1, wide).reshape(len(prints), -1)
        good = key >= 0
        rows.append(np.broadcast_to(row[:, None], key.shape)[good])
        found.append(key[good])

    for tag, (exact, loose) in enumerate(((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)), 1):
        # The near indices contain the own index, so one list serves both sides.
        add(tag, [(segment[exact], _WIDTHS[exact]), (near[loose], 12)])
    # One error in each segment: one side varies the first segment, the other side the other two.
    add(7, [(near[0], 12), (own[1], 12), (own[2], 12)])
    add(7, [(own[0], 12), (near[1], 12), (near[2], 12)])
    rows_, keys_ = np.concatenate(rows), np.concatenate(found)
    both = np.unique(np.stack((rows_, keys_), axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            prints = batch.column("print").slice(start, 4096).to_numpy()
            row, key = keys(prints)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(prints[row])], names=["key", "print"])


def _forest(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the prints of a block as their pairs within the radius do, one for each print at most."""
    bits = prints.view(np.uint64)
    label = np.arange(len(bits))
    links = []
    for i in range(len(bits) - 1):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= RADIUS) + i + 1
        for j in near[label[near] != label[i]].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                links.append((i, j))
    return links


def _linker(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (a, b) inside each key, or (a, null) for every print of a key over the block size."""
        key, held, over = None, [], False

        def close() -> tuple[list, list]:
            if over or len(held) < 2:
                return [], []
            p = np.array(held, np.int64)
            pairs = _forest(p)
            return [int(p[i]) for i, _ in pairs], [int(p[j]) for _, j in pairs]

        for batch in batches:
            ks, ps = batch.column("key").to_numpy(), batch.column("print").to_numpy()
            heads = cut(ks)
            tails = np.append(heads[1:], len(ks))
            # Keys of one print say nothing; the first and last of a batch may go on in another.
            many = (tails - heads > 1) | (heads == 0) | (tails == len(ks))
            a, b = [], []
            for s, e in zip(heads[many].tolist(), tails[many].tolist()):
                if ks[s] != key:
                    x, y = close()
                    a += x
                    b += y
                    key, held, over = ks[s], [], False
                held += ps[s:e].tolist()
                if over or len(held) > block:
                    over = True
                    a += held
                    b += [None] * len(held)
                    held = []
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        a, b = close()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(common, print, inner): every word within one bit (inner) or two bits of each print."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    masks = np.concatenate((np.zeros(1, np.uint64), one, one[i] | one[j]))
    inner = np.arange(len(masks)) < 65
    for batch in batches:
        prints = batch.column("print").to_numpy()
        for s in range(0, len(prints), 16):
            p = prints[s : s + 16]
            common = (p.view(np.uint64)[:, None] ^ masks).reshape(-1).view(np.int64)
            arrays = [pa.array(common), pa.array(np.repeat(p, len(masks))), pa.array(np.tile(inner, len(p)))]
            yield pa.RecordBatch.from_arrays(arrays, names=["common", "print", "inner"])


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between different prints (column ``print``) with the same reachability as all pairs within the radius.

    Keys with more than ``block`` prints are resolved without pairs: two prints are within three bits if and only if
    some word is one bit from one of them and two bits at most from the other, so each word with an inner print links
    all its prints to that one. That costs 2,081 rows for each such print, never a square.
    """
    spark = prints.sparkSession
    # Prints are few bytes each but give some 65 keys, so they are dealt to as many tasks as their keys will need.
    keyed = prints.repartition(parts(spark), "print").mapInArrow(_keyed, "key long, print long")
    found = stage(
        keyed.repartition(parts(spark), "key").sortWithinPartitions("key").mapInArrow(_linker(block), "a long, b long").distinct(),
        "simhash-links",
    )
    crowded = found.where("b is null").select(F.col("a").alias("print"))
    common = crowded.mapInArrow(_balls, "common long, print long, inner boolean")
    centre = common.where("inner").groupBy(F.col("common").alias("at")).agg(F.min("print").alias("a"))
    by_centre = common.join(centre, F.col("common") == F.col("at")).where("a <> print").select("a", F.col("print").alias("b"))
    return found.where("b is not null").unionAll(by_centre.distinct())


def _labelled(printed: DataFrame, light: DataFrame, block: int) -> DataFrame:
    """Adds ``component_id`` and ``root`` to ``printed``, given the (id, print) pairs of all documents."""
    # What follows works on different fingerprints.
    distinct = stage(light.groupBy("print").agg(F.min("id").alias("least")), "simhash-prints")
    roots = components(links(distinct.select("print"), block))
    group = distinct.join(roots, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    first = group.groupBy("root").agg(F.min("least").alias("component_id"))
    named = group.join(first, "root").select(F.col("print").alias("of"), "component_id", "root")
    return printed.join(named, F.col("print") == F.col("of")).drop("of")


def _printed(docs: DataFrame) -> DataFrame:
    """(doc_id, id, version, print) of each row, written to the shared folder: fingerprints are the costly part."""
    small_batches(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_key().alias("id"), F.xxhash64("text").alias("version"), "text")
    return stage(named.mapInArrow(_fingerprints, "doc_id long, id long, version long, print long"), "simhash-documents")


def duplicate_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, id, version, print, component_id, root) for each row of ``docs``.

    Documents whose fingerprints differ in three bits at most are linked; ``component_id`` is the smallest doc_id
    reachable over links, the document's own included. A null text has no words; texts without words have fingerprint
    zero and are linked like any other; a null id counts as the smallest long (``id`` is the id so read, ``version``
    the text's hash); repeated rows are each returned. ``root``, a fingerprint, tells apart groups whose smallest id
    is the same. Pairs are sought between different fingerprints only, so
    copies cost nothing there.
    """
    light = _printed(docs)
    return _labelled(light, light, block)


def representatives(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does: that with the smallest id.

    Of rows that share this id, repeated ones among them, the one with the smallest text hash stays.
    """
    named = stage(duplicate_groups(docs, block).select("id", "version", "component_id", "root"), "simhash-groups")
    first = named.where("id = component_id")
    ids = {"own_id": id_key(), "own_version": F.xxhash64("text")}
    keyed = docs.select(F.struct("*").alias("doc"), *(c.alias(n) for n, c in ids.items()))
    same = (F.col("own_id") == F.col("id")) & (F.col("own_version") == F.col("version"))
    kept = keyed.join(named.where("id <> component_id").select("id", "version").distinct(), same, "left_anti")
    twins = first.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    if not twins.isEmpty():
        tied = first.join(twins, "root", "left_semi").distinct()
        alone = kept.join(tied, same, "left_anti")
        order = Window.partitionBy("root").orderBy("own_version")
        one = kept.join(tied, same).withColumn("place", F.row_number().over(order)).where("place = 1")
        kept = alone.select("doc").unionAll(one.select("doc"))
    return kept.select("doc.*")
