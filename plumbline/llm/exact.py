"""Removal of byte strings that occur more than once in the corpus, found with suffix arrays.

Every 400-byte window takes as its anchor the 64-byte string in it with the smallest hash, so equal windows have equal
anchors. Consecutive windows with one anchor are a *stretch*. Stretches are dealt by anchor: equal ones are repeated as
a whole, and where one anchor has several different stretches their bytes are fetched and compared by suffix array.
There, bytes are cut into chunks at fixed byte values, which keeps the order of suffixes that begin at chunks; windows
that end alike are neighbours in it and differ at most in the piece before their first chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, cut, from_planes, groups, id_key, mix, parts, planes, small_batches, with_doc
from plumbline.llm.suffixes import suffix_array
from plumbline.session import stage

WINDOW = 400
GRAM = 64
# An anchor with more different stretches than this is resolved by window hashes spread over all tasks.
CROWD = 10_000

_SLOTS = WINDOW - GRAM + 1
_GROUP_BYTES = 3 << 20
_BATCH_BYTES = 1 << 19
_PLACE = np.uint64(23)  # bits that hold a place in a group of documents
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_SEED = 42  # that of Spark's xxhash64
# Byte values that end a chunk: white space and one in eight others.
_ENDS = (_VALUES % np.uint64(8) == 0) | np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps)


class Rolling:
    """Hashes of any substrings of an array of bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def windows(self, size: int) -> np.ndarray:
        return (self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n, done = len(values) - width + 1, 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:n], values[width - done : width - done + n])


def stretches(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, first window, number of windows, content hash, and whether the anchor occurs twice in a window."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none.astype(bool)
    rolling = Rolling(data)
    gram = mix(rolling.windows(GRAM))
    places = np.arange(len(gram), dtype=np.uint64)
    low = np.uint64((1 << int(_PLACE)) - 1)
    left = _least((gram & ~low) | places, _SLOTS)
    right = _least((gram & ~low) | (low - places), _SLOTS)
    inside = np.flatnonzero(docs[: len(left)] == docs[WINDOW - 1 :])
    if not len(inside):
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none.astype(bool)
    at = (left[inside] & low).astype(np.int64)
    twice = at != (low - (right[inside] & low)).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (docs[inside[1:]] != docs[inside[:-1]])))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(inside)))
    begin = inside[first]
    content = mix(rolling.hash(begin, begin + count + WINDOW - 1) + count.astype(np.uint64))
    return gram[at[first]], begin, count, content, np.logical_or.reduceat(twice, first)


_FOUND = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("first", pa.int32()), ("windows", pa.int32()), ("anchor", pa.int64()), ("known", pa.bool_())])
_FOUND_SQL = "doc long, version long, first int, windows int, anchor long, known boolean"
_PACKED = pa.schema([("part", pa.int32()), ("records", pa.int32()), ("data", pa.binary()), *_FOUND])


def _packer(n_parts: int):
    """Stretches of each group of documents by target part; those equal inside the group are marked at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "text", _GROUP_BYTES):
            texts = as_bytes(batch.column("text"))
            # A text too long for the places is taken in pieces that overlap by all but one byte of a window.
            for pieces in _fitting(batch.column("doc").to_pylist(), texts):
                yield from _pack(pieces, n_parts)

    return run


def _fitting(ids: list[int], texts: list[bytes]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    most = 1 << 22
    held: list[tuple[int, int, int, bytes]] = []
    for doc, text in zip(ids, texts):
        version = xxhash.xxh64_intdigest(text, _SEED)
        version -= (version >> 63) << 64
        if len(text) <= most:
            held.append((doc, version, 0, text))
            continue
        for at in range(0, len(text) - WINDOW + 1, most - WINDOW + 1):
            yield [(doc, version, at, text[at : at + most])]
    if held:
        yield held


def _pack(pieces: list[tuple[int, int, int, bytes]], n_parts: int) -> Iterator[pa.RecordBatch]:
    ids, version, base = (np.array(x, np.int64) for x in list(zip(*pieces))[:3])
    length = np.array([len(p[3]) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
    docs = np.repeat(np.arange(len(pieces), dtype=np.int32), length)
    anchor, begin, count, content, twice = stretches(data, docs)
    if not len(anchor):
        return
    owner = docs[begin]
    first = (begin - (np.cumsum(length) - length)[owner] + base[owner]).astype(np.int32)
    key = mix(anchor ^ content * np.uint64(_BASE))
    _, lead, back, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    several = times[back] > 1
    part = (anchor % np.uint64(n_parts)).astype(np.int32)
    m = np.flatnonzero(several)
    if len(m):
        # These only pass through, so they are dealt by document.
        dealt = (mix(ids[owner[m]].view(np.uint64) + first[m].astype(np.uint64)) % np.uint64(n_parts)).astype(np.int32)
        nothing = [pa.nulls(len(m), k) for k in (pa.int32(), pa.binary())]
        columns = [dealt, *nothing, ids[owner[m]], version[owner[m]], first[m], count[m].astype(np.int32), pa.nulls(len(m), pa.int64()), np.ones(len(m), bool)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED)], schema=_PACKED)
    held = np.sort(lead)
    held = held[np.argsort(part[held], kind="stable")]
    edges = np.append(cut(part[held]), len(held))
    flags = several.astype(np.uint8) + 2 * twice.astype(np.uint8)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        r = held[a:b]
        packed = b"".join((
            anchor[r].tobytes(), content[r].tobytes(), planes(ids[owner[r]]), version[owner[r]].tobytes(), planes(first[r]), planes(count[r].astype(np.int32)), flags[r].tobytes(),
        ))
        row = (int(part[r[0]]), len(r), packed, None, None, None, None, None, None)
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PACKED)], schema=_PACKED)


def _unpack(n: int, data: bytes) -> tuple[np.ndarray, ...]:
    at = iter(np.cumsum([0, 8 * n, 8 * n, 8 * n, 8 * n, 4 * n, 4 * n, n]).tolist())
    edges = list(at)
    a, c, i, v, f, w, g = (data[x:y] for x, y in zip(edges, edges[1:]))
    return (
        np.frombuffer(a, np.uint64), np.frombuffer(c, np.uint64), from_planes(i, np.int64, n), np.frombuffer(v, np.int64),
        from_planes(f, np.int32, n), from_planes(w, np.int32, n), np.frombuffer(g, np.uint8),
    )


def _judge(pieces: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Stretches repeated as a whole (known), and one of each content whose anchor has others to compare with."""
    anchor, content, ids, version, first, count, flags = (np.concatenate(x) for x in zip(*(_unpack(*p) for p in pieces)))
    order = np.lexsort((first, version, ids, content, anchor))
    anchor, content, ids, version, first, count, flags = (x[order] for x in (anchor, content, ids, version, first, count, flags))
    n = len(anchor)
    alike = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))))
    times = np.diff(np.append(alike, n))
    whole = (times > 1) | (np.add.reduceat(flags & 1, alike) > 0)
    same = cut(anchor[alike])
    kinds = np.repeat(np.diff(np.append(same, len(alike))), np.diff(np.append(same, len(alike))))
    periodic = flags[alike] > 1
    asked = alike[(kinds > 1) | (periodic & ~whole)]
    marked = np.flatnonzero(np.repeat(whole, times))
    known = np.zeros(n, bool)
    known[marked] = True
    for rows, anchors in ((marked, False), (asked, True)):
        if len(rows):
            names = pa.array(anchor[rows].view(np.int64)) if anchors else pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(x[rows]) for x in (ids, version, first, count)), names, pa.array(known[rows])], schema=_FOUND)


def _judge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, pieces = None, []
    for batch in batches:
        ready = batch.filter(pc.is_null(batch.column("data")))
        if ready.num_rows:
            yield ready.select(_FOUND.names)
        packed = batch.filter(pc.is_valid(batch.column("data")))
        for p, records, data in zip(*(packed.column(c).to_pylist() for c in ("part", "records", "data"))):
            if p != part and pieces:
                yield from _judge(pieces)
                pieces = []
            part = p
            pieces.append((records, data))
    if pieces:
        yield from _judge(pieces)


_CONTEXT = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("first", pa.int32()), ("bytes", pa.binary())])
_CONTEXT_SQL = "anchor long, doc long, version long, first int, bytes binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches asked for."""
    for batch in groups(batches, "text", 4 << 20):
        out = []
        columns = [batch.column(n).to_pylist() for n in ("doc", "version", "asked")]
        for text, doc, version, asked in zip(as_bytes(batch.column("text")), *columns):
            out += [(a["anchor"], doc, version, a["first"], text[a["first"] : a["first"] + a["windows"] + WINDOW - 1]) for a in asked]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _CONTEXT)], schema=_CONTEXT)


def repeated_starts(contexts: list[bytes]) -> list[np.ndarray]:
    """For each context, the starts of its windows that start elsewhere in it or in another one too."""
    lengths = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    rolling = Rolling(data)
    ends = np.cumsum(lengths)
    stop = _ENDS[data].copy()
    stop[ends - 1] = True
    close = np.flatnonzero(stop) + 1  # chunk ends
    open_ = np.concatenate(([0], close[:-1]))
    owner = np.searchsorted(ends, open_, side="right")
    raw = data.tobytes()
    chunks = [raw[a:b] for a, b in zip(open_.tolist(), close.tolist())]
    rank = {c: i for i, c in enumerate(sorted(set(chunks)), 2)}
    last = np.concatenate((owner[1:] != owner[:-1], [True])).tolist()
    symbols, at = [], []
    for k, (c, end) in enumerate(zip(chunks, last)):
        symbols.append(rank[c])
        at.append(k)
        if end:  # contexts are parted by a symbol below all chunks
            symbols.append(1)
            at.append(-1)
    at = np.array(at, np.int64)[np.array(suffix_array(symbols), np.int64)]
    at = at[at >= 0]
    at = at[open_[at] > (ends - lengths)[owner[at]]]
    edge, previous = open_[at], open_[at - 1]
    most = ends[owner[at]] - WINDOW  # the last start of a whole window
    hit = np.zeros(len(data) + 1, bool)
    # A window is told by the first chunk that begins inside it and the piece of the chunk before, at least one byte.
    for back in range(1, min(int((edge - previous).max(initial=0)), WINDOW - 1) + 1):
        ok = np.flatnonzero((edge - back >= previous) & (edge - back <= most))
        e = edge[ok]
        tail = rolling.hash(e, e + WINDOW - back)
        # Suffixes with equal beginnings are neighbours; among them the pieces before the chunk must be equal too.
        klass = np.cumsum(np.concatenate(([False], tail[1:] != tail[:-1]))) if len(ok) else ok
        front = rolling.hash(e - back, e)
        by = np.lexsort((front, klass))
        alike = (klass[by][1:] == klass[by][:-1]) & (front[by][1:] == front[by][:-1])
        if len(ok):
            hit[e[by][np.concatenate(([False], alike)) | np.concatenate((alike, [False]))] - back] = True
    # Windows inside one chunk, in text without the byte values that end chunks.
    wide = np.flatnonzero(close - open_ >= WINDOW)
    if len(wide):
        inner = np.concatenate([np.arange(a, b - WINDOW + 1) for a, b in zip(open_[wide].tolist(), close[wide].tolist())])
        _, back_, times = np.unique(rolling.hash(inner, inner + WINDOW), return_inverse=True, return_counts=True)
        hit[inner[times[back_] > 1]] = True
    return [np.flatnonzero(hit[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers: first and length."""
    at = np.flatnonzero(np.concatenate(([True], starts[1:] != starts[:-1] + 1)))
    return starts[at], np.diff(np.append(at, len(starts)))


_RESOLVED = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("first", pa.int32()), ("windows", pa.int32()), ("key", pa.int64())])
_RESOLVED_SQL = "doc long, version long, first int, windows int, key long"


def _resolver(crowd: int):
    """Repeated windows among the contexts of each anchor; of crowded anchors every window with its hash as key."""

    def resolve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for (_, doc, version, first, _), starts in zip(rows, repeated_starts([r[4] for r in rows])):
            if len(starts):
                a, n = _runs(starts)
                out += [(doc, version, first + x, y, None) for x, y in zip(a.tolist(), n.tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESOLVED)], schema=_RESOLVED)

    def spread(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for anchor, doc, version, first, data in rows:
            keys = mix(Rolling(np.frombuffer(data, np.uint8)).windows(WINDOW) ^ np.uint64(anchor & (1 << 64) - 1)).view(np.int64)
            n = len(keys)
            columns = [np.full(n, doc), np.full(n, version), first + np.arange(n), np.ones(n, int), keys]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESOLVED)], schema=_RESOLVED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []  # whole groups
        own: list[tuple] = []  # the group being read
        crowded, held = False, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if own and own[0][0] != row[0] or crowded and crowded_by != row[0]:
                    ready += own
                    own, crowded = [], False
                    if held > _BATCH_BYTES:
                        yield from resolve(ready)
                        ready, held = [], 0
                if crowded:
                    yield from spread([row])
                    continue
                own.append(row)
                held += len(row[4])
                if len(own) > crowd:
                    yield from spread(own)
                    crowded, crowded_by = True, row[0]
                    held -= sum(len(r[4]) for r in own)
                    own = []
        if ready or own:
            yield from resolve(ready + own)

    return run


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "text", 4 << 20):
        kept, spans, sizes = [], [], []
        for text, marks in zip(as_bytes(batch.column("text")), batch.column("marks").to_pylist()):
            sizes.append(len(text))
            if not marks:
                kept.append(text)
                spans.append(0)
                continue
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, [m["first"] for m in marks], 1)
            np.add.at(edge, [m["first"] + m["windows"] + WINDOW - 1 for m in marks], -1)
            gone = np.cumsum(edge)[:-1] > 0
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            spans.append(int((np.diff(np.concatenate(([False], gone)).astype(np.int8)) == 1).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(kept, pa.binary()), pa.array(spans, pa.int64()), pa.array(sizes, pa.int64())], names=["doc", "kept", "n_spans", "n_bytes"])


def repeated_strings(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc, version, first, windows): runs of windows of a document, by byte, whose strings also start elsewhere."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(id_key().alias("doc"), F.xxhash64("text").alias("version"), "text").where(F.octet_length("text") >= WINDOW)
    packed = source.select("doc", "text").mapInArrow(_packer(4 * parts(spark)), f"part int, records int, data binary, {_FOUND_SQL}")
    judged = packed.repartition(parts(spark), "part").sortWithinPartitions("part").mapInArrow(_judge_parts, _FOUND_SQL)
    found = stage(judged, "exact-stretches")
    asked = found.where("anchor is not null").groupBy(F.col("doc").alias("ask_doc"), F.col("version").alias("ask_version"))
    asked = asked.agg(F.collect_set(F.struct("anchor", "first", "windows")).alias("asked"))
    same = (F.col("doc") == F.col("ask_doc")) & (F.col("version") == F.col("ask_version"))
    contexts = source.join(asked, same).select("doc", "version", "asked", "text").mapInArrow(_fetch, _CONTEXT_SQL)
    resolved = contexts.repartition(parts(spark), "anchor").sortWithinPartitions("anchor").mapInArrow(_resolver(crowd), _RESOLVED_SQL)
    resolved = stage(resolved, "exact-resolved")
    single = resolved.where("key is not null")
    several = single.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n")).where("n > 1")
    names = ["doc", "version", "first", "windows"]
    return found.where("anchor is null").select(*names).unionAll(resolved.where("key is null").select(*names)).unionAll(
        single.join(several, F.col("key") == F.col("of")).select(*names)
    )


def remove_repeated_strings(docs: DataFrame, crowd: int = CROWD, keep_text: bool = True) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns, or of ``doc_id``) with ``n_bytes``, ``kept`` bytes and ``n_spans``.

    A byte goes if a string of 400 bytes covering it also starts anywhere else, in the same document or in another
    row; all copies go, the first too. Overlaps count, strings never cross documents and are judged on the input. A
    null text is empty; a null id is as good as any; rows given twice are copies of each other.
    """
    marks = repeated_strings(docs, crowd).groupBy(F.col("doc").alias("mark_doc"), F.col("version").alias("mark_version"))
    marks = marks.agg(F.collect_list(F.struct("first", "windows")).alias("marks"))
    row = F.struct("*") if keep_text else F.struct("doc_id")
    base = docs.select(row.alias("doc"), id_key().alias("own_id"), F.xxhash64("text").alias("own_version"), "text")
    same = (F.col("own_id") == F.col("mark_doc")) & (F.col("own_version") == F.col("mark_version"))
    schema = with_doc(docs if keep_text else docs.select("doc_id"), "kept binary, n_spans long, n_bytes long")
    return base.join(marks, same, "left").select("doc", "text", "marks").mapInArrow(_cutter, schema)
