"""Removal of word windows that occur earlier in the corpus, by locally consistent recompression.

Two rounds name maximal runs and then left/right pairs of symbols. A name is a 64-bit hash of what it stands for, so
names are global without a dictionary, and equal passages get equal symbols everywhere but at their ends. A word gap
that survives both rounds is a *boundary*. Each window of words takes as its anchor the surviving gap, among those
whose ten-word context lies inside the window, with the smallest hash of that context; equal windows therefore take
equal anchors. Anchors, not words, are shuffled: one record per anchor carries the windows that chose it, the task
that receives an anchor sees every window of that content, and the first occurrence of each stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import NULL_ID, as_bytes, cut, from_planes, groups, id_key, mix, own_text, parts, planes, small_batches, with_doc

WINDOW = 20
CONTEXT = 10  # words around an anchor that choose it
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_SLOTS = WINDOW - CONTEXT + 1  # gaps of a window whose context lies inside it
_GROUP_BYTES = 6 << 20
_SEED, _LOW = 42, 0xFFFFFFFF  # Spark's xxhash64 has this seed
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xD1B54A32D192ED03)
_RUN = np.uint64(0x8CB92BA72F3D8DD7)
_TOP = np.uint64(1 << 63)
_ONE = np.uint64(1)


class _Names(dict):
    """Word hashes; emptied when a million words are held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def recompress(symbols: np.ndarray, docs: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: name runs, then pairs whose first symbol falls left and second right. Returns names and first positions."""
    n = len(symbols)
    if not n:
        return symbols, np.zeros(0, np.int64)
    same = (symbols[1:] == symbols[:-1]) & (docs[1:] == docs[:-1])
    at = np.flatnonzero(np.concatenate(([True], ~same)))
    length = np.diff(np.append(at, n)).astype(np.uint64)
    names, owner = symbols[at], docs[at]
    names = np.where(length > 1, mix(names + length * _RUN), names)
    right = (mix(names ^ np.uint64(salt)) & _ONE).astype(bool)
    pair = ~right[:-1] & right[1:] & (owner[:-1] == owner[1:])
    joined = names.copy()
    joined[:-1][pair] = mix(names[:-1][pair] * _PAIR + names[1:][pair])
    keep = np.concatenate(([True], ~pair))
    return joined[keep], at[keep]


def boundaries(words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Mask over gaps (gap i lies before word i): those that survive two rounds, or lie beside a repetition.

    Beside equal neighbours the extent of a run could reach out of a window; there every gap counts, so that the
    choice depends on nothing but the ten words around the gap.
    """
    n = len(words)
    mask = np.zeros(n + 1, bool)
    first, at1 = recompress(words, docs, 0x51ED270B)
    _, at2 = recompress(first, docs[at1], 0x2545F491)
    mask[at1[at2]] = True
    equal = first[1:] == first[:-1]  # symbol i and i + 1; the gap between them is before at1[i + 1]
    for shift in (-1, 0, 1):
        beside = np.flatnonzero(equal) + 1 + shift
        mask[at1[beside[(beside > 0) & (beside < len(at1))]]] = True
    half = CONTEXT // 2
    pairs = np.flatnonzero(words[1:] == words[:-1]) + 1
    for shift in range(-half + 1, half):
        near = pairs + shift
        mask[near[(near > 0) & (near < n)]] = True
    return mask


def _hash_words(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of each ten and each twenty words."""

    def step(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
        """Hashes of what ``left`` covers followed by the ``width`` words of ``right``."""
        return left * np.uint64(pow(int(_BASE), width, 1 << 64)) + right

    two = step(words[:-1], words[1:], 1)
    four = step(two[:-2], two[2:], 2)
    eight = step(four[:-4], four[4:], 4)
    sixteen = step(eight[:-8], eight[8:], 8)
    return step(eight[:-2], two[8:], 2), step(sixteen[:-4], four[16:], 4)


def anchored(words: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor records of a run of documents: anchor hash, first window, number of windows, and every window's hash."""
    empty = np.zeros(0, np.uint64)
    if len(words) < WINDOW:
        return empty, np.zeros(0, np.int64), np.zeros(0, np.int64), empty
    ten, twenty = _hash_words(words)
    ten = mix(ten)
    gaps = boundaries(words, docs)[CONTEXT // 2 : CONTEXT // 2 + len(ten)]
    order = (ten >> _ONE) | np.where(gaps, np.uint64(0), _TOP)
    chosen = np.lib.stride_tricks.sliding_window_view(order, _SLOTS).argmin(axis=1) + np.arange(len(twenty))
    inside = np.flatnonzero(docs[: len(twenty)] == docs[WINDOW - 1 :])
    if not len(inside):
        return empty, inside, inside, empty
    chosen = chosen[inside]
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (docs[inside[1:]] != docs[inside[:-1]])))
    at = np.flatnonzero(new)
    return ten[chosen[at]], inside[at], np.diff(np.append(at, len(inside))), mix(twenty[inside])


_MARKS = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])
_MARKS_SQL = "doc long, version long, first int, windows int"
_PACKED = pa.schema([("part", pa.int32()), ("records", pa.int32()), ("data", pa.binary()), *_MARKS])
_PACKED_SQL = f"part int, records int, data binary, {_MARKS_SQL}"


def _packer(n_parts: int):
    """Anchor records of each group of documents, packed by target part; repeats inside the group are marked at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _Names()
        for batch in groups(batches, "text", _GROUP_BYTES):
            ids = batch.column("doc").to_numpy()
            texts = as_bytes(batch.column("text"))
            split = [t.split() for t in texts]
            counts = np.fromiter(map(len, split), np.int64, len(split))
            version = np.fromiter((xxhash.xxh64_intdigest(t, _SEED) & _LOW for t in texts), np.int64, len(texts))
            # Documents in the order in which the first occurrence is judged.
            rank = np.lexsort((version, ids))
            split, counts, ids, version = [split[i] for i in rank], counts[rank], ids[rank], version[rank]
            words = np.fromiter((names[w] for ws in split for w in ws), np.uint64, int(counts.sum()))
            docs = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            begins = np.cumsum(counts) - counts
            del split, texts
            anchor, first, size, window = anchored(words, docs)
            if not len(anchor):
                continue
            start = np.cumsum(size) - size
            owner = docs[first]
            at = (first - begins[owner]).astype(np.int32)
            whole = mix(np.add.reduceat(window * (np.arange(len(window), dtype=np.uint64) * np.uint64(2) + _ONE - np.repeat(start, size).astype(np.uint64) * np.uint64(2)), start) + anchor + size.astype(np.uint64))
            _, lead, back = np.unique(whole, return_index=True, return_inverse=True)
            leader = lead[back]
            again = leader != np.arange(len(anchor))
            # A row given twice is one document: its second copy is not a repetition.
            twin = (ids[owner] == ids[owner[leader]]) & (version[owner] == version[owner[leader]]) & (at == at[leader])
            part = (anchor % np.uint64(n_parts)).astype(np.int32)
            m = np.flatnonzero(again & ~twin)
            if len(m):
                marks = (ids[owner[m]], version[owner[m]], at[m], size[m].astype(np.int32))
                # Marks only pass through the judging task, so they are dealt by document, not by a passage many share.
                dealt = (mix(ids[owner[m]].view(np.uint64) + at[m].astype(np.uint64)) % np.uint64(n_parts)).astype(np.int32)
                columns = [dealt, pa.nulls(len(m), pa.int32()), pa.nulls(len(m), pa.binary()), *marks]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _PACKED)], schema=_PACKED)
            held = np.flatnonzero(~again)
            held = held[np.argsort(part[held], kind="stable")]
            edges = np.append(cut(part[held]), len(held))
            low = window & np.uint64(0xFFFFFFFFFF)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                r = held[a:b]
                n = size[r]
                flat = np.repeat(start[r] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                short = np.ascontiguousarray(low[flat]).view(np.uint8).reshape(-1, 8)[:, :5]
                data = b"".join((
                    anchor[r].tobytes(), planes(ids[owner[r]]), version[owner[r]].astype(np.uint32).tobytes(), planes(at[r]),
                    n.astype(np.uint8).tobytes(), short.tobytes(),
                ))
                row = (int(part[r[0]]), len(r), data, None, None, None, None)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PACKED)], schema=_PACKED)

    return run


def _unpack(records: int, data: bytes) -> tuple[np.ndarray, ...]:
    at = 0

    def take(size: int) -> bytes:
        nonlocal at
        at += size
        return data[at - size : at]

    anchor = np.frombuffer(take(8 * records), np.uint64)
    ids = from_planes(take(8 * records), np.int64, records)
    version = np.frombuffer(take(4 * records), np.uint32).astype(np.int64)
    first = from_planes(take(4 * records), np.int32, records)
    size = np.frombuffer(take(records), np.uint8).astype(np.int64)
    wide = np.zeros((int(size.sum()), 8), np.uint8)
    wide[:, :5] = np.frombuffer(data[at:], np.uint8).reshape(-1, 5)
    return anchor, ids, version, first, size, wide.view(np.uint64).reshape(-1)


def _judge(pieces: list[tuple[int, bytes]]) -> pa.RecordBatch | None:
    """Every window of one part that also starts earlier, as runs of consecutive windows."""
    anchor, ids, version, first, size, window = (np.concatenate(x) for x in zip(*(_unpack(*p) for p in pieces)))
    begin = np.cumsum(size) - size
    order = np.lexsort((first, version, ids))
    n = size[order]
    record = np.repeat(order, n)
    step = np.arange(len(record)) - np.repeat(np.cumsum(n) - n, n)
    near, own_hash = anchor[record], window[begin[record] + step]
    doc, ver, pos = ids[record], version[record], first[record] + step.astype(np.int32)
    by = np.lexsort((own_hash, near))  # stable: earlier occurrences first
    head = np.union1d(cut(near[by]), cut(own_hash[by]))
    lead = np.empty(len(by), np.int64)
    lead[by] = np.repeat(by[head], np.diff(np.append(head, len(by))))
    own = (doc == doc[lead]) & (ver == ver[lead]) & (pos == pos[lead])
    hit = np.flatnonzero(~own)
    if not len(hit):
        return None
    doc, ver, pos = doc[hit], ver[hit], pos[hit]
    joined = (doc[1:] == doc[:-1]) & (ver[1:] == ver[:-1]) & (pos[1:] == pos[:-1] + 1)
    at = np.flatnonzero(np.concatenate(([True], ~joined)))
    run = np.diff(np.append(at, len(hit))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((doc[at], ver[at], pos[at], run), _MARKS)], schema=_MARKS)


def _judge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, pieces = None, []
    for batch in batches:
        packed = batch.filter(pc.is_valid(batch.column("data")))
        ready = batch.filter(pc.is_null(batch.column("data")))
        if ready.num_rows:
            yield ready.select(_MARKS.names)
        for p, records, data in zip(*(packed.column(c).to_pylist() for c in ("part", "records", "data"))):
            if p != part and pieces:
                if (out := _judge(pieces)) is not None:
                    yield out
                pieces = []
            part = p
            pieces.append((records, data))
    if pieces and (out := _judge(pieces)) is not None:
        yield out


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, version, first, windows): runs of windows of a document that also start earlier.

    ``doc`` is the id (null as the smallest long), ``version`` the low half of the text's hash, which tells apart
    different texts under one id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Several small parts to a task: a part is judged in memory, so its share of the corpus bounds the memory.
    source = docs.select(id_key().alias("doc"), "text").where(F.length("text") >= 2 * WINDOW - 1)
    packed = source.mapInArrow(_packer(4 * parts(spark)), _PACKED_SQL)
    return packed.repartition(parts(spark), "part").sortWithinPartitions("part").mapInArrow(_judge_parts, _MARKS_SQL)


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(own_text(batches), "text", 4 << 20):
        texts = batch.column("text").to_pylist()
        marks = batch.column("marks").to_pylist()
        kept, total, removed = [], [], []
        for text, runs in zip(texts, marks):
            if text is None or not runs:
                kept.append(text)
                total.append(len(text.encode().split()) if text else 0)
                removed.append(0)
                continue
            raw = text.encode()
            spans = np.array([m.span() for m in WORD.finditer(raw)], np.int64)
            gone = np.zeros(len(spans) + 1, np.int64)
            for r in runs:
                gone[r["first"]] += 1
                gone[r["first"] + r["windows"] + WINDOW - 1] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([False], ~gone, [False]))))
            # What stays keeps its own spacing; the white space before a removed run stays as the seam.
            pieces = [raw[spans[a][0] : spans[b][0] if b < len(spans) else len(raw)] for a, b in edges.reshape(-1, 2).tolist()]
            kept.append(b"".join(pieces).decode())
            total.append(len(spans))
            removed.append(int(gone.sum()))
        names = [f for f in batch.schema.names if f not in ("text", "marks")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
            names=[*names, "kept", "n_words", "n_removed"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns) with ``kept`` text, ``n_words`` and ``n_removed``.

    A word goes if a window of twenty words covering it also starts earlier: in a document with a smaller id, or
    earlier in the same one. Windows are judged on the input. A null text has no words and stays null; a null id
    sorts first; rows with one id and one text are one document and share their fate, rows with one id and different
    texts are ordered by text hash. What stays of a cut text keeps its own white space.
    """
    runs = repeated_windows(docs).groupBy(F.col("doc").alias("mark_id"), F.col("version").alias("mark_version"))
    marks = runs.agg(F.collect_list(F.struct("first", "windows")).alias("marks"))
    version = F.xxhash64("text").bitwiseAND(F.lit(_LOW))
    base = docs.select(F.struct("*").alias("doc"), id_key().alias("own_id"), version.alias("own_version"))
    same = (F.col("own_id") == F.col("mark_id")) & (F.col("own_version") == F.col("mark_version"))
    joined = base.join(marks, same, "left").select("doc", "marks")
    return joined.mapInArrow(_cutter, with_doc(docs, "kept string, n_words long, n_removed long"))
