"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Stands for a null document id wherever ids are compared or packed: it sorts before every other id.
NULL_ID = -(2**63)

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for; it is set with the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in Arrow batches of a few megabytes.

    Whole documents are wide rows, and a task holds a batch several times over (in the JVM, as Arrow, as Python
    objects); a worker keeps the memory of its largest batch as long as it lives.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def id_key(column: str = "doc_id") -> Column:
    """The document id as a long that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def with_doc(docs: DataFrame, more: str) -> StructType:
    """A schema of ``doc``, holding all columns of ``docs``, and further columns; no name of theirs can clash."""
    return StructType([StructField("doc", docs.schema), *StructType.fromDDL(more).fields])


def own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the text inside ``doc`` as a column ``text`` too, so that it crosses to Python once."""
    for batch in batches:
        yield batch.append_column("text", batch.column("doc").field("text"))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


# What this worker keeps for its next tasks, by operator: a key, and what was made for it.
_HELD: dict[str, tuple] = {}


def held(operator: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for the worker's next tasks of this operator until another operator's task begins."""
    if operator not in _HELD or _HELD[operator][0] != key:
        _HELD[operator] = key, make()
    return _HELD[operator][1]


def release(keep: str | None = None) -> None:
    """Drop what other operators than ``keep`` held, and give back to the system what is free.

    A worker lives on for other tasks and stages, beside other workers of its executor.
    """
    for operator in [o for o in _HELD if o != keep]:
        del _HELD[operator]
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


def groups(batches: Iterator[pa.RecordBatch], column: str, limit: int, rows: int = 4096, keep: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of at most about ``limit`` bytes of ``column`` (one row at least), nulls as empty.

    ``keep`` names the operator if it holds something; see :func:`release`.
    """
    release(keep)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(offsets(batch.column(column)))
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and (held + size > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
        del batch
    release(keep)


def offsets(array: pa.Array) -> np.ndarray:
    """The value offsets of a string or binary array."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    return np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def ids_of_lists(lists: pa.ListArray, look: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each list's strings, one list after the other, and the offsets of the lists.

    ``look`` gets the different strings and gives the ids of each as 32-bit integers.
    """
    named = lists.values.dictionary_encode()
    ids = look(named.dictionary.to_pylist())
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    of = named.indices.to_numpy()
    flat = np.frombuffer(b"".join(ids), "<i4")[ranges((np.cumsum(sizes) - sizes)[of], sizes[of])]
    return flat, np.concatenate(([0], np.cumsum(sizes[of])))[offsets(lists)]


def as_bytes(array: pa.Array) -> list[bytes]:
    """The values as UTF-8 bytes, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [x or b"" for x in array.cast(kind).to_pylist()]


def planes(values: np.ndarray) -> bytes:
    """Fixed-width numbers by byte position, so that the shuffle's compressor finds their constant high bytes."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type, count: int) -> np.ndarray:
    """The inverse of :func:`planes`."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, count).T).view(kind).reshape(-1)


def cut(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted or grouped array."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
