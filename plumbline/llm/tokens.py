"""Token ids of whole documents as ORC files: run-length encoded integers, row indexes, Bloom filters on the ids."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import id_key, ids_of_lists, offsets, parts, ranges, small_batches

END = 1  # id appended to every document

_END = END.to_bytes(4, "little")

_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}
_SCHEMA = "doc_id long, version long, part int, ids array<int>"
_REMEMBER = 1_000_000  # different pieces whose ids a Python worker keeps: about 200 MB
_LONG = 64  # longer pieces hardly come back and are not kept
_JOINED = 512  # pieces handed to the tokenizer as one text

# Texts of characters whose case, normal form and class are beyond doubt, and without the "<" of special tokens.
_PLAIN = re.compile("[\t\n\r\x20-\x3b\x3d-\x7e\xa1-\u012f\u0131-\u0232]*")
# The tokenizer's own way to cut a text; what it encodes are these pieces, one by one.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class PieceTokenizer:
    """A tokenizer that drops white space and encodes each piece of a text by itself, with a memory for pieces.

    Texts are split at white space, the different words of a batch are cut into pieces, and the different pieces looked
    up; ids then go back to the words, and from there to the texts. New pieces are encoded many at a time as one text,
    in which each ends with the only id that stands for an end; they are in the tokenizer's normal form already, so its
    merges alone are applied. Texts with unusual characters go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.pieces: dict[str, bytes] = {"": b""}

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> list[bytes]:
        out = []
        groups = [new[i : i + _JOINED] for i in range(0, len(new), _JOINED)]
        for pieces, found in zip(groups, self.merges.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            edges = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(edges, edges[1:])] if len(edges) == len(pieces) + 1 else self._raw(pieces)
        return out

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces."""
        out = list(map(self.pieces.get, pieces))
        places = [i for i, ids in enumerate(out) if ids is None]
        if len(self.pieces) + len(places) > _REMEMBER:
            self.pieces = {"": b""}
        new = [pieces[i] for i in places]
        found = self._learn(new)
        for i, ids in zip(places, found):
            out[i] = ids
        self.pieces.update((p, ids) for p, ids in zip(new, found) if len(p) <= _LONG)
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, one after the other, and where each word's end."""
        pieces = pc.split_pattern(pc.ascii_rtrim_whitespace(pc.replace_substring_regex(words, _CUT, r"\0 ")), " ")
        return ids_of_lists(pieces, self._known)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian 32-bit integers."""
        plain = [_PLAIN.fullmatch(t) is not None for t in texts]
        words = pc.ascii_split_whitespace(pa.array([t.lower() if p else "" for t, p in zip(texts, plain)], pa.string()))
        named = words.values.dictionary_encode()
        flat, at = self._words(named.dictionary)
        of, sizes = named.indices.to_numpy(), np.diff(at)
        raw = flat[ranges(at[of], sizes[of])].tobytes()
        ends = (4 * np.concatenate(([0], np.cumsum(sizes[of])))[offsets(words)]).tolist()
        return [(raw[a:b] if p else self._raw([t])[0]) + _END for t, p, a, b in zip(texts, plain, ends, ends[1:])]


_LOADED: dict[str, PieceTokenizer] = {}


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = PieceTokenizer(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                some = batch.slice(start, 2048)
                ids = _LOADED[path].encode([t or "" for t in some.column("text").to_pylist()])
                at = np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids]))).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(n) for n in ("doc_id", "version", "part")), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                    names=["doc_id", "version", "part", "ids"],
                )

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of every whole text, each followed by the end id, in ascending ``doc_id`` order.

    Files are ranges of ids; ``part`` numbers them in order. Null texts count as empty; a null id comes first; repeated
    rows are each written, rows with one id in order of their text's hash.
    """
    small_batches(docs.sparkSession)
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", id_key().alias("key"), F.xxhash64("text").alias("version"))
    ordered = ranged.repartitionByRange(parts(docs.sparkSession), "key", "version").sortWithinPartitions("key", "version")
    encoded = ordered.select("doc_id", "version", F.spark_partition_id().alias("part"), "text").mapInArrow(_encoder(tokenizer), _SCHEMA)
    encoded.write.format("orc").options(**_OPTIONS).save(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and CRC-32 of each row's ids, as little-endian 32-bit integers."""
    for batch in batches:
        ids = batch.column("ids")
        at = offsets(ids)
        flat = np.asarray(ids.values.to_numpy(), "<i4")
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("doc_id", "version", "part")), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
            names=["doc_id", "version", "part", "n_tokens", "ids_crc32"],
        )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, version, part, ids) of the files; given ids, indexes and Bloom filters let most stripes and rows be skipped."""
    out = spark.read.schema(_SCHEMA).orc(path)
    return out if doc_ids is None else out.where(F.col("doc_id").isin(doc_ids))


def token_spans(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; ``start`` counts all ids before it.

    The sums of earlier files are added up over one row per file; inside a file the order is that of ids and text
    hashes, in which they were written.
    """
    small_batches(spark)
    rows = read_tokens(spark, path).mapInArrow(_digest, "doc_id long, version long, part int, n_tokens long, ids_crc32 long")
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum(F.size("ids").cast("long")).alias("total"))
    before = sums.select(F.col("part").alias("of"), (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    inside = Window.partitionBy("part").orderBy(id_key(), "version", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(F.broadcast(before), F.col("part") == F.col("of"))
    return placed.select("doc_id", (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"), "n_tokens", "ids_crc32")
