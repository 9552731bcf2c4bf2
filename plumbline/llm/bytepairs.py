"""Byte-level BPE by a sentencepiece model that is serialised from the vocabulary.

A vocabulary of ranked byte strings becomes a BPE model: each byte stands for one character, each token for the piece
of its characters with its negative rank as score, and normalisation is the identity. That model merges the adjacent
pair of best score, the leftmost of equals, as ranks ask for. Texts are cut into pre-tokens by a pattern; each is
encoded by itself, and ids are the ranks.
"""

from __future__ import annotations

import base64
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import as_bytes, groups, small_batches, with_doc

# A byte's character: 256 code points that are neither white space nor changed by anything, from here on.
_FIRST = 0x100
_CHARACTERS = "".join(chr(_FIRST + b) for b in range(256))
_REMEMBER = 1_000_000  # different pre-tokens whose ids a Python worker keeps: about 200 MB
_LONG = 64  # longer ones hardly come back and are not kept
_BYTES = 1 << 20  # of text cut at a time

# Numbers of the fields and kinds in the library's model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_MODEL_TYPE, _BPE = 3, 2
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5
_UNKNOWN = 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def characters(data: bytes) -> str:
    """One character for each byte."""
    return data.decode("latin-1").translate(_CHARACTERS)


def serialised(tokens: list[bytes]) -> bytes:
    """The BPE model of a vocabulary, given in the order of its ranks; the unknown piece, never used, comes last."""
    score = lambda rank: _varint(_SCORE << 3 | 5) + struct.pack("<f", -rank)
    pieces = [_block(_PIECES, _block(_PIECE, characters(t).encode()) + score(rank)) for rank, t in enumerate(tokens)]
    unknown = _block(_PIECES, _block(_PIECE, b"<unk>") + score(0) + _number(_TYPE, _UNKNOWN))
    trainer = _block(_TRAINER, _number(_MODEL_TYPE, _BPE))
    plain = b"".join(_number(f, 0) for f in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    return b"".join([*pieces, unknown, trainer, _block(_NORMALIZER, _block(_NAME, b"identity") + plain)])


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (a base64 token and its rank in each line) in the order of their ranks, which have no gaps."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    if sorted(ranks) != list(range(len(ranks))) or len(set(ranks.values())) != len(ranks):
        raise ValueError(f"{path}: ranks must be the numbers from 0 on, each for a token of its own")
    tokens = [ranks[i] for i in range(len(ranks))]
    if not {bytes([b]) for b in range(256)} <= set(tokens):
        raise ValueError(f"{path}: every single byte must be a token")
    return tokens


class ByteCodec:
    """Encodes and decodes with one vocabulary; remembers the ids of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(self.tokens))
        self.cut = regex.compile(pattern)
        self.seen: dict[str, bytes] = {}
        # A token that merges never reach stands for a pre-token of just its bytes all the same.
        found = self._merged([characters(t) for t in self.tokens])
        self.whole = {self.tokens[i]: struct.pack("<I", i) for i, ids in enumerate(found) if ids != [i]}

    def _merged(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode(pieces, out_type=int, num_threads=1)

    def _learn(self, new: list[str]) -> None:
        raw = [p.encode() for p in new]
        ids = self._merged([characters(r) for r in raw])
        whole = self.whole
        self.seen.update((p, whole.get(r) or struct.pack(f"<{len(i)}I", *i)) for p, r, i in zip(new, raw, ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        cut = [self.cut.findall(t) for t in texts]
        used = set(itertools.chain.from_iterable(cut))
        new = used.difference(self.seen)
        if len(self.seen) + len(new) > _REMEMBER:
            self.seen, new = {}, used
        self._learn(list(new))
        get = self.seen.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in cut]
        for p in new:
            if len(p) > _LONG:
                del self.seen[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[tuple[str, str], ByteCodec] = {}


def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> ByteCodec:
    """The codec of a rank file, loaded once in a worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteCodec(path, pattern)
    return _LOADED[path, pattern]


def _encoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in groups(batches, "text", _BYTES):
            ids = codec(path, pattern).encode([t.decode() for t in as_bytes(some.column("text"))])
            yield pa.RecordBatch.from_arrays([some.column("doc"), pa.array(ids, pa.binary())], names=["doc", "ids"])

    return run


def _decoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in groups(batches, "ids", _BYTES):
            decode = codec(path, pattern).decode
            texts = pa.array([decode(i) for i in as_bytes(some.column("ids"))], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column("doc"), some.column("ids"), texts], names=["doc", "ids", "decoded"])

    return run


def encoded(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, keep_text: bool = True) -> DataFrame:
    """``docs`` as ``doc`` (struct of their columns, without ``text`` on request) with ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers. ``path`` names the rank file on every executor. Whole texts
    are encoded, each match of ``pattern`` by itself, without special tokens; null and empty texts have no ids;
    repeated rows are each encoded; no other column is looked at.
    """
    small_batches(docs.sparkSession)
    kept = docs if keep_text else docs.drop("text")
    return docs.select(F.struct(*kept.columns).alias("doc"), "text").mapInArrow(_encoder(path, pattern), with_doc(kept, "ids binary"))


def decoded(rows: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc, ids) rows of :func:`encoded` with ``decoded``, the bytes of their ids; null ids decode to no bytes.

    Ids may be cut anywhere: the bytes need not be whole characters. An id beyond the vocabulary is an error.
    """
    small_batches(rows.sparkSession)
    schema = StructType([rows.schema["doc"], *StructType.fromDDL("ids binary, decoded binary").fields])
    return rows.select("doc", "ids").mapInArrow(_decoder(path, pattern), schema)
