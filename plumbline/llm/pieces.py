"""SentencePiece encoding and decoding with a public BPE model; giant texts by a max-plus scan over chunks.

A sequence of pieces is the model's encoding of its text if and only if each two neighbours are: the model, given the
text of both, returns just these two. Weigh an admissible neighbourhood 0 and any other minus infinity, and encoding is
the best path of a max-plus system whose state at a cut is the piece that reaches or crosses it. A giant text is split
into chunks; each chunk yields, on its own, the matrix of states at its left cut against states at its right cut. The
matrices of a text are combined associatively, the states at all cuts read off, and each chunk backtraced on its own.
Piece borders that the vocabulary forces (before a space, around a line break) make most matrices of rank one.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import held, id_key, ids_of_lists, offsets, release, small_batches, with_doc

# Texts of more code points are split into chunks of this many.
CHUNK = 32_768

_SPACE = "▁"
_SEGMENT = f"{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+|\n"
_JOINED = 512  # segments handed to the library as one text
_ROWS = 512  # texts whose segments are looked up together
_FREE = ""  # the state at the text's beginning and after a forced border


class Vocabulary:
    """The pieces of a model file, its merges, and which pieces may stand side by side."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(len(self.pieces))]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.raw = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if special[i] else p.encode() for i, p in enumerate(self.pieces)]
        self.longest = max(map(len, self.ids))
        self.beside: dict[tuple[str, str], bool] = {}
        self.line = self.numbers(["\n"])
        self.known: dict[str, bytes] = self._own()
        if any("\n" in p or re.search(f"[^{_SPACE}]{_SPACE}", p) for p in self.ids):
            raise ValueError("pieces across a space or a line break are not supported")

    def merge(self, text: str) -> list[str]:
        """The pieces of a stretch of text: best-scored neighbours merge first, the leftmost of equal ones."""
        n = len(text)
        part = list(text)
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        scores = self.scores
        heap = [(-scores[p], i, p) for i in range(n - 1) if (p := text[i : i + 2]) in scores]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i]
            if part[i] is None or j >= n or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, None
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (p := joined + part[k]) in scores:
                    heapq.heappush(heap, (-scores[p], i, p))
            if (h := left[i]) >= 0 and (p := part[h] + joined) in scores:
                heapq.heappush(heap, (-scores[p], h, p))
        return [p for p in part if p is not None]

    def numbers(self, pieces: list[str]) -> array:
        """Ids of pieces; characters outside the vocabulary become their bytes."""
        out = array("i")
        for p in pieces:
            if (i := self.ids.get(p)) is not None:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in p.encode())
        return out

    def _own(self) -> dict[str, bytes]:
        """What is known before: the end of a split line, and the line break."""
        return {"": b"", "\n": self.line.tobytes()}

    def learn(self, segments: list[str]) -> list[bytes]:
        """Ids of stretches between forced borders, as 32-bit integers.

        Many are encoded by the library as one text, each on a line of its own: no piece crosses a line break.
        """
        out = []
        for start in range(0, len(segments), _JOINED):
            some = segments[start : start + _JOINED]
            ids = np.array(self.model.encode("\n".join(["", *some, ""])), np.int32)
            edges = (4 * np.flatnonzero(ids == self.line[0])).tolist()
            raw = ids.tobytes()
            whole = len(edges) == len(some) + 1
            out += [raw[a + 4 : b] for a, b in zip(edges, edges[1:])] if whole else [self.numbers(self.merge(s)).tobytes() for s in some]
        return out

    def segments(self, different: list[str]) -> list[bytes]:
        """Ids of different stretches between forced borders; up to 400,000 short ones are remembered."""
        out = list(map(self.known.get, different))
        places = [i for i, ids in enumerate(out) if ids is None]
        if len(self.known) + len(places) > 400_000:
            self.known = self._own()
        new = [different[i] for i in places]
        found = self.learn(new)
        for i, ids in zip(places, found):
            out[i] = ids
        self.known.update((s, ids) for s, ids in zip(new, found) if len(s) <= 48)
        return out

    def stretches(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised texts that begin and end at forced borders, and the offsets of the texts."""
        # A normalised text has no space, so that one may stand between its segments.
        spaced = pc.replace_substring_regex(pa.array(texts, pa.string()), _SEGMENT, r"\0 ")
        return ids_of_lists(pc.split_pattern(spaced, " "), self.segments)

    def stretch(self, text: str) -> array:
        return array("i", self.stretches([text])[0].tobytes())

    def decode(self, ids: Iterable[int]) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(_SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    def admits(self, a: str, b: str) -> bool:
        """Whether piece ``b`` may follow piece ``a``: weight 0, else minus infinity."""
        if a == _FREE or forced(a[-1], b[0]):
            return True
        found = self.beside.get((a, b))
        if found is None:
            if len(self.beside) >= 200_000:
                self.beside.clear()
            found = self.beside[a, b] = self.merge(a + b) == [a, b]
        return found

    def paths(self, text: str, start: int, before: str, last_start: int, stop: int) -> dict[int, tuple[int, str]]:
        """End position -> (start, piece) of the pieces on paths that leave ``start`` after piece ``before``.

        Pieces start before ``last_start`` and end at ``stop`` at the latest. A prefix has one encoding, so an end
        position has one piece.
        """
        ends: dict[int, tuple[int, str]] = {start: (-1, before)}
        queue = [start]
        while queue:
            p = heapq.heappop(queue)
            if p >= last_start:
                continue
            own = ends[p][1]
            for size in range(1, min(self.longest, stop - p) + 1):
                piece = text[p : p + size]
                if (size == 1 or piece in self.ids) and p + size not in ends and self.admits(own, piece) and self.whole(piece):
                    ends[p + size] = (p, piece)
                    heapq.heappush(queue, p + size)
        return ends

    def whole(self, piece: str) -> bool:
        """Whether merging ever yields the piece."""
        found = self.beside.get((piece, _FREE))
        if found is None:
            found = self.beside[piece, _FREE] = len(self.merge(piece)) == 1
        return found


def normal(text: str) -> str:
    """The model's view of a text: spaces marked, one in front."""
    return _SPACE + text.replace(" ", _SPACE) if text else ""


def forced(a: str, b: str) -> bool:
    """Whether no piece can hold these two characters side by side."""
    return a == "\n" or b == "\n" or (b == _SPACE and a != _SPACE)


def _trace(ends: dict[int, tuple[int, str]], at: int, start: int) -> list[str]:
    """The pieces of the path from ``start`` to ``at``."""
    out = []
    while at != start:
        at, piece = ends[at]
        out.append(piece)
    return out[::-1]


class Chunk:
    """One chunk of a normalised text: ``text[begin:end]`` with a margin of one piece length on both sides."""

    def __init__(self, words: Vocabulary, text: str, begin: int, end: int, first: bool, last: bool):
        self.v, self.text, self.begin, self.end, self.first, self.last = words, text, begin, end, first, last
        self.borders = [i for i in range(max(begin, 1), end) if forced(text[i - 1], text[i])]

    def entries(self) -> list[tuple[str, int]]:
        """Possible states at the left cut: (piece, characters beyond the cut)."""
        if self.first:
            return [(_FREE, 0)]
        out = []
        for over in range(self.v.longest):
            for size in range(over + 1, self.v.longest + 1):
                piece = self.text[self.begin + over - size : self.begin + over]
                if self.begin + over >= size and len(piece) == size and (size == 1 or piece in self.v.ids) and self.v.whole(piece):
                    out.append((piece, over))
        return out

    def _head(self, state: tuple[str, int], stop: int) -> dict[int, tuple[int, str]]:
        return self.v.paths(self.text, self.begin + state[1], state[0], stop, stop)

    def _exits(self, ends: dict[int, tuple[int, str]]) -> list[tuple[str, int]]:
        if self.last:
            return [(_FREE, 0)] if self.end in ends else []
        return [(piece, e - self.end) for e, (_, piece) in ends.items() if e >= self.end and piece != _FREE]

    def matrix(self) -> list[list]:
        """[left state, right state] for each pair joined by a path; all other entries are minus infinity."""
        if self.borders:
            first, last = self.borders[0], self.borders[-1]
            left = [s for s in self.entries() if self.begin + s[1] <= first and first in self._head(s, first)]
            right = self._exits(self.v.paths(self.text, last, _FREE, self.end, len(self.text)))
            return [[a, b] for a in left for b in right]
        return [[a, b] for a in self.entries() if self.begin + a[1] <= len(self.text) for b in self._through(a)]

    def _through(self, state: tuple[str, int]) -> list[tuple[str, int]]:
        if self.begin + state[1] >= self.end:  # the piece covers the whole chunk
            over = self.begin + state[1] - self.end
            return [(_FREE, 0)] if self.last and not over else [] if self.last else [(state[0], over)]
        return self._exits(self.v.paths(self.text, self.begin + state[1], state[0], self.end, len(self.text)))

    def ids(self, left: tuple[str, int], right: tuple[str, int]) -> array:
        """The ids of the pieces that start in this chunk, given the states at its cuts."""
        start, goal = self.begin + left[1], self.end + right[1]
        if start >= self.end:
            return array("i")
        if not self.borders:
            return self.v.numbers(_trace(self.v.paths(self.text, start, left[0], self.end, len(self.text)), goal, start))
        first, last = self.borders[0], self.borders[-1]
        out = self.v.numbers(_trace(self._head(left, first), first, start))
        out.extend(self.v.stretch(self.text[first:last]))
        tail = self.v.paths(self.text, last, _FREE, self.end, len(self.text))
        out.extend(self.v.numbers(_trace(tail, goal, last)))
        return out


def combine(a: dict, b: dict) -> dict:
    """The max-plus product of two matrices, as left state -> set of right states."""
    return {left: out for left, mids in a.items() if (out := set().union(*(b.get(m, ()) for m in mids)))}


def states(matrices: list[dict]) -> list[tuple]:
    """The states at all cuts of the one path from beginning to end, through a tree of products."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([combine(*row[i : i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)])
    free = (_FREE, 0)
    if free not in levels[-1][0].get(free, ()):
        raise ValueError("no path through the chunks")
    cuts = [free, free]
    for row in reversed(levels[:-1]):
        finer = [cuts[0]]
        for i in range(0, len(row), 2):
            left, right = cuts[i // 2], cuts[i // 2 + 1]
            if i + 1 < len(row):
                finer.append(next(m for m in row[i][left] if right in row[i + 1].get(m, ())))
            finer.append(right)
        cuts = finer
    return cuts


_OWN = "pieces"


def vocabulary(path: str) -> Vocabulary:
    """The model of a file and the segments it remembers, kept in a Python worker from task to task."""
    return held(_OWN, path, lambda: Vocabulary(path))


def _lists(values: list[array]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = array("i")
    for v in values:
        flat.extend(v)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)))


def _short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        release(_OWN)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                some = batch.slice(start, _ROWS)
                flat, at = words.stretches([normal(t or "") for t in some.column("text").to_pylist()])
                ends = at.tolist()
                decoded = [words.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat)), pa.array(decoded, pa.string())],
                    names=["doc", "ids", "decoded"],
                )
        release(_OWN)

    return run


def _chunked(path: str, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of (id, version, chunk, begin, end, first, last, text) with margins."""
        margin = vocabulary(path).longest
        names = ["id", "version", "chunk", "begin", "end", "first", "last", "text"]
        for batch in batches:
            for i in range(batch.num_rows):
                text = normal(batch.column("text")[i].as_py())
                for number, at in enumerate(range(0, len(text), chunk)):
                    low, stop = max(0, at - margin), min(len(text), at + chunk)
                    row = [batch.column("id")[i].as_py(), batch.column("version")[i].as_py(), number, at - low, stop - low, at == 0, stop == len(text), text[low : stop + margin]]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

    return run


def _chunk(words: Vocabulary, row: dict) -> Chunk:
    return Chunk(words, row["text"], row["begin"], row["end"], row["first"], row["last"])


def _matrices(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            out = [json.dumps(_chunk(words, r).matrix()) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("id", "version", "chunk")), pa.array(out, pa.string())], names=["id", "version", "chunk", "matrix"])

    return run


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = []
            for m in sorted(row["matrices"], key=lambda m: m["chunk"]):
                sets: dict = {}
                for a, b in json.loads(m["matrix"]):
                    sets.setdefault(tuple(a), set()).add(tuple(b))
                found.append(sets)
            cuts = states(found)
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["id"]] * n, pa.int64()), pa.array([row["version"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([json.dumps(p) for p in zip(cuts, cuts[1:])], pa.string())],
                names=["id", "version", "chunk", "cuts"],
            )


def _backtraced(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left, right = map(tuple, json.loads(r["cuts"]))
                out.append(_chunk(words, r).ids(left, right))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("id", "version", "chunk")), _lists(out)], names=["id", "version", "chunk", "ids"])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for i in range(batch.num_rows):
                some = batch.slice(i, 1)
                column = some.column("ids")
                at = offsets(column)
                ids = array("i", column.values.to_numpy()[at[0] : at[1]].tobytes())
                yield pa.RecordBatch.from_arrays([some.column("doc"), column, pa.array([words.decode(ids)], pa.string())], names=["doc", "ids", "decoded"])

    return run


def encoded(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns) with ``ids`` (array of int) and ``decoded`` text.

    ``path`` names the model file on every executor. Null and empty texts have no ids and decode to an empty text;
    repeated rows are each encoded; a null doc_id is as good as any. Texts of more than ``chunk`` code points go
    through the scan, so no task holds work that grows with a text but its final list of ids.
    """
    small_batches(docs.sparkSession)
    row = F.struct("*")
    named = docs.select(row.alias("doc"), id_key().alias("id"), F.xxhash64("text").alias("version"), "text")
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    schema = with_doc(docs, "ids array<int>, decoded string")
    short = named.where(~giant).select("doc", "text").mapInArrow(_short(path), schema)
    long = named.where(giant)
    pieces = long.select("id", "version", "text").mapInArrow(
        _chunked(path, chunk), "id long, version long, chunk int, begin int, end int, first boolean, last boolean, text string"
    )
    matrices = pieces.mapInArrow(_matrices(path), "id long, version long, chunk int, matrix string")
    # Sets: a row given twice yields each chunk twice.
    grouped = matrices.groupBy("id", "version").agg(F.collect_set(F.struct("chunk", "matrix")).alias("matrices"))
    cuts = grouped.mapInArrow(_scan, "id long, version long, chunk int, cuts string")
    traced = pieces.join(cuts, ["id", "version", "chunk"]).mapInArrow(_backtraced(path), "id long, version long, chunk int, ids array<int>")
    whole = traced.groupBy("id", "version").agg(F.array_sort(F.collect_set(F.struct("chunk", "ids"))).alias("by_chunk"))
    ids = whole.select("id", "version", F.flatten("by_chunk.ids").alias("ids"))
    return short.unionAll(long.select("doc", "id", "version").join(ids, ["id", "version"]).select("doc", "ids").mapInArrow(_decoded(path), schema))
