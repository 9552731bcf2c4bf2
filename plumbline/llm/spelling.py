"""Spelling variants of the words of a corpus, by a trie over letter-group counts.

A word's frequency vector counts its letters by group. One inserted, deleted or replaced letter changes at most one
count by one up and one count by one down. Words are arranged in a trie by successive counts. A search goes down with
a surplus and a deficit of one each to spend, and the words of the leaves it reaches are compared letter by letter.
Of two words the one with the smaller vector, in the order of the levels, searches the other: it spends its surplus
first, so that no pair is found twice.

The upper levels of the trie are keys of a shuffle: a word goes to its own branch, and to each branch that its search
enters, with what it has spent. Branches of many words are dealt in chunks, each searched by all that enter.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, groups, parts, small_batches
from plumbline.session import stage

LETTERS, LEAST, RATIO = 6, 5, 5  # of a word: code points, occurrences; of its form's occurrences to its own

# Letter groups in the order of the trie's levels; other letters are dealt over them by code point.
GROUPS = ("e", "a", "n", "i", "s", "r", "t", "o", "l", "uw", "dk", "cq", "mx", "pyj", "hgz", "bvf")
UPPER = 5  # levels that are shuffle keys
CHUNK = 50_000  # words of a branch searched as one trie
BLOCK = 200_000  # words and searches held at a time
_TOP = 15  # larger counts are taken as this, which makes no difference of counts larger
_FLUSH = 300_000  # different words a task counts before it hands them on
_FRONT = 10_000  # searches that go down together
_WIDE = 31  # letters of a word in a row of its own width

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_GROUP = np.arange(256) % len(GROUPS)
for _i, _letters in enumerate(GROUPS):
    _GROUP[list(_letters.encode())] = _i


class _Numbers(dict):
    """Words by number; a new one gets the next."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class WordCounter:
    """Counts words, and the words that planted errors make of them."""

    def __init__(self, damage: int | None):
        self.damage, self.words, self.other = damage, _Numbers(), Counter()
        self.n = self.crc = self.size = np.zeros(0, np.int64)

    def _grow(self) -> None:
        new = [w.encode() for w in itertools.islice(self.words, len(self.n), None)]
        self.n = np.concatenate((self.n, np.zeros(len(new), np.int64)))
        self.crc = np.concatenate((self.crc, np.fromiter(map(zlib.crc32, new), np.int64, len(new))))
        self.size = np.concatenate((self.size, np.fromiter(map(len, new), np.int64, len(new))))

    def add(self, docs: list[tuple[int | None, bytes]]) -> None:
        found = [_RUN.findall(text.lower().decode()) for _, text in docs]
        numbers = [np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)) for words in found]
        self._grow()
        if self.damage:
            numbers = [self._damaged(i, words, at) if words else at for (i, _), words, at in zip(docs, found, numbers)]
        self.n += np.bincount(np.concatenate([np.zeros(0, np.int64), *numbers]), minlength=len(self.n))

    def _damaged(self, doc_id: int | None, words: list[str], at: np.ndarray) -> np.ndarray:
        """The numbers of the words that stay as they are; counts what the others become."""
        # A checksum that goes on from another one differs from that of the word alone by what its length decides.
        start, sizes = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), self.size[at]
        turn = np.zeros(sizes.max() + 1, np.int64)
        for size in np.flatnonzero(np.bincount(sizes)).tolist():
            turn[size] = zlib.crc32(bytes(size), start) ^ zlib.crc32(bytes(size))
        h = self.crc[at] ^ turn[sizes]
        hit = h % self.damage == 0
        for i in np.flatnonzero(hit).tolist():
            word, cut = words[i], int(h[i]) % len(words[i])
            self.other[word[:cut] + word[cut + 1 :]] += 1
        return at[~hit]

    def counts(self) -> Iterator[tuple[str, int]]:
        """The words so far; words may come twice."""
        return itertools.chain(zip(self.words, self.n.tolist()), self.other.items())


def _counter(letters: int, damage: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counter: WordCounter) -> pa.RecordBatch:
            kept = [(w, n) for w, n in counter.counts() if n and len(w) >= letters]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

        counter = WordCounter(damage)
        for some in groups(batches, "text", 1 << 22):
            counter.add(list(zip(some.column("doc_id").to_pylist(), as_bytes(some.column("text")))))
            if len(counter.words) > _FLUSH:
                yield out(counter)
                counter = WordCounter(damage)
        yield out(counter)

    return run


def word_counts(docs: DataFrame, letters: int = LETTERS, least: int = LEAST, damage: int | None = None) -> DataFrame:
    """(word, n): words of at least ``letters`` code points and ``least`` occurrences in the texts.

    A word is a maximal run of Latin letters, with A-Z in lower case. ``damage`` plants errors to be found: where it
    divides h, the CRC-32 of document id, colon and word, the word's letter h modulo its length is left out. Null and
    empty texts have no words; a null id counts as no characters; repeated rows count each.
    """
    small_batches(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(_counter(letters, damage), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def vectors(words: list[str]) -> np.ndarray:
    """The letter-group counts of words, a row for each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    at = np.repeat(np.arange(len(words)), sizes) * len(GROUPS) + _GROUP[letters & 255]
    return np.minimum(np.bincount(at, minlength=len(words) * len(GROUPS)), _TOP).reshape(len(words), len(GROUPS))


def differ_by_one(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    for x, y in zip(a, b):
        if x != y:
            break
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Spelled:
    """Words as rows of letters, to compare many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = words
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(w[:_WIDE] for w in words).encode("utf-32-le"), "<u4")
        self.letters = np.zeros((len(words), _WIDE + 1), np.uint8 if flat.max(initial=0) < 256 else np.uint32)
        shown = np.minimum(self.sizes, _WIDE)
        self.letters[np.repeat(np.arange(len(words)), shown), np.arange(len(flat)) - np.repeat(np.cumsum(shown) - shown, shown)] = flat

    def one_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a`` and ``b`` differ by one letter, pair by pair; words wider than the rows are compared by themselves."""
        turn = self.sizes[a] > self.sizes[b]
        a, b = np.where(turn, b, a), np.where(turn, a, b)
        more, out = self.sizes[b] - self.sizes[a], np.zeros(len(a), bool)
        wide = self.sizes[b] > _WIDE
        same = np.flatnonzero(~wide & (more == 0))
        out[same] = (self.letters[a[same]] != self.letters[b[same]]).sum(1) == 1
        longer = np.flatnonzero(~wide & (more == 1))
        x, y = self.letters[a[longer]], self.letters[b[longer]]
        first = (x != y).argmax(1)  # where the longer word may have its further letter
        after = x[:, :-1] != y[:, 1:]
        last = np.where(after.any(1), _WIDE - 1 - after[:, ::-1].argmax(1), -1)
        out[longer] = last < first
        for i in np.flatnonzero(wide & (more < 2)).tolist():
            out[i] = differ_by_one(self.words[a[i]], self.words[b[i]])
        return out


def _entries(levels: int) -> tuple[np.ndarray, np.ndarray]:
    """What a search may add to the counts of the upper levels, and what it has spent then: nothing, one, both."""
    none = np.eye(levels, dtype=np.int64)
    both = [none[i] - none[j] for i in range(levels) for j in range(i + 1, levels)]
    change = np.array([0 * none[0], *none, *both])
    return change, np.repeat([0, 1, 2], [1, levels, len(both)])


def _entering(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, spent, word, n): a word in its own branch (spent -1) and in those its search enters."""
        change, spent = _entries(levels)
        weight = (_TOP + 1) ** np.arange(levels)
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 14):
                some = batch.slice(start, 1 << 14)
                upper = vectors(some.column("word").to_pylist())[:, :levels]
                moved = upper[:, None] + change
                row, way = np.nonzero(((moved >= 0) & (moved <= _TOP)).all(2))
                row, way = np.concatenate((np.arange(len(upper)), row)), np.concatenate((np.zeros(len(upper), np.int64), way))
                state = np.where(np.arange(len(row)) < len(upper), -1, spent[way])
                keys = moved[row, way] @ weight
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(state.astype(np.int8)), *(some.column(c).take(pa.array(row)) for c in ("word", "n"))],
                    names=["key", "spent", "word", "n"],
                )

    return run


class Trie:
    """Words under numbered roots, arranged by the successive counts of their lower levels."""

    def __init__(self, roots: np.ndarray, counts: np.ndarray):
        self.levels, node, size = [], roots, int(roots.max()) + 1 if len(roots) else 1
        for level in counts.T:
            found, to = np.unique(node * (_TOP + 1) + level, return_inverse=True)
            children = np.full(size * (_TOP + 1), -1, np.int32)
            children[found] = np.arange(len(found))
            self.levels.append(children)
            node, size = to, len(found)
        self.order = np.argsort(node, kind="stable")
        self.starts = np.searchsorted(node[self.order], np.arange(size + 1))

    def search(self, roots: np.ndarray, counts: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(search, word, spent) for every word of every leaf that a search reaches within its budget."""
        who, node = np.arange(len(roots)), roots
        for level, children in enumerate(self.levels):
            own = counts[who, level]
            at = node * (_TOP + 1) + own
            more, less = np.flatnonzero((spent == 0) & (own < _TOP)), np.flatnonzero((spent == 1) & (own > 0))
            to = np.concatenate((children[at], children[at[more] + 1], children[at[less] - 1]))
            who, spent = np.concatenate((who, who[more], who[less])), np.concatenate((spent, spent[more] + 1, spent[less] + 1))
            live = np.flatnonzero(to >= 0)
            who, node, spent = who[live], to[live].astype(np.int64), spent[live]
        sizes = self.starts[node + 1] - self.starts[node]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[node], sizes)
        return np.repeat(who, sizes), self.order[place], np.repeat(spent, sizes)


def _searched(levels: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(word, n, near, near_n), for both words of each pair, from rows sorted by branch, chunk and what is spent."""
        held: list[pa.RecordBatch] = []
        rows = 0

        def found(some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            key, chunk, spent = (some.column(c).to_numpy() for c in ("key", "chunk", "spent"))
            words, n = some.column("word").to_pylist(), some.column("n").to_pylist()
            edge = np.zeros(len(key), np.int64)
            edge[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
            root, lower, spelled = np.cumsum(edge), vectors(words)[:, levels:], Spelled(words)
            own, asking = np.flatnonzero(spent < 0), np.flatnonzero(spent >= 0)
            trie = Trie(root[own], lower[own])
            asking = asking[root[asking] <= (root[own[-1]] if len(own) else -1)]
            for start in range(0, len(asking), _FRONT):
                front = asking[start : start + _FRONT]
                who, what, cost = trie.search(root[front], lower[front], spent[front].astype(np.int64))
                asked, leaf = front[who], own[what]
                good = np.flatnonzero(spelled.one_apart(asked, leaf))
                # Words of equal vectors find each other from both sides.
                triples = zip(asked[good].tolist(), leaf[good].tolist(), cost[good].tolist())
                pairs = [(i, j) for i, j, c in triples if c or words[i] < words[j]]
                a = [i for i, _ in pairs] + [j for _, j in pairs]
                b = [j for _, j in pairs] + [i for i, _ in pairs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([words[i] for i in a], pa.string()), pa.array([n[i] for i in a], pa.int64()),
                        pa.array([words[i] for i in b], pa.string()), pa.array([n[i] for i in b], pa.int64()),
                    ],
                    names=["word", "n", "near", "near_n"],
                )

        def joined() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= block:
                # The words of the last chunk stay for searches that are still to come.
                whole = joined()
                yield from found(whole)
                key, chunk, spent = (whole.column(c).to_numpy() for c in ("key", "chunk", "spent"))
                stays = np.flatnonzero((key == key[-1]) & (chunk == chunk[-1]) & (spent < 0))
                held = [whole.take(pa.array(stays))]
                # A block in which the words of one chunk have not ended must not search what it will search again.
                rows = len(stays)
        if held:
            yield from found(joined())

    return run


def near_words(words: DataFrame, upper: int = UPPER, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of different words that differ by one letter.

    ``words`` has unique ``word`` and ``n``. No partner is left out, however many a word or a branch has.
    """
    spark = words.sparkSession
    entered = words.repartition(parts(spark), "word").select("word", "n").mapInArrow(_entering(upper), "key long, spent byte, word string, n long")
    rows = stage(entered, "spelling-branches")
    # One row for each branch: at most 16 to the power of the upper levels.
    size = rows.where("spent < 0").groupBy(F.col("key").alias("branch")).agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    placed = rows.join(size, F.col("key") == F.col("branch"))
    own = F.pmod(F.xxhash64("word"), F.col("chunks").cast("long")).cast("int")
    chunks = F.when(F.col("spent") < 0, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = placed.select("key", F.explode(chunks).alias("chunk"), "spent", "word", "n").repartition(parts(spark), "key", "chunk")
    return dealt.sortWithinPartitions("key", "chunk", "spent").mapInArrow(_searched(upper, block), "word string, n long, near string, near_n long")


def variants(words: DataFrame, ratio: int = RATIO, **search: int) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of ``words`` (unique ``word``, ``n``).

    ``n_near`` counts the words one letter away. ``form`` is the one of them with the largest n, of equals the first
    in code-point order, if its n is at least ``ratio`` times the word's; else it is null, as is ``form_n``. ``root``
    ends the chain of forms that begins with the word; without a form it is the word. Forms grow in n by the ratio, so
    chains are short and cannot come back; they are followed by doubling.
    """
    if ratio < 2:
        raise ValueError("a form must have at least twice the occurrences of its variants")
    words = stage(words.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    around = near_words(words, **search).groupBy(F.col("word").alias("of")).agg(F.count("*").alias("n_near"), best)
    joined = words.join(around, F.col("word") == F.col("of"), "left")
    big = -F.col("best.less") >= ratio * F.col("n")
    out = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(big, F.col("best.near")).alias("form"),
            F.when(big, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    most, step = out.agg(F.max("n")).first()[0] or 0, out.where("form is not null").select("word", F.col("form").alias("root"))
    reach = 1  # forms a root is away at most, after a round
    while ratio**reach <= most:
        further = step.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        step = stage(step.join(further, F.col("root") == F.col("via"), "left").select("word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")
        reach *= 2
    roots = step.select(F.col("word").alias("of"), "root")
    return out.join(roots, F.col("word") == F.col("of"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
