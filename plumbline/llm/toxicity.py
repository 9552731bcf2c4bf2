"""Toxicity scores: a learned lexicon, misspellings by Levenshtein automata over its trie, and context windows.

Fitting reads a bounded sample of labelled rows. Words and word beginnings that mark toxic rows become the lexicon; a
logistic regression weighs, per document, how often and how densely its terms occur, how many are misspelt, and
whether they stand inside quotation marks (quoting) or bare (abuse).
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import groups, own_text, release, small_batches, with_doc
from plumbline.session import stage

# The classifier is fitted on at most this many labelled rows, taken in hash order of their ids.
SAMPLE = 20_000
# The chance that a lexicon holds any term which marks toxic rows by accident only.
ERROR = 0.05

_TOKEN = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]")
_STRETCH = 1 << 16  # characters of a text whose words are held at once
_PREFIX = range(4, 8)
_OPEN, _CLOSE = "“„«‹", "”»›"
_REACH = 160  # characters around a hit searched for quotation marks
_NOTHING = (-1, 0)
_WINDOW = 12  # words around a hit in which further hits count as a cluster


def _stretches(lower: str, size: int | None = None) -> Iterator[list[str]]:
    """The words of a text in order, some of them at a time, so that a long text never becomes one long list."""
    at, size = 0, size or _STRETCH
    while at < len(lower):
        gap = _GAP.search(lower, min(at + size, len(lower)))
        end = gap.start() if gap else len(lower)
        yield _TOKEN.findall(lower, at, end)
        at = end


class Trie:
    """Lexicon terms by letter; a term ending in ``*`` matches every word that begins with it."""

    def __init__(self, terms: list[str]):
        self.root: dict = {}
        for number, term in enumerate(terms):
            node = self.root
            for letter in term.rstrip("*"):
                node = node.setdefault(letter, {})
            node["begins" if term.endswith("*") else "ends"] = number

    def exact(self, word: str) -> int:
        """The longest term that the word is or begins with, or -1."""
        node, found = self.root, -1
        for letter in word:
            node = node.get(letter)
            if node is None:
                return found
            found = node.get("begins", found)
        return node.get("ends", found)


class Speller:
    """The Levenshtein automata of all terms, intersected with their trie and made deterministic as words come.

    A state is a set of (trie node, edits so far, letter still to come of a swapped pair). Its moves are worked out
    once for each letter of the lexicon and once for all others; most words lead to the empty set within a few
    letters, so a word costs a few look-ups. The number of states depends on the lexicon only.
    """

    def __init__(self, terms: dict[str, int], edits: int):
        self.edits = edits
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}
        for term, number in terms.items():
            at = 0
            for letter in term:
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                at = self.children[at][letter]
            self.ends[at] = min(number, self.ends.get(at, number))
        self.letters = {letter for node in self.children for letter in node}
        self.states: dict[frozenset, dict] = {}
        self.start = self._state({(0, 0, "")})

    def _state(self, found: set[tuple[int, int, str]]) -> dict:
        """The state of a set, closed under letters left out, with the least edits for each node only."""
        best: dict[tuple[int, str], int] = {}
        stack = list(found)
        while stack:
            node, edits, wanted = stack.pop()
            if edits > self.edits or best.get((node, wanted), self.edits + 1) <= edits:
                continue
            best[node, wanted] = edits
            if not wanted:
                stack += [(child, edits + 1, "") for child in self.children[node].values()]
        key = frozenset((node, edits, wanted) for (node, wanted), edits in best.items())
        if key not in self.states:
            accepted = [(edits, self.ends[node]) for node, edits, wanted in key if not wanted and node in self.ends]
            self.states[key] = {"set": key, "term": min(accepted, default=(0, -1))[1]}
        return self.states[key]

    def _move(self, state: dict, letter: str) -> dict:
        found = set()
        for node, edits, wanted in state["set"]:
            if wanted:
                if wanted == letter:
                    found.add((node, edits, ""))
                continue
            found.add((node, edits + 1, ""))  # a letter too many
            for own, child in self.children[node].items():
                found.add((child, edits + (own != letter), ""))
                if own != letter and letter in self.children[child]:
                    found.add((self.children[child][letter], edits + 1, own))
        out = state[letter] = self._state(found)
        return out

    def near(self, word: str) -> int:
        """The term of least edit distance within the automaton's edits, or -1."""
        state, letters = self.start, self.letters
        for letter in word:
            if letter not in letters:
                letter = ""
            state = state.get(letter) or self._move(state, letter)
            if not state["set"]:
                return -1
        return state["term"]


def allowance(length: int) -> int:
    """Edits within which a word of this length may be a misspelt term."""
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass(frozen=True)
class Model:
    """Lexicon with term weights, and the regression over :func:`features`."""

    terms: list[str]
    weights: list[float]
    rates: list[float]
    mean: list[float]
    scale: list[float]
    beta: list[float]


class Reader:
    """Finds hits of a lexicon; remembers the verdict on up to 200,000 different words."""

    def __init__(self, terms: list[str], weights: list[float], rates: list[float]):
        self.trie, self.weights, self.rates = Trie(terms), weights, rates
        # Beginnings are matched as they are; only whole words can be misspelt.
        whole = {t: i for i, t in enumerate(terms) if not t.endswith("*")}
        self.spellers = {edits: Speller(whole, edits) for edits in (1, 2)}
        self.known: dict[str, tuple[int, int]] = {}

    def verdict(self, word: str) -> tuple[int, int]:
        """(term, 1 exact or 2 misspelt), or (-1, 0)."""
        if len(self.known) >= 200_000:
            self.known.clear()
        number, kind = self.trie.exact(word), 1
        if number < 0:
            speller = self.spellers.get(allowance(len(word)))
            number, kind = speller.near(word) if speller else -1, 2
        self.known[word] = out = (number, kind) if number >= 0 else _NOTHING
        return out

    def features(self, text: str) -> list[float]:
        lower = text.lower()
        get = self.known.get
        hits, n = [], 0
        for words in _stretches(lower):
            for i, w in enumerate(words, n):
                v = get(w) or self.verdict(w)
                if v[1]:
                    hits.append((i, *v))
            n += len(words)
        exact = Counter(t for _, t, kind in hits if kind == 1)
        total = sum(c * self.weights[t] for t, c in exact.items())
        # How far the best term's count exceeds what clean text of this length would give (a log-likelihood ratio).
        surplus = max((c * math.log(c / max(n * self.rates[t], 1e-9)) - c + n * self.rates[t] for t, c in exact.items() if c > n * self.rates[t]), default=0.0)
        misspelt = sum(kind == 2 for _, _, kind in hits)
        near = sum(b[0] - a[0] <= _WINDOW for a, b in zip(hits, hits[1:]))
        quoted = self.quoted(lower, hits) if hits else 0
        c = sum(exact.values())
        return [
            math.log1p(c), math.log1p(total), math.log1p(surplus), min(surplus, 20.0), len(exact), 100.0 * c / max(n, 1) if n >= 20 else min(5.0, 100.0 * c / max(n, 1)),
            math.log1p(misspelt), 100.0 * misspelt / max(n, 20), math.log1p(near), quoted / max(1, len(hits)), math.log1p(n), float(c == 0), math.log1p(len(exact)),
        ]

    def quoted(self, lower: str, hits: list) -> int:
        """Hits with an opening mark before and a closing one behind within reach."""
        wanted = {i for i, _, _ in hits}
        count = 0
        for a, b in (m.span() for i, m in enumerate(_TOKEN.finditer(lower)) if i in wanted):
            before, after = lower[max(0, a - _REACH) : a], lower[b : b + _REACH]
            line = before.rpartition("\n")[2]
            plain = line.count('"') % 2 == 1 and '"' in after.partition("\n")[0]
            paired = max(map(line.rfind, _OPEN)) > max(map(line.rfind, _CLOSE)) and any(m in after for m in _CLOSE)
            count += plain or paired
        return count


def units(text: str) -> Counter:
    """Words and word beginnings of a text with their counts."""
    out: Counter = Counter()
    words: Counter = Counter()
    for some in _stretches(text.lower()):
        words.update(some)
    for word, n in words.items():
        if len(word) >= 4:
            out[word] += n
        for size in _PREFIX:
            if len(word) > size:
                out[f"{word[:size]}*"] += n
    return out


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch slice: in how many toxic and clean rows each unit occurs, and how often in clean ones."""
    for batch in groups(batches, "text", 2 << 20):
        rows, often, lengths = (Counter(), Counter()), Counter(), [0, 0]
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = units(text or "")
            rows[bool(toxic)].update(own.keys())
            lengths[bool(toxic)] += sum(c for u, c in own.items() if not u.endswith("*"))
            if not toxic:
                often.update(own)
        names = list(rows[0].keys() | rows[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[u] for u in names], pa.int64()) for c in (rows[1], rows[0], often))],
            names=["unit", "toxic_rows", "clean_rows", "clean_count"],
        )


def evidence(toxic_rows: F.Column, clean_rows: F.Column, share: float) -> F.Column:
    """A bound on how unlikely a unit is in so many toxic rows if it does not mark them, as a negative logarithm.

    Of the rows with the unit, each is toxic with the probability ``share``; the bound is Chernoff's, which holds for
    counts of any size. Units at or below that share get zero.
    """

    def part(k: F.Column, of: F.Column, p: float) -> F.Column:
        return F.when(k > 0, k * F.log(k / (of * F.lit(p)))).otherwise(0.0)

    both = toxic_rows + clean_rows
    return F.when(toxic_rows > both * F.lit(share), part(toxic_rows, both, share) + part(clean_rows, both, 1 - share)).otherwise(0.0)


def unlike(marks: list) -> list:
    """Units, best first, without those that add nothing beside a better one: one begins with the other."""
    kept: list = []
    stems: list[str] = []  # in order
    sizes: set[int] = set()
    for r in marks:
        stem = r.unit.rstrip("*")
        at = bisect.bisect_left(stems, stem)
        if at < len(stems) and stems[at].startswith(stem) or any(stem[:n] == stems[i] for n in sizes if (i := bisect.bisect_left(stems, stem[:n])) < len(stems)):
            continue
        kept.append(r)
        stems.insert(at, stem)
        sizes.add(len(stem))
    return kept


def _reader(model: Model) -> Reader:
    return Reader(model.terms, model.weights, model.rates)


def _featured(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(model)
        for batch in batches:
            found = [reader.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    return run


def fit(docs: DataFrame, labels: DataFrame, usable: F.Column, sample: int = SAMPLE) -> Model:
    """Learn lexicon and weights from labelled rows whose ``doc_id`` satisfies ``usable``.

    At most ``sample`` label rows are used and sent to the executors; repeated labels of a row count once (toxic if
    any says so), null labels not at all. Every unit of theirs whose :func:`evidence` stands against the number of
    units tried becomes a term, so the lexicon is bounded by the words of the sample alone. Without a toxic and a clean row every score is the share of toxic rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marked = labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    wanted = spark.createDataFrame([(int(r.doc_id), int(r.toxic > 0)) for r in rows], "doc_id long, toxic int")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted), "doc_id").select("text", "toxic")
    counted = known.mapInArrow(_unit_counts, "unit string, toxic_rows long, clean_rows long, clean_count long")
    sums = counted.groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("toxic_rows", "clean_rows", "clean_count")))
    toxic, total = sum(int(r.toxic > 0) for r in rows), len(rows)
    clean = total - toxic
    if not toxic or not clean:
        return Model([], [], [], [], [], [math.log((toxic + 0.5) / (clean + 0.5))])
    sums = stage(sums, "toxicity-units")
    found = evidence(F.col("toxic_rows"), F.col("clean_rows"), toxic / total)
    marks = sums.withColumn("found", found).where(F.col("found") > math.log(max(1, sums.count()) / ERROR))
    # A word is preferred to a beginning that marks hardly more.
    rank = F.desc(F.col("found") * F.when(F.col("unit").endswith("*"), 0.94).otherwise(1.0))
    terms = unlike(marks.orderBy(rank, F.desc(F.length("unit")), "unit").collect())
    words = 250.0 * clean  # only the scale of the rates depends on it, and the regression takes that up
    model = Model(
        [r.unit for r in terms],
        [max(0.1, math.log((r.toxic_rows + 0.5) / toxic) - math.log((r.clean_rows + 0.5) / clean)) for r in terms],
        [(r.clean_count + 0.5) / words for r in terms], [], [], [],
    )
    seen = known.mapInArrow(_featured(model), "x array<double>, toxic int").collect()
    x, y = np.array([r.x for r in seen]).reshape(len(seen), -1), np.array([r.toxic for r in seen], float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    beta = _regress((x - mean) / scale, y)
    return Model(model.terms, model.weights, model.rates, mean.tolist(), scale.tolist(), beta.tolist())


def _regress(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept comes first."""
    x = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def probability(model: Model, found: list[float]) -> float:
    """The score of a row of features."""
    value = model.beta[0] + sum(b * (v - m) / s for b, v, m, s in zip(model.beta[1:], found, model.mean, model.scale))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def _scorer(model: Model, separate: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        reader = _reader(model)
        for batch in batches if separate else own_text(batches):
            scores = [probability(model, reader.features(t or "") if model.terms else []) for t in batch.column("text").to_pylist()]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(scores, pa.float64())], names=[*names, "score"])
            del batch
        del reader
        release()

    return run


def held_out(column: str = "doc_id") -> F.Column:
    """Rows kept for judging: the CRC-32 of the id as text leaves two when divided by four."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """``docs`` as ``doc`` (struct of all their columns, or of ``doc_id`` only) with ``score`` between 0 and 1.

    A null or empty text gets the score of a text without hits. No column but the text is read for it. Rows are scored
    one by one, repeated or not; whole texts are read, however long.
    """
    small_batches(docs.sparkSession)
    kept = docs if keep_text else docs.select("doc_id")
    source = docs.select(F.struct("*").alias("doc")) if keep_text else docs.select(F.struct("doc_id").alias("doc"), "text")
    return source.mapInArrow(_scorer(model, not keep_text), with_doc(kept, "score double"))
