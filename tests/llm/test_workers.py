"""What a Python worker keeps between tasks."""

from __future__ import annotations

import gc
import weakref
from types import SimpleNamespace

import pyarrow as pa

from plumbline.llm import common, contamination, pieces, toxicity
from test_texts import PIECES


def encode():
    batch = pa.RecordBatch.from_pydict({"doc": [1], "text": ["one of many segments"]})
    return list(pieces._short(PIECES)(iter([batch])))


def test_segments_are_remembered_until_another_operator_begins():
    encode()
    words = pieces.vocabulary(PIECES)
    assert len(words.known) > 2
    encode()
    assert pieces.vocabulary(PIECES) is words
    gone = weakref.ref(words)
    del words
    model = toxicity.Model([], [], [], [], [], [0.0])
    docs = pa.RecordBatch.from_pydict({"doc": [{"doc_id": 1}], "text": ["a text"]})
    assert [b.num_rows for b in toxicity._scorer(model, True)(iter([docs]))] == [1]
    gc.collect()
    assert gone() is None


def test_the_automaton_is_kept_for_its_own_tasks_only():
    shared = SimpleNamespace(value=[("item", b"one two three")])
    none = pa.array([[]], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["one two three four"]), pa.array([0], pa.int64()), none, pa.array([[]], pa.list_(pa.string()))], names=["text", "n_words", "spans", "items"]
    )
    found = []
    for _ in range(2):
        found += [b.column("items").to_pylist() for b in contamination._scanner(shared)(iter([batch]))]
    assert found == [[["item"]]] * 2
    matcher = weakref.ref(contamination._matcher(shared))
    gc.collect()
    assert matcher() is not None
    list(common.groups(iter([batch]), "text", 100))
    gc.collect()
    assert matcher() is None
