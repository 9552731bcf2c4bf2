"""Likeness of texts of different scales."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import editprint


def print_of(text):
    return editprint.Walk(editprint.classes(text)).fingerprint()


@pytest.mark.parametrize("kept, more", [(1000, 1040), (1000, 1000), (900, 300), (120, 30)])
def test_likeness_covers_the_whole_longer_text(kept, more):
    rng = random.Random(11)
    text = "".join(rng.choice("etaoin shrdlu") for _ in range(kept + more))
    share = kept / (kept + more)
    found = editprint.likeness(print_of(text[:kept]), print_of(text))
    assert abs(found - share) < 0.12 and found == editprint.likeness(print_of(text), print_of(text[:kept]))


def slow_joined(prints, links):
    label = list(range(len(prints)))
    for a, b in links:
        x, y = label[prints.index(a)], label[prints.index(b)]
        label = [x if z == y else z for z in label]
    return [label.index(z) for z in label]


@pytest.mark.parametrize("block", [1, 2, 512])
def test_a_crowded_key_joins_all_alike_prints(block):
    rng = random.Random(12)
    letters = editprint._SYMBOLS.tobytes().decode()
    prints = []
    # Each of a chain is alike to its neighbours only, on three scales.
    for top in ("10", "11", "10", "12"):
        now = [rng.choice(letters) for _ in range(256)]
        for step in range(12):
            now[128 + 10 * step : 138 + 10 * step] = rng.choices(letters, k=10)
            now[10 * step : 10 + 10 * step] = rng.choices(letters, k=10)
            prints.append(top + "".join(now))
    prints += ["11" + p[2 : 130] * 2 for p in prints[:3]]
    batches = [pa.RecordBatch.from_pydict({"key": np.zeros(len(c), np.int64), "print": c}) for c in (prints[:7], prints[7:])]
    found = [x for b in editprint._linker(0.85, block)(iter(batches)) for x in zip(*(b.column(c).to_pylist() for c in "ab"))]
    alike = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if editprint.likeness(a, b) >= 0.85]
    assert set(found) <= set(alike) and slow_joined(prints, found) == slow_joined(prints, alike)
    assert len(found) == len(prints) - len(set(slow_joined(prints, alike)))
