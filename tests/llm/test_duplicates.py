"""SimHash groups, edit-embedding prints, repeated windows and strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from plumbline.llm import editprint, exact, simhash, substring
from plumbline.llm.components import components
from plumbline.llm.suffixes import suffix_array


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def slow_print(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def slow_groups(prints, ids):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for x, i in zip(label, ids):
        least[x] = min(i, least.get(x, i))
    return [least[x] for x in label]


def test_golay_indices_meet_for_words_one_bit_apart():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    near, own = simhash.near_indices(words), simhash.index(words)
    assert all(set(simhash.index(words ^ (1 << b))[k] for b in range(23)) <= set(near[k]) for k in range(50))
    assert all(o in row for o, row in zip(own, near))


def test_prints_within_three_bits_share_a_key():
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(300)]
    others = [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for p in prints]
    row, key = simhash.keys(np.array(prints + others, np.uint64).view(np.int64))
    by_row = {}
    for r, k in zip(row.tolist(), key.tolist()):
        by_row.setdefault(r, set()).add(k)
    assert all(by_row[i] & by_row[300 + i] for i in range(300))


@pytest.mark.parametrize("block", [2, 2048])
def test_simhash_groups_equal_brute_force_for_any_block_size(spark, block):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)] + [rng.getrandbits(64) for _ in range(40)]
    prints = list(dict.fromkeys(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"), block)
    roots = {r.node: r.root for r in components(found).collect()}
    mine = [roots.get(p, p) for p in signed]
    want = slow_groups(prints, range(len(prints)))
    assert len({(a, b) for a, b in zip(mine, want)}) == len(set(mine)) == len(set(want))


def test_simhash_documents_and_representatives(spark, odd, none):
    rng = random.Random(4)
    base = " ".join(rng.choice("abcdefgh") * 3 for _ in range(80))
    texts = [base, base, base + " tail", "Few words", "few WORDS", "", " ", None, "other text that stands alone here"] + [base] * 5
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in simhash.duplicate_groups(docs).collect()}
    prints = [slow_print(t or "") for t in texts]
    assert [got[i].print & (1 << 64) - 1 for i in range(len(texts))] == prints
    want = slow_groups(prints, range(len(texts)))
    assert [got[i].component_id for i in range(len(texts))] == want
    assert sorted(r.doc_id for r in simhash.representatives(docs).collect()) == sorted(set(want))
    assert simhash.duplicate_groups(odd).count() == odd.count()
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    # The rows without words are one group, named by the null id; the repeated row stays once.
    assert sorted((str(r.doc_id), (r.text or "")[:9]) for r in kept.collect()) == sorted(
        [("3", "same text"), ("3", "another t"), ("None", "no id at "), ("None", ""), ("5", "wörter 你好"), ("6", "xxxxxxxxx"), ("7", "a")]
    )
    assert simhash.representatives(none).count() == 0 and simhash.duplicate_groups(none).count() == 0


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(200)] + [(1100, 130), (5, 5)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert set(got.values()) == {7} and len(got) == 61 + 200 and 7 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_walk(text):
    out, i, step = [], 0, 0
    codes = editprint.classes(text)
    while i < len(codes):
        out.append(i)
        i += int(editprint._MOVES[step % editprint.PERIOD, codes[i]])
        step += 1
    return out


def test_edit_walk_is_the_walk_step_by_step():
    rng = random.Random(6)
    for text in ["", "a", "x" * 300, "".join(rng.choice("abé你 \n") for _ in range(2000))]:
        walk = editprint.Walk(editprint.classes(text))
        where = slow_walk(text)
        assert np.searchsorted(walk.ends, np.arange(len(where)), side="right").tolist() == where
        half = len(text) // 2
        assert walk.spliced(half, editprint.classes(text[:9])).fingerprint() == editprint.Walk(editprint.classes(text[:half] + text[:9])).fingerprint()


def test_edit_prints_follow_the_distance():
    rng = random.Random(7)
    text = "".join(rng.choice("etaoin shrdlu") for _ in range(3000))
    other = "".join(rng.choice("etaoin shrdlu") for _ in range(3000))
    own = editprint.Walk(editprint.classes(text)).fingerprint()
    few = list(text)
    for i in rng.sample(range(3000), 3):
        few[i] = rng.choice(["", "zz", "q"])
    assert editprint.likeness(own, editprint.Walk(editprint.classes("".join(few))).fingerprint()) > 0.8
    assert editprint.likeness(own, editprint.Walk(editprint.classes(other)).fingerprint()) < 0.3


def test_edited_texts_take_the_next_document(spark, odd, none):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 1, 2, 3, 50, 400]))) for _ in range(60)] + [None]
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in editprint.against_next(docs).collect()}
    order = sorted(got, reverse=True)
    for k, i in enumerate(order):
        text, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, other = (editprint.Walk(editprint.classes(t)).fingerprint() for t in (text, edited))
        assert (got[i].n_chars, got[i].fingerprint, got[i].edited_fingerprint) == (len(text), own, other)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].near_edited == editprint.likeness(own, other)
        assert got[i].near_next == editprint.likeness(own, editprint.Walk(editprint.classes(following)).fingerprint())
    assert editprint.against_next(odd).count() == odd.count()
    assert editprint.against_next(none).count() == 0
    alone = editprint.against_next(docs.where("doc_id = 0")).first()
    assert alone.near_next == 1.0
    prints = editprint.fingerprinted(odd)
    assert prints.count() == odd.count() and prints.select("doc.*").columns == odd.columns


@pytest.mark.parametrize("block", [2, 512])
def test_edit_groups_join_near_copies_only(spark, odd, none, block):
    rng = random.Random(10)
    texts = []
    for _ in range(6):
        base = "".join(rng.choice("etaoin shrdlucmf") for _ in range(rng.randint(900, 1000)))
        texts.append(base)
        for _ in range(6):
            near = list(base)
            for i in rng.sample(range(len(near)), 2):
                near[i] = rng.choice(["", "qq"])
            texts.append("".join(near))
    docs = frame(spark, texts + texts[:5])
    found = {}
    for r in editprint.near_groups(docs, block=block).collect():
        found.setdefault(r.group, set()).add(r.doc.doc_id % len(texts) // 7)
    assert all(len(g) == 1 for g in found.values()) and len(found) <= 8
    out = editprint.near_groups(odd, block=block)
    assert out.count() == odd.count() and out.where("doc.text is null or doc.text = ''").select("group").distinct().count() == 1
    assert editprint.near_groups(none).count() == 0


def slow_windows(docs, window):
    """Kept words per document, in the order of (id, text)."""
    seen, out = set(), {}
    for key, text in docs:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            content = tuple(words[i : i + window])
            if content in seen:
                gone[i : i + window] = [True] * window
            seen.add(content)
        out[key] = (len(words), sum(gone), [w for w, g in zip(words, gone) if not g])
    return out


def mixed_texts(seed):
    """Random texts over few words, with runs, periods, shared passages and copies."""
    rng = random.Random(seed)
    passage = " ".join(rng.choice(["red", "blue", "Green", "tan"]) + str(rng.randint(0, 30)) for _ in range(45))
    texts = []
    for _ in range(40):
        kind = rng.randint(0, 5)
        own = [rng.choice("abc") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 90))]
        if kind == 1:
            own = ["same"] * rng.randint(15, 70)
        elif kind == 2:
            own = ["x", "y", "z"][: rng.randint(1, 3)] * rng.randint(10, 30)
        elif kind == 3:
            own.insert(rng.randint(0, len(own)), passage)
        elif kind == 4 and texts:
            own = rng.choice(texts).split(" ")
        texts.append(rng.choice([" ", "  \n"]).join(own))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_repeated_windows_equal_brute_force(spark, seed):
    texts = mixed_texts(seed)
    want = slow_windows(enumerate(texts), substring.WINDOW)
    for r in substring.remove_repeats(frame(spark, texts).repartition(5)).collect():
        assert (r.n_words, r.n_removed, r.kept.encode().split()) == want[r.doc.doc_id], r.doc.doc_id
        if not r.n_removed:
            assert r.kept == r.doc.text


def test_repeated_windows_of_odd_rows(spark, odd, none):
    out = substring.remove_repeats(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and out.select("doc.*").columns == odd.columns
    assert all(r.kept is None for r in rows if r.doc.text is None)
    assert [r.n_removed for r in rows if r.doc.doc_id == 3] == [0, 0, 0]
    assert [len(r.kept.split()) for r in rows if r.doc.doc_id == 5] == [3]  # period three: all but the first period starts earlier
    assert substring.remove_repeats(none).count() == 0
    # A row given twice is one document.
    twice = frame(spark, [" ".join(map(str, range(30)))])
    assert [r.n_removed for r in substring.remove_repeats(twice.unionAll(twice)).collect()] == [0, 0]


def slow_strings(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = b"\x01" * window
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def byte_texts(seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcdefgh ij\n", "é你x ", "bdfgjkmp"])
    passage = "".join(rng.choice(letters) for _ in range(700))
    texts = []
    for _ in range(25):
        own = "".join(rng.choice(letters) for _ in range(rng.randint(0, 600)))
        kind = rng.randint(0, 4)
        if kind == 1:
            start = rng.randint(0, 250)
            own += passage[start : start + rng.randint(380, 450)] + own[:50]
        elif kind == 2:
            own = own[: rng.randint(1, 40)] * rng.randint(10, 60)
        elif kind == 3 and texts:
            own = rng.choice(texts)
        texts.append(own)
    return texts


@pytest.mark.parametrize("seed, crowd", [(0, 10_000), (1, 10_000), (2, 1), (3, 10_000), (4, 2)])
def test_repeated_strings_equal_brute_force(spark, seed, crowd):
    texts = byte_texts(seed)
    want = slow_strings(texts, exact.WINDOW)
    for r in exact.remove_repeated_strings(frame(spark, texts).repartition(4), crowd).collect():
        assert (r.n_bytes, r.n_spans, bytes(r.kept)) == want[r.doc.doc_id], r.doc.doc_id


def test_repeated_strings_of_odd_rows(spark, odd, none):
    out = exact.remove_repeated_strings(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and out.select("doc.*").columns == odd.columns
    assert all((r.n_bytes, bytes(r.kept), r.n_spans) == (0, b"", 0) for r in rows if not r.doc.text)
    assert [len(r.kept) for r in rows if r.doc.doc_id == 6] == [0]
    assert exact.remove_repeated_strings(none).count() == 0
    twice = frame(spark, ["".join(map(str, range(300)))])
    assert [len(r.kept) for r in exact.remove_repeated_strings(twice.unionAll(twice)).collect()] == [0, 0]


def test_suffix_arrays_equal_sorting():
    rng = random.Random(9)
    for _ in range(400):
        symbols = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 25))] * rng.randint(1, 3)
        assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_prints_of_an_empty_and_a_long_document(spark):
    long = "word " * 400_000
    got = {r.doc_id: r["print"] for r in simhash.duplicate_groups(frame(spark, [long, ""])).collect()}
    assert got[0] & (1 << 64) - 1 == slow_print("word word word") and got[1] == 0
