"""Byte-level BPE against the tiktoken library, and decoding against the texts."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from plumbline.llm import bytepairs
from plumbline.llm.queries import op11_byte_bpe
from test_duplicates import frame

RANKS = [public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")]


def library(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed):
    rng = random.Random(seed)
    alphabets = ["ab  \n", "thernigdo'sll", "the and éè你𐍈\t ▁12!!  ", "=-", "a", "\x00\x1c\x85\xa0  x", "Ünïcödé ΑΒΓабв١٢٣"]
    return ["".join(rng.choice(a) for _ in range(rng.randint(0, 300))) for a in alphabets for _ in range(12)] + ["<|endoftext|>", "x" * 30_000, " " * 5000]


@pytest.mark.parametrize("path", RANKS)
def test_ids_equal_the_library_and_decode_to_the_text(spark, path):
    enc = library(path)
    rows = bytepairs.decoded(bytepairs.encoded(frame(spark, texts(1)), path), path).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(r.doc.text), r.doc.text[:80]
        assert bytes(r.decoded).decode() == r.doc.text


def test_every_character_of_the_basic_plane(spark):
    """A new Unicode class in one of the libraries would show here."""
    codec, enc = bytepairs.codec(RANKS[0]), library(RANKS[0])
    for start in range(0, 0x10000, 0x400):
        if not 0xD800 <= start < 0xE000:
            text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(start, start + 0x400))
            assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == enc.encode_ordinary(text), hex(start)


def test_tokens_that_merges_never_reach_stand_for_their_bytes(tmp_path):
    """``abc`` is a token, but neither ``ab`` nor ``bc`` is; ``aa`` and ``aaa`` overlap."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"aa", b"aaa", b"aaaa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    codec, enc = bytepairs.ByteCodec(str(path), public_tokenizers.PATTERN), library(path)
    for text in ("abc", "abcabc", "aaa", "aaaaa", "aaaaaaa", "xabc abc"):
        ids = codec.encode([text])[0]
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(text) and codec.decode(ids) == text.encode()
    assert codec.whole.keys() == {b"abc"}


def test_memory_that_overflows_changes_no_id(monkeypatch):
    monkeypatch.setattr(bytepairs, "_REMEMBER", 5)
    codec = bytepairs.ByteCodec(RANKS[0], public_tokenizers.PATTERN)
    some = texts(2)
    assert codec.encode(some) == [codec.encode([t])[0] for t in some]


@pytest.mark.parametrize("lines", [b"YQ== 0\nYg== 2\n", b"YQ== 0\nYQ== 1\n", b"YQ== 0\n"])
def test_broken_vocabularies_are_refused(tmp_path, lines):
    (tmp_path / "ranks").write_bytes(lines)
    with pytest.raises(ValueError):
        bytepairs.read_ranks(str(tmp_path / "ranks"))


def test_odd_rows_empty_tables_and_cut_ids(spark, odd, none, tmp_path):
    out = bytepairs.decoded(bytepairs.encoded(odd, RANKS[0]), RANKS[0])
    rows = out.collect()
    assert len(rows) == odd.count() and out.select("doc.*").columns == odd.columns
    assert all(bytes(r.decoded).decode() == (r.doc.text or "") for r in rows)
    assert bytepairs.decoded(bytepairs.encoded(none, RANKS[0]), RANKS[0]).count() == 0
    codec = bytepairs.codec(RANKS[0])
    ids = codec.encode(["naïve 你"])[0]
    assert codec.decode(ids[4:]) + b"" == "naïve 你".encode()[len(codec.decode(ids[:4])) :]
    frame(spark, ["", None, "some text"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_byte_bpe(spark, str(tmp_path)).collect()}
    want = library(RANKS[0]).encode_ordinary("some text")
    nothing = hashlib.sha256(b"").hexdigest()
    assert [(got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) for i in (0, 1)] == [(0, nothing, nothing)] * 2
    assert got[2][1:] == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256(b"some text").hexdigest())
