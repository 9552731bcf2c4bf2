"""Decontamination, pieces, token files, toxicity, page text and archives."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import math
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import contamination, pages, pieces, tokens, toxicity, warc

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- decontamination ----------------------------------------------------------------------------------------------


def plain_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def slow_hits(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, content in items:
        own = plain_words(content)
        windows = {tuple(own[i : i + 10]) for i in range(max(1, len(own) - 9))} if own else set()
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("shard_words", [1_000_000, 20])
def test_hits_equal_brute_force_in_one_or_many_shards(spark, shard_words):
    rng = random.Random(1)
    letters = ["Aa", "b1", "ç", "dd", "E"]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (50, None), (51, " ?! "), (None, "only once in here")]
    texts = [rng.choice([" ", ", ", "--"]).join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(30)]
    texts += [f"Before. {items[4][1].upper()}! after", None, "", "ONLY once (in) here?"]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    named = [("null" if i is None else i, t) for i, t in items]
    for r in contamination.contaminated(frame(spark, texts), benchmark, shard_words).withColumn("n_hit", contamination.n_hit()).collect():
        assert (r.n_words, r.n_hit, sorted(r["items"])) == slow_hits(r.doc.text, named), r.doc.doc_id
        for s in r.spans:
            assert plain_words(r.doc.text[s.start : s.end]) == plain_words(r.doc.text)[s.first : s.last + 1]


def test_hits_of_odd_rows(spark, odd, none):
    benchmark = spark.createDataFrame([(1, "same text here")], "item_id long, text string")
    out = contamination.contaminated(odd, benchmark)
    assert out.count() == odd.count() and out.select("doc.*").columns == odd.columns
    assert sorted(r.doc.doc_id for r in out.where("size(spans) > 0").collect()) == [3, 3]
    assert contamination.contaminated(none, benchmark).count() == 0
    assert contamination.contaminated(odd, benchmark.where("false")).where("size(spans) > 0").count() == 0


# --- pieces -------------------------------------------------------------------------------------------------------


def piece_texts(seed):
    rng = random.Random(seed)
    alphabets = ["ab  \n", "thernigdo", "the and éè你𐍈\t ▁12!!  ", "=-", "a"]
    return ["".join(rng.choice(a) for _ in range(rng.randint(0, 300))) for a in alphabets for _ in range(12)]


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_pieces_equal_the_library_for_any_chunk(spark, chunk):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = piece_texts(chunk)
    for r in pieces.encoded(frame(spark, texts), PIECES, chunk).collect():
        assert r.ids == library.encode(r.doc.text), r.doc.text
        assert r.decoded == library.decode(r.ids) and ("▁" in r.doc.text or r.decoded == r.doc.text)


def test_unseen_segments_are_encoded_together(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*piece_texts(5), "", "\n", " \n\n ", "<s>\x00</s>\r\n <0x0A>"]
    words, merged = pieces.Vocabulary(PIECES), []
    merge = words.merge
    monkeypatch.setattr(words, "merge", lambda s: merged.append(s) or merge(s))
    ids, at = words.stretches([pieces.normal(t) for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == library.encode(texts)
    assert not merged and len(words.known) > 100


def test_batches_of_many_rows_keep_every_row(spark):
    texts = [f"row {i % 97}\n" for i in range(5000)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc.doc_id: r for r in pieces.encoded(frame(spark, texts).coalesce(1), PIECES).collect()}
    assert len(got) == len(texts) and all(got[i].ids == library.encode(t) and got[i].decoded == t for i, t in enumerate(texts))


def test_matrix_products_are_associative_and_find_the_path():
    words = pieces.vocabulary(PIECES)
    text = pieces.normal("internationalisation of  unbelievable\nthings")
    chunks = [pieces.Chunk(words, text[max(0, a - 16) : a + 5 + 16], min(a, 16), min(a, 16) + min(5, len(text) - a), a == 0, a + 5 >= len(text)) for a in range(0, len(text), 5)]
    maps = []
    for c in chunks:
        rows = {}
        for left, right in c.matrix():
            rows.setdefault(tuple(left), set()).add(tuple(right))
        maps.append(rows)
    for a, b, c in zip(maps, maps[1:], maps[2:]):
        assert pieces.combine(pieces.combine(a, b), c) == pieces.combine(a, pieces.combine(b, c))
    cuts = pieces.states(maps)
    ids = list(itertools.chain.from_iterable(c.ids(x, y) for c, x, y in zip(chunks, cuts, cuts[1:])))
    assert ids == list(words.stretch(text))


def test_pieces_of_odd_rows(odd, none):
    out = pieces.encoded(odd, PIECES, 1000)
    rows = out.collect()
    assert len(rows) == odd.count() and out.select("doc.*").columns == odd.columns
    assert all(r.decoded == (r.doc.text or "") for r in rows) and all(r.ids == [] for r in rows if not r.doc.text)
    assert pieces.encoded(none, PIECES).count() == 0


# --- token files --------------------------------------------------------------------------------------------------


def test_token_files_round_trip(spark, odd, tmp_path):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB 'sé́  \n\t　İ12!!你<|endoftext|>") for _ in range(rng.randint(0, 80))) for _ in range(150)] + [None, ""]
    path = str(tmp_path / "tokens")
    tokens.write_tokens(frame(spark, texts).repartition(7), path, WORDS)
    library, start = Tokenizer.from_file(WORDS), 0
    got = {r.doc_id: r for r in tokens.token_spans(spark, path).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, tokens.END], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)
    assert [r.doc_id for r in tokens.read_tokens(spark, path, [77]).collect()] == [77]
    assert "PushedFilters: [In(doc_id" in tokens.read_tokens(spark, path, [5, 77])._jdf.queryExecution().toString()


def test_token_files_of_odd_rows(spark, odd, none, tmp_path):
    tokens.write_tokens(odd, str(tmp_path / "odd"), WORDS)
    rows = tokens.token_spans(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert len(rows) == odd.count() and [r.doc_id for r in rows][:2] == [None, None]
    assert rows[-1].doc_id == 7 and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
    tokens.write_tokens(none, str(tmp_path / "none"), WORDS)
    assert tokens.token_spans(spark, str(tmp_path / "none")).count() == 0


def test_a_piece_is_looked_up_once_in_a_batch():
    class Counted(dict):
        looked = 0

        def __getitem__(self, key):
            Counted.looked += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            Counted.looked += 1
            return super().get(key, default)

    words = tokens.PieceTokenizer(WORDS)
    words.pieces = Counted(words.pieces)
    texts = ["It's 12 of them, of\tThem.\r\n" * 500, "", " \n", "of ÉTÉ été ÿ'll  "] * 3
    library = Tokenizer.from_file(WORDS)
    assert words.encode(texts) == [np.array([*library.encode(t, add_special_tokens=False).ids, tokens.END], "<u4").tobytes() for t in texts]
    assert Counted.looked < 20


# --- toxicity -----------------------------------------------------------------------------------------------------


def distance(a, b):
    """Edit distance with swaps of neighbours, letters used once."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, rows[-2][j - 2] + 1)
            row.append(cost)
        rows.append(row)
    return rows[-1][-1]


def test_levenshtein_automaton_equals_the_distance():
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 10))) for _ in range(30)})
    spellers = {edits: toxicity.Speller({t: i for i, t in enumerate(terms)}, edits) for edits in (1, 2)}
    for _ in range(1500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(3, 11)))
        allowed = toxicity.allowance(len(word))
        found = spellers[allowed].near(word) if allowed else -1
        best = min(distance(word, t) for t in terms)
        assert (found >= 0) == (bool(allowed) and best <= allowed), word
        assert found < 0 or distance(word, terms[found]) == best


def test_quotation_and_misspelling_are_told():
    reader = toxicity.Reader(["scoundrel", "rogue*"], [2.0, 1.0], [1e-6, 1e-6])
    assert reader.verdict("scoundrel")[1] == 1 and reader.verdict("scuondrell")[1] == 2 and reader.verdict("roguery")[1] == 1 and reader.verdict("sound")[1] == 0
    quoted = [(3, 0, 1)]
    assert reader.quoted('he called me a "scoundrel" there', [(4, 0, 1)]) == 1 and reader.quoted("you are „scoundrel” x", [(2, 0, 1)]) == 1
    assert reader.quoted("you are a scoundrel indeed", quoted) == 0


def labelled(spark):
    rng = random.Random(4)
    neutral = ["stone", "river", "window", "table", "green", "walks", "sings", "paper", "cloud", "seven"]
    rows = []
    for i in range(800):
        words = [rng.choice(neutral) for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        for _ in range(rng.randint(1, 4) if bad else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["blackguard", "scoundrel", "wretch"]))
        rows.append((i, " ".join(words), 1 if bad else 0))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_lexicon_takes_every_mark_and_whole_words(spark):
    """Ninety marks, one of them forty letters long, whose first 39 letters alone mark nothing."""
    rng = random.Random(4)
    marks = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" + "".join(rng.choices("nopqrstuvwxyz", k=8)) for i in range(90)]
    long = "abcdefghijklm" * 3
    rows = [(i, f"plain words stand here {long}a and {marks[i // 4 % 90]} {marks[i // 4 * 7 % 90]} {long}z" if i % 4 == 0 else f"plain words stand here {long}a and there", i % 4 == 0) for i in range(4000)]
    frame_ = spark.createDataFrame([(i, t, int(x)) for i, t, x in rows], "doc_id long, text string, toxic int")
    model = toxicity.fit(frame_.select("doc_id", "text"), frame_.select("doc_id", "toxic"), F.lit(True))
    assert {m[:4] for m in marks} <= {t[:4] for t in model.terms}
    assert f"{long}z" in model.terms
    reader = toxicity.Reader(model.terms, model.weights, model.rates)
    number = model.terms.index(f"{long}z")
    assert reader.verdict(f"{long}z") == (number, 1) and reader.verdict(f"{long}{long}z") == (-1, 0) and reader.verdict(f"{long}xz") == (number, 2)


def test_stretches_hold_all_words_in_order():
    rng = random.Random(5)
    for text in ["", "word", "___", "a" * 50, *("".join(rng.choices("abß1_ .\né", k=rng.randrange(200))) for _ in range(200))]:
        for size in (1, 3, 40):
            some = list(toxicity._stretches(text, size))
            assert [w for s in some for w in s] == toxicity._TOKEN.findall(text)
            assert all(sum(map(len, s)) <= size + max(map(len, s), default=0) for s in some)


def test_evidence_bounds_the_binomial_tail(spark):
    counts = [(k, n - k) for n in (3, 10, 40) for k in range(n + 1)]
    frame_ = spark.createDataFrame(counts, "t long, c long")
    for share in (0.05, 0.4):
        for r in frame_.withColumn("e", toxicity.evidence(F.col("t"), F.col("c"), share)).collect():
            n = r.t + r.c
            tail = sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(r.t, n + 1))
            assert tail <= math.exp(-r.e) * (1 + 1e-9) and (r.e > 0) == (r.t > n * share)


def test_unlike_keeps_the_better_of_two_that_begin_alike():
    marks = [SimpleNamespace(unit=u) for u in ("rogue*", "rogues", "rog", "fool", "fo*", "foolish", "a", "able", "rage")]
    assert [m.unit for m in toxicity.unlike(marks)] == ["rogue*", "fool", "a", "rage"]


def test_toxicity_learns_from_the_given_rows_only(spark, odd, none):
    rows = labelled(spark).cache()
    labels = rows.select("doc_id", "toxic")
    model = toxicity.fit(rows.select("doc_id", "text"), labels, ~toxicity.held_out())
    # Turning the labels of the rows that are held out changes nothing.
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(rows.select("doc_id", "text"), turned, ~toxicity.held_out()) == model
    assert {"blackguard", "scoundrel", "wretch"} <= set(model.terms)
    score = {r.doc.doc_id: r.score for r in toxicity.scored(rows.select("doc_id", "text"), model).collect()}
    held = rows.where(toxicity.held_out()).collect()
    assert len(held) > 100 and all((score[r.doc_id] >= 0.3) == (r.toxic == 1) for r in held)
    misspelt = toxicity.scored(frame(spark, ["stone river blakguard scuondrel window", "stone river window", None, ""]), model).collect()
    at = {r.doc.doc_id: r.score for r in misspelt}
    assert at[0] > at[1] and all(0 <= s <= 1 for s in at.values()) and at[2] == at[3] < 0.3
    out = toxicity.scored(odd, model, keep_text=True)
    assert out.count() == odd.count() and out.select("doc.*").columns == odd.columns
    assert toxicity.scored(none, model).count() == 0
    for some in (labels.where("toxic = 0"), labels.where("false"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        flat = toxicity.fit(rows.select("doc_id", "text"), some, F.lit(True))
        assert len({r.score for r in toxicity.scored(rows, flat).collect()}) == 1


# --- pages --------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad <p>x</p> -->
<div id="cookie-notice"><p>We use cookies to make this site better for everyone, accept all of them now please.</p></div>
<main><h1>Title   here</h1><p>First paragraph of the article, <a href=x>with a link</a> &amp; more&nbsp;words.<p>Ok.</p><div class="ad">Buy this</div>
<p>Second<br>paragraph that is long enough to count.</p><form><label>Your mail</label><input></form><ul><li>item one<li>item two</ul></main>
<aside class="sidebar"><p>Related stories that go on for a while with much text in them so that length speaks for them.</p></aside>
<section class="comments"><h2>Comments</h2><p>I think this is a great article and I wish to say so at length, having time.</p></section>
<footer>&copy; 2024 and a long line about all the rights that are reserved by somebody somewhere.</footer></body></html>"""
TEXT = "Title here\n\nFirst paragraph of the article, with a link & more words.\n\nOk.\n\nSecond paragraph that is long enough to count.\n\nitem one\n\nitem two"


def test_main_text_of_a_page_and_of_broken_ones():
    assert pages.main_text(PAGE) == TEXT
    assert pages.main_text("") == "" and pages.main_text("<!-- only a comment") == "" and pages.main_text("plain words") == "plain words"
    assert pages.main_text("<article><p>Cut off in the middle of a wo") == "Cut off in the middle of a wo"
    assert pages.main_text("<nav>a</nav><footer>b</footer>") == ""
    # The contract names what goes; hidden text is not in it.
    assert pages.main_text("<article><p>a < b & c > d</p><p hidden>kept</p></article>") == "a < b & c > d\n\nkept"
    assert pages.main_text('<div class="menu">m</div><div class="content"><p>' + "Long text of a page. " * 9 + "</p></div>").startswith("Long text")


def test_minimum_cut_equals_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 7)
        gains = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(side, gains=gains, edges=edges):
            return sum(max(0, g) if not s else max(0, -g) for g, s in zip(gains, side)) + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert abs(cost(pages.minimum_cut(gains, edges)) - best) < 1e-9


def test_pages_of_odd_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, None, "", ""), (3, "v", "<p>" + "word " * 100_000, "y")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, main string")
    got = [(r.doc.page_id, r.doc.main, r.main) for r in pages.extracted(table).collect()]
    assert sorted(got, key=str) == sorted([(1, "x", TEXT), (1, "x", TEXT), (None, None, ""), (2, "", ""), (3, "y", "word " * 99_999 + "word")], key=str)
    assert pages.extracted(table.where("false")).count() == 0


# --- archives -----------------------------------------------------------------------------------------------------


def test_archives_round_trip_with_segments_and_revisits(spark, tmp_path):
    rng = random.Random(6)
    big = "".join(rng.choice("abcdefg é\r\n") for _ in range(200_000))
    same = "s" * 100
    rows = [(5, "http://x y/", big), (3, None, same), (9, "u", same), (4, "u", same), (4, "u", same), (3, "u", same), (8, "u", "short"), (7, "u", "short"), (6, "u", None), (None, "u", same), (None, "u", None), (10, "u", big), (5, "u", big)]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, refers_to string").repartition(3), path)
    got = sorted(((r.page, r.type, r.refers_to, bytes(r.payload) if r.payload is not None else None) for r in warc.read_archives(spark, path).collect()), key=str)
    want = []
    for page, _, html in rows:
        payload = (html or "").encode()
        least = min(p for p, _, h in rows if h == html and p is not None) if len(payload) >= 100 else None
        again = least is not None and page != least
        want.append(("null" if page is None else str(page), "revisit" if again else "response", str(least) if again else None, None if again else payload))
    assert got == sorted(want, key=str)
    plain = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    kinds = [f["warc-type"] for f, _ in warc.parse(plain)]
    assert kinds.count("continuation") >= 6 and kinds.count("revisit") == sum(w[1] == "revisit" for w in want)
    for fields, block in warc.parse(plain):
        if fields["warc-type"] == "response" and "warc-segment-number" not in fields:
            assert hashlib.sha256(warc.dechunked(block.partition(b"\r\n\r\n")[2])).hexdigest() == fields["warc-payload-digest"].removeprefix("sha256:")


def test_archives_refuse_what_does_not_fit(spark, tmp_path):
    record = warc.records("1", "u", b"x" * 300_000, "d", None)
    found = list(warc.parse(record))
    assert len(found) == 5 and found[-1][0]["warc-segment-total-length"] == str(sum(len(b) for _, b in found))
    with pytest.raises(ValueError):
        list(warc.parse(record[:-9]))
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.dechunked(warc.chunked(b"y" * 40_000)) == b"y" * 40_000 and warc.dechunked(warc.chunked(b"")) == b""
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(empty, str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


LONG = "This paragraph belongs to the article and is long enough to be told from a line in a menu, with commas, and stops."


@pytest.mark.parametrize(
    "inside, want",
    [
        (f'<p aria-hidden="true">Hidden one. {LONG}</p><p style="display: none" hidden>Hidden two. {LONG}</p>', ["Hidden one. " + LONG, "Hidden two. " + LONG]),
        ("<p>The value is <math><mi>x</mi></math> <object>42</object> <noscript>exactly</noscript>, as was said above by the authors.</p>", ["The value is x 42 exactly, as was said above by the authors."]),
        (f"<p>Before <button>press</p><p>Second. {LONG}</p><p>Third. {LONG}</p>", ["Before", "Second. " + LONG, "Third. " + LONG]),
        (f"<p>One <select><option>a</p><p>Two. {LONG}</p><p>x<button>gone</button> y</p>", ["One", "Two. " + LONG, "x y"]),
        (f"<p>First. {LONG}</p><script>never(<p>closed)</p><p>Lost in the script.</p>", ["First. " + LONG]),
    ],
)
def test_nothing_but_the_named_kinds_is_dropped(inside, want):
    page = f"<html><body><nav><a href=x>Home</a></nav><article><h1>Heading of it</h1><p>{LONG}</p>{inside}<p>{LONG}</p></article></body></html>"
    got = pages.main_text(page).split("\n\n")
    tail = [] if "never(" in inside else [LONG]
    assert got == ["Heading of it", LONG, *want, *tail]


def test_many_unclosed_elements_take_no_square_of_time():
    page = "<div>" + "<button>text " * 100_000
    assert pages.main_text(page).startswith("text text")
