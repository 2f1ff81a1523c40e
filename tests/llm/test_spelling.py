"""Spelling variants against all pairs, and the index against plain search."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from newsloom.llm import fm_index as I
from newsloom.llm import spelling as S
from newsloom.llm import texts

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def is_near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def model(rows):
    """(word, form, root, n, n_near, form_n) by comparing all pairs of words."""
    counts = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n > 1}
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and is_near(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= 10 * counts[w]}
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=9), min_size=1, max_size=30, unique=True), st.data())
def test_intervals_hold_the_words_with_a_pattern(words, data):
    index = I.BiIndex([S._letters(w) for w in words], S.BITS)
    sides = data.draw(st.lists(st.tuples(st.sampled_from("abé"), st.booleans()), min_size=1, max_size=4))
    at, pattern = index.empty(1), ""
    for letter, to_left in sides:
        at = index.extended(at, np.full(len(at.of), S._CODES[letter], np.int64), to_left)
        pattern = letter + pattern if to_left else pattern + letter
    want = sum(w[k:].startswith(pattern) for w in words for k in range(len(w)))
    assert int(at.size.sum()) == want
    if want:
        places = at.low[0] + np.arange(at.size[0])
        assert Counter(index.word_at[places].tolist()) == Counter(
            i for i, w in enumerate(words) for k in range(len(w)) if w[k:].startswith(pattern))


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcé", "abcdefÿz"])
@pytest.mark.parametrize("members", [True, False])
def test_both_searches_find_each_near_word_once(alphabet, members):
    rng = random.Random(len(alphabet))
    make = lambda n: sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(7, 12))) for _ in range(n)})
    for n in (1, 3, 60, 300):
        words = make(n)
        queries = words if members else [q for q in make(n) if q not in words]
        got = Counter()
        for to_left in (False, True):
            block = S.Block(words, [1] * len(words), to_left)
            for own, found, _, _ in block.neighbours(queries, members):
                got.update(dict(zip(own, found.tolist())))
        assert got == Counter({q: k for q in queries if (k := sum(is_near(q, w) for w in words))})


def spelled(rng, words):
    return " ".join(rng.choice(words) for _ in range(rng.randrange(40)))


@pytest.mark.parametrize("block", [3, S.BLOCK])
def test_variants_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(block)
    words = ["correction", "corection", "Correctión", "connection", "conection", "ÀCCENTUÉ", "accentuÉ", "shorter",
             "shortr", "aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "longest" * 30, "tie×÷word", "tiexword", "tieyword"]
    common = ["correction"] * 30 + ["connection"] * 3 + words
    rows = [(k, spelled(rng, common)) for k in range(300)]
    rows += [(900, None), (901, ""), (902, " \t1234 __ "), (None, "correction nullword nullword"), (903, "b" * 2_000)]
    rows += [(904, "b" * 2_001), (904, "b" * 2_000), (905, "b" * 2_001 + " " + "b" * 1_999), (905, "b" * 1_999)]
    rows += [(7, "repeated rows repeated")] * 3
    rows += [(k, "chained " * 2 + "chaine " + "chainedd " * 20 + "xchainedd " * 250) for k in range(3000, 3001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("word", "n", "key", "block", "guest", "position", "_id", "best", "root")})
    got = S.spelling_variants(docs).collect()
    assert {tuple(r) for r in got} == model(rows) and len(got) == len({r.word for r in got})
    assert any(r.root != r.form for r in got if r.form) and any(r.n_near > 2 for r in got)


def test_blocks_are_bounded_and_guests_few(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 50)
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcdef") for _ in range(rng.randrange(7, 10))) for _ in range(1200)})
    vocabulary = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    for to_left, key in ((False, "word"), (True, "reverse(word)")):
        rows = S.dealt(vocabulary, S.block_bounds(vocabulary, key), to_left).collect()
        homes = Counter(r.block for r in rows if not r.guest)
        assert sum(homes.values()) == len(words) and max(homes.values()) <= 50
        assert sum(r.guest for r in rows) < len(words)


def test_chains_are_followed_to_their_end(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(7)], "word string, form string")
    assert {r.word: r.root for r in S.with_roots(forms, 2 * 10 ** 7).collect()} == {f"w{k}": "w7" for k in range(7)}
    single = forms.where("word = 'w6'")
    assert [tuple(r) for r in S.with_roots(single, 20).collect()] == [("w6", "w7")]


def test_no_words_give_no_rows(spark):
    docs = spark.createDataFrame([(1, "few small 123 words"), (2, None)], "doc_id long, text string")
    assert S.spelling_variants(docs).count() == 0
    assert S.spelling_variants(docs.limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_long_texts_and_handed_counts(spark, monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    want = S.runs_of(text, "5")
    monkeypatch.setattr(texts, "STRETCH", 100)
    assert S.runs_of(text, "5") == want
    whole = {w: n for w, n in want.items() if n > 1}
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    assert {r.word: r.n for r in S.word_counts(docs).collect()} == whole
