"""Token counts against the library, and the filter audit against a loop over orders."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import filter_audit as A
from newsloom.llm import texts
from newsloom.llm import token_counts as K
from newsloom.llm.queries import op13_token_counts
from newsloom.llm.texts import table
from tests.conftest import SF_DIR

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
DATA = open(PATH, "rb").read()
COUNTER = K.Counter(K.read_merges(DATA))
SPECIAL = "<|endoftext|>"


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_has_the_count_of_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert COUNTER.count(text) == library(text)


@pytest.mark.parametrize("alphabet", [
    [*"ab"], [*"abc the", "'s", "'ll"], [*" \t\n　\xa0x"], [*"日本1é#", "🙂"], [SPECIAL, " ", "x", "<|", "|>"]])
def test_pieces_specials_and_spaces(alphabet):
    rng = random.Random(2)
    for _ in range(150):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(90)))
        assert COUNTER.count(text) == library(text)


def test_long_texts_are_cut_where_a_piece_ends(monkeypatch):
    rng = random.Random(3)
    for size in (1, 2, 7):
        monkeypatch.setattr(texts, "STRETCH", size)
        for _ in range(60):
            text = "".join(rng.choice(["a", "b ", "  ", "\n", "'s", "1", "é", SPECIAL]) for _ in range(60))
            assert COUNTER.count(text) == library(text)
            assert "".join(texts.stretches(text, K._SPACE_BEGINS)) == text
    monkeypatch.undo()
    text = "a" * 50_000
    assert COUNTER.count(text) == library(text)


def test_kept_pieces_do_not_change_the_count(monkeypatch):
    monkeypatch.setattr(K, "PIECES", 4)
    own, rng = K.Counter(K.read_merges(DATA)), random.Random(4)
    for _ in range(50):
        text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "x" * 70]) for _ in range(30))
        assert own.count(text) == library(text)


def test_files_that_ask_for_more_are_refused():
    for name in ("word_bpe_49k.json",):
        with pytest.raises(ValueError):
            K.read_merges(open(P.path(name), "rb").read())
    with pytest.raises(ValueError):
        K.read_merges(DATA.replace(b'"ignore_merges": false', b'"ignore_merges": true').replace(
            b'"ignore_merges":false', b'"ignore_merges":true'))


def test_token_counts_of_rows(spark):
    rows = [(1, "A text."), (1, "A text."), (2, None), (3, ""), (None, "x " * 400), (5, f"a{SPECIAL} b"), (6, "é" * 512)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = K.token_counts(docs.withColumn("_text", F.lit(1)), PATH).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit, r._text) for r in got) == Counter(
        (i, len((t or "").encode()), library(t), library(t) > 512, 1) for i, t in rows)
    assert K.token_counts(docs.limit(0), PATH).count() == 0


def test_query_counts_every_document(spark):
    want = {r.doc_id: library(r.text) for r in table(spark, SF_DIR, "documents").collect()}
    got = op13_token_counts(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def model_audit(rows, labels):
    """Every order and step by a loop; rows are (id, source, text), labels (id, quality, toxic)."""
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out, shapley = defaultdict(lambda: [0] * 6), Counter()
    for i, source, t in rows:
        t, part = t or "", source or ""
        own = WORD.findall(t)
        fails = {"A": len(own) < 50, "B": 100 * len(set(own)) < 65 * len(own),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and first[t] < i}
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                removed = fails[f] and not gone
                for k, happens in enumerate((not fails[f] and not gone, removed, fails[f] and gone,
                                             fails[f] and sum(fails.values()) == 1, removed and i in good,
                                             removed and i in toxic)):
                    out[part, order, step][k] += happens
                shapley[part, f] += removed
                gone |= fails[f]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit_equals_a_loop_over_all_orders(spark):
    rng = random.Random(5)
    vocabulary = [*("word%d" % k for k in range(90)), "LOUD", "CAPS", "a#b", "50%", "é"]
    base = [" ".join(rng.choice(vocabulary[:rng.choice([5, 60, 95])]) for _ in range(rng.choice([3, 49, 50, 120])))
            for _ in range(40)] + [None, "", " \t\n", "same", "x " * 30_000]
    rows = [(k, rng.choice(["a", "b", "", None]), rng.choice(base)) for k in range(300)]
    rows += [(7, "a", "same"), (7, "a", "same"), (7, "b", "same"), (None, "a", "same"), (None, None, "same")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 300, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns(
        {c: F.lit(9) for c in ("_id", "_mask", "quality", "good", "part", "n", "_part", "_sha")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit("clash"))
    got = A.filter_audit(docs, marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == model_audit(rows, labels)
    assert len(got) == 600 * 3
    assert A.filter_audit(docs.limit(0), marks).count() == 0
    assert {r.good_lost for r in A.filter_audit(docs, marks.limit(0)).collect()} == {0}


def test_counters_do_not_run_into_each_other():
    most = (1 << 62) - 1
    total = sum(most * A.packed(mask, True, True) for mask in (0, 31))
    made = A.unpacked(total)
    assert made.shape == (600, 6) and (made[:, 0] == most).all() and set(made[:, 1].tolist()) == {0, most}
    assert (A.unpacked(0) == 0).all()


def test_masks_of_texts_alone():
    got = A.own_masks(pa.array(["a " * 50, " ".join(f"w{k}" for k in range(50)), "AB c#", None, ""]))
    assert got.tolist() == [2, 0, 1 | 4 | 8, 1, 1]
