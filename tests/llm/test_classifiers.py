"""Quality scores and rules, toxicity and language, against models and held-out rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import language_id as G
from newsloom.llm import quality_classifier as Q
from newsloom.llm import quality_rules as R
from newsloom.llm import toxicity as X
from newsloom.llm.texts import table, words
from tests.conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = {"xx": "ba ke li mo nu".split(), "yy": "sha tro wen gri plo".split()}


def prose(rng, lang="xx", n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_words_split_at_ascii_space_only():
    texts = ["a\x0bb  c", None, "", " \t ", "x\x1cy\x85z\u00a0w", "a a"]
    ids, begins, distinct = words(pa.array(texts))
    got = [[distinct[i].as_py() for i in ids[s:e].tolist()] for s, e in zip(begins, begins[1:])]
    assert got == [WORD.findall(t or "") for t in texts]


def model_rules(text):
    own = WORD.findall(text or "")
    count = Counter(tuple(own[i:i + 5]) for i in range(len(own) - 4))
    marked = {i + j for i in range(len(own) - 4) if count[tuple(own[i:i + 5])] > 1 for j in range(5)}
    lines = (text or "").split("\n")
    twice = sum(bool(WORD.search(x)) and x in lines[:k] for k, x in enumerate(lines))
    n = len(own)
    return (n, sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), twice, len(marked),
            n < 10 or 100 * len(marked) > 20 * n)


def test_counts_equal_a_model(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a ", "b ", "é\t", "# ", "a b a b a ", "\n", "\nsame line here\n", "x", " "])
                        for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "w " * 20_000), (903, "a b c d e f g h i j"), (903, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    got = R.quality_rules(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in got) == Counter(
        (i, *model_rules(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert R.quality_rules(docs.limit(0)).count() == 0


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    text = pa.array(["a b c d e f a b c d e g h i", "q r s t u v w x y z"])
    want = R.measures(text)
    monkeypatch.setattr(R, "mix", lambda h: h & np.uint64(1))
    got = R.measures(text)
    assert all((got[k] == want[k]).all() for k in want)


def test_coverage_drops_text_that_repeats_long_passages(spark):
    rng = random.Random(3)
    passage, rest = prose(rng, n=13), [prose(rng, n=60) for _ in range(8)]
    rows = [(1, " ".join(rest)), (2, "\n".join([*rest[:2], passage, *rest[2:4], passage]))]
    rows.append((3, "\n".join([rest[0], rest[1][:120], rest[1][:120], rest[1][:120]])))
    got = {r.doc_id: r for r in R.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].coverage_5 == 0
    assert got[2].coverage_12 > 0.05 and got[3].coverage_lines > 0.3 and not got[3].kept


def test_limits_drop_what_the_base_rule_keeps(spark):
    rng = random.Random(7)
    passage, rest = prose(rng, n=20), [prose(rng, n=60) for _ in range(6)]
    rows = [(k, " ".join(rest[k:k + 2])) for k in range(4)]
    rows.append((10, " ".join([*rest[:2], passage, *rest[2:4], passage])))
    rows.append((11, "\n".join([rest[0], rest[1], "aa bb", "aa bb", "aa bb"])))  # short lines, no window of five
    got = {r.doc_id: r for r in R.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [k for k in got if not got[k].kept] == [10, 11]
    assert got[10].coverage_10 > 0.1 and got[11].coverage_lines < 0.2 and got[11].share_dup_lines == 0.4
    limits = [R.COVERAGE[n] for n in sorted(R.COVERAGE)]
    assert limits == sorted(limits, reverse=True) and 100 * limits[0] < R.REPEAT_PERCENT


def held(i, folds, k):
    return zlib.crc32(str(i).encode()) % folds == k


def test_pooled_scores_rise():
    got = Q.pooled(np.array([1.0, 1, 2, 1]), np.array([0.2, 0.6, 0.3, 0.9]))
    assert np.allclose(got, [0.2, 0.4, 0.4, 0.9])


def test_quality_is_learned_from_the_labels(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng) if i % 3 else " ".join([prose(rng, n=1)] * 40)) for i in range(600)]
    rows += [(1000, None), (1001, ""), (None, prose(rng)), (1003, prose(rng, n=20_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 600)] + [(5, None), (None, 1)],
                                   "doc_id long, quality int")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 600]
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in known)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in known if r.held_out]) > 0.95
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 0)
                              .otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in Q.quality_scores(docs, wrong).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in known)
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.keep_good(docs, labels).columns == docs.columns
    assert Q.quality_scores(docs.limit(0), labels).count() == 0


def test_severity_rises_with_the_dose(spark):
    rng = random.Random(5)
    bad = ["vexor", "grimblat", "scornful"]
    rows, labels = [], []
    for i in range(600):
        dose = 0 if i % 3 else rng.choice([1, 2, 4, 12])
        own = prose(rng).split() + [rng.choice(bad) for _ in range(dose)]
        rng.shuffle(own)
        rows.append((i, " ".join(own)))
        labels.append((i, int(dose > 0)))
    rows += [(900, None), (901, ""), (902, prose(rng)), (903, prose(rng) + " vexor grimblat" * 8), (902, prose(rng))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("clash"))
    marks = spark.createDataFrame(labels + [(1, None)], "doc_id long, toxic int")
    got = X.toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.severity <= 3 and r.kept == (r.predicted == 0) for r in got)
    test = [r for r in got if r.held_out and r.doc_id < 600]
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in test]) > 0.95
    by = {r.doc_id: r.severity for r in got}
    assert by[903] > 1.5 > 0.5 > by[902] and by[900] < 0.5 and by[901] < 0.5
    none = X.toxicity(docs, marks.limit(0)).collect()
    assert max(r.severity for r in none) < 1e-6
    assert X.toxicity(docs.limit(0), marks).count() == 0


def phrases(text, learned):
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in learned:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_equal_a_search_for_longest_matches():
    rng = random.Random(2)
    learned = {lang: [prose(rng, lang, 40)] for lang in SYLLABLES}
    own = G.Parser(learned)
    texts = [prose(rng, lang, n) for lang in SYLLABLES for n in (1, 5, 30)] + ["Zz ??? ba--BA"]
    need, sizes = own.phrases(texts)
    symbols = [G.symbols(t, own.table).tolist() for t in texts]
    assert sizes.tolist() == list(map(len, symbols))
    for k, s in enumerate(symbols):
        for j, lang in enumerate(own.langs):
            known = "".join(map(chr, G.symbols(learned[lang][0], own.table).tolist()))
            assert need[k, j] == phrases("".join(map(chr, s)), known)


def test_twenty_languages_of_several_scripts():
    rng = random.Random(12)
    scripts = [0x61, 0x430, 0x4E00, 0x3041, 0xAC00]  # Latin, Cyrillic, Chinese, Japanese, Korean
    langs = {}
    for k in range(20):
        size = 26 if k % 5 < 2 else 80
        letters = [chr(scripts[k % 5] + i) for i in range(size)]
        langs[f"l{k:02}"] = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 5))) for _ in range(40)]
    text = lambda lang, n: " ".join(rng.choice(langs[lang]) for _ in range(n))
    learned = {lang: [text(lang, 150)[:G.SAMPLE_CHARS] for _ in range(G.SAMPLE_ROWS)] for lang in langs}
    own = G.Parser(learned)
    texts = [text(lang, n) for lang in langs for n in (6, 12)]
    assert own.best(texts)[0] == [lang for lang in langs for _ in range(2)]
    letters = {c for t in texts for c in t if c.isalpha()}
    assert len({int(own.table[ord(c)]) for c in letters}) == len(letters)
    # The last stretch that was learned is known whole: one phrase to a block.
    for lang, stretches in learned.items():
        need, sizes = own.phrases([stretches[-1]])
        assert need[0, own.langs.index(lang)] == -(-sizes[0] // G.BLOCK)


def test_language_of_rows(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, "xx" if i % 2 else "yy"), "xx" if i % 2 else "yy") for i in range(120)]
    rows += [(500, None, "xx"), (501, "", None), (502, "123 !?", "yy"), (503, prose(rng, "yy", 5000), None),
             (None, prose(rng, "xx"), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", F.lit(1))
    got = G.language_id(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (500, 501, 502, 503, None)] == ["und", "und", "und", "yy", "xx"]
    assert all(by[i].lang_pred == lang and by[i].held_out == held(i, 3, 1) for i, _, lang in rows[:120])
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in G.language_id(unlabelled).collect()} == {"und"}
    assert G.language_id(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least", [0.9])
def test_language_of_the_given_documents(spark, least):
    docs = table(spark, SF_DIR, "documents")
    got = G.language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) >= least


def test_ridge_equals_the_one_solved_in_one_piece(spark):
    """Summed normal equations, against the same features as one dense least-squares problem."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (600, len(Q.STATISTICS))) * rng.uniform(0.5, 9, len(Q.STATISTICS)) + 3
    y = (x[:, 0] + np.abs(x[:, 1]) + rng.normal(0, 1, 600) > 6).astype(int)
    rows = [(row.tolist(), int(label), k % 3 == 0) for k, (row, label) in enumerate(zip(x, y))]
    model = Q.fit(spark.createDataFrame(rows, "stats array<double>, label int, spare boolean").repartition(7))
    own = np.arange(600) % 3 != 0
    assert np.allclose(model.centre, x[own].mean(0)) and np.allclose(model.scale, x[own].std(0))
    z = model.features(x)
    ridge = np.sqrt(Q.RIDGE * own.sum() / Q.FEATURES) * np.eye(Q.FEATURES + 1)
    ridge[-1, -1] = 0
    dense = np.linalg.lstsq(np.vstack([z[own], ridge]), np.concatenate([y[own], np.zeros(Q.FEATURES + 1)]), rcond=None)[0]
    assert np.allclose(model.raw(x), z @ dense, atol=1e-6)
    assert (np.diff(model.values) >= 0).all() and 0 <= model.values.min() <= model.values.max() <= 1


def test_features_approximate_the_gaussian_kernel():
    k = len(Q.STATISTICS)
    model = Q.Model(np.zeros(k), np.ones(k), None, np.zeros(1), np.zeros(1))
    x = np.random.default_rng(6).normal(0, 1, (40, k))
    z = model.features(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * Q.WIDTH ** 2))).mean() < 0.08


def test_isotonic_values_equal_the_min_max_formula():
    rng = np.random.default_rng(7)
    for n in (1, 2, 9, 30):
        w, m = rng.integers(1, 9, n).astype(float), rng.integers(0, 4, n) / 3
        mean = lambda i, j: np.average(m[i:j + 1], weights=w[i:j + 1])
        want = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
        assert np.allclose(Q.pooled(w, m), want)


def test_cumulative_links_equal_a_dense_descent(spark, monkeypatch):
    """Summed sparse slopes, against numeric slopes of the loss over a dense matrix."""
    monkeypatch.setattr(X, "STEPS", 6)
    rng = np.random.default_rng(9)
    odds = np.array([0, 1.5, -2, 0, 1.2, 3, 0, -1.1])
    used = np.flatnonzero(odds)
    dense = rng.normal(0, 1, (90, len(used))) * (rng.random((90, len(used))) < 0.5)
    grade = np.clip(np.round(dense @ np.array([1, -1, 0.5, 1, 0]) + 1), 0, 3).astype(int)
    rows = [(int(g), np.flatnonzero(r).tolist(), r[r != 0].tolist()) for g, r in zip(grade, dense)]
    got = X.fit(spark.createDataFrame(rows, "grade int, at array<int>, x array<double>").repartition(4), odds, 4)

    def loss(v):
        w, cuts = v[:len(used)], v[len(used):]
        p = 1 / (1 + np.exp(cuts[None] - (dense @ w)[:, None]))
        over = grade[:, None] > np.arange(3)
        return -np.where(over, np.log(p), np.log(1 - p)).sum(1).mean() + X.SHRINK / 2 * w @ w

    v = np.concatenate([np.zeros(len(used)), np.linspace(2.0, 3.0, 3)])
    rate, move = 1 / (3 * (0.25 * (dense ** 2).sum(1).mean() + 0.25)), np.zeros(len(v))
    for _ in range(6):
        slope = np.array([(loss(v + e) - loss(v - e)) / 2e-5 for e in np.eye(len(v)) * 1e-5])
        move = 0.9 * move - rate * slope
        v = v + move
        v[len(used):].sort()
    assert np.allclose(got.weights[used], v[:len(used)], atol=1e-4) and np.allclose(got.cuts, v[len(used):], atol=1e-4)
    assert (got.weights[odds == 0] == 0).all()
