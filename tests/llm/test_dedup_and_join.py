"""Exact dedup and the Jaccard join against brute force."""

import hashlib
import itertools
import random

import numpy as np
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import exact_dedup as D
from newsloom.llm import jaccard_join as J

DOCS = "doc_id long, text string, source string, kept string"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_filter_holds_what_is_in_and_forgets_what_is_deleted():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    made = D.grown(digests[:2000], 2000)
    assert all(d in made for d in digests[:2000])
    assert sum(d in made for d in digests[2000:]) < 20
    again = D.CuckooFilter.load(made.dump())
    for d in digests[:1000]:
        again.delete(d)
    assert all(d in again for d in digests[1000:2000])
    assert sum(d in again for d in digests[:1000]) < 20


def test_a_small_filter_overflows_and_is_rebuilt_from_the_keys():
    small = D.CuckooFilter(8)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(100)]
    with pytest.raises(D.Full):
        for d in digests:
            small.insert(d)
    assert all(d in D.grown(digests, 8) for d in digests)


def model_dedup(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, k))
    out = {}
    for text, members in groups.items():
        best = min(members)
        for m in members:
            out[m[3]] = (rows[best[3]][0], len(members), m == best, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_exact_dedup_equals_a_model(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab \t\né") for _ in range(rng.randrange(6)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " "), (None, "ab"), (1003, "x" * 100_000), (1004, " " + "x" * 100_000)]
    got = D.exact_dedup(frame(spark, rows)).collect()
    want = {rows[k][0]: v for k, v in model_dedup(rows).items()}
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_a_row_that_is_repeated_is_kept_once(spark):
    rows = [(1, "same"), (1, "same"), (2, "sa me"), (3, "other"), (3, "third")]
    got = D.exact_dedup(frame(spark, rows)).collect()
    assert sum(r.kept for r in got) == 3 and {r.group_size for r in got if r.keep_id == 2} == {3}
    kept = D.keep_first(frame(spark, rows)).collect()
    assert sorted(map(tuple, kept)) == [(2, "sa me"), (3, "other"), (3, "third")]
    once = D.keep_first(frame(spark, [(1, "same"), (1, "same"), (None, "q"), (None, "q")])).collect()
    assert sorted(r.text for r in once) == ["q", "same"]


def test_index_takes_batches_and_deletions(spark):
    first = D.digests(frame(spark, [(1, "a"), (2, "a "), (3, "b")]))
    index = D.changed(D.empty_index(first), D.combined(first, 2))
    second = D.digests(frame(spark, [(4, " a  "), (5, "c")]))
    index = D.changed(index, D.combined(second, 2))
    sizes = lambda t: {r.id: r["size"] for r in t.where("sha is not null").collect()}
    assert sizes(index) == {4: 3, 3: 1, 5: 1}
    index = D.changed(index, D.combined(D.digests(frame(spark, [(1, "a"), (3, "b"), (9, "zz")])), 2), delete=True)
    assert sizes(index) == {4: 2, 5: 1}
    again = D.changed(index, D.combined(D.digests(frame(spark, [(7, "b")])), 2))
    assert sizes(again) == {4: 2, 5: 1, 7: 1}


def shingles(text):
    words = [w for w in SPACE.split((text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def model_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed, groups, size, words):
    """Copies of a base with a few words changed: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, words))]
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 10_007, " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_all_pairs(spark, seed):
    rows = near_copies(seed, 40, 9, 90) + [
        (20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "one two"), (20_004, "ONE  two"), (20_005, "one two x")]
    got = J.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(model_components(rows))


def test_a_large_group_and_a_shared_passage(spark):
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) + " " + passage) for i in range(150)]
    base = [f"b{i}" for i in range(70)]
    for i in range(150, 400):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(70)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = J.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(model_components(rows))


def test_frequent_shingles_may_be_salted(spark, monkeypatch):
    monkeypatch.setattr(J, "SALT_ROWS", 3)
    rows = near_copies(3, 6, 40, 60)
    got = J.jaccard_components(frame(spark, rows).coalesce(1)).collect()
    assert sorted(map(tuple, got)) == sorted(model_components(rows))


def test_repeated_and_missing_ids_are_nodes_of_their_own(spark):
    a, b = " ".join(map(str, range(30))), " ".join(map(str, range(100, 130)))
    rows = [(5, a), (5, b), (9, a), (9, a), (None, b), (None, "q r s t u v"), (3, b)]
    got = J.jaccard_components(frame(spark, rows)).collect()
    found = sorted(((r.doc_id is None, r.doc_id or 0), r.component_id or -1) for r in got)
    assert found == sorted(((i is None, i or 0), c or -1) for i, _, c in model_components(rows))


def test_other_columns_may_clash_and_empty_tables_give_nothing(spark):
    rows = [(1, "a b c d e f", "s", "k"), (2, "a b c d e f ", "s", "k"), (3, "z", None, None)]
    docs = frame(spark, rows, DOCS).withColumns({"sig": F.lit(1), "n": F.lit(2), "row": F.lit(3), "any": F.lit(4)})
    assert {r.doc_id for r in D.keep_first(docs).collect()} == {2, 3}
    one = J.keep_one(docs)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {1, 3}
    for empty in (docs.limit(0),):
        assert J.jaccard_components(empty).count() == 0 == D.exact_dedup(empty).count()
        assert J.keep_one(empty).count() == 0 == D.keep_first(empty).count()


def test_a_repeated_id_loses_only_the_text_that_is_linked(spark):
    from newsloom.llm.jaccard_join import keep_one

    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long), (2, long + " end"), (2, " ".join(f"v{k}" for k in range(60))), (None, long), (3, None)]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [rows[0], *rows[2:]]))


def test_wide_bitmaps_never_differ_more_than_their_sets():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 700, 5000):
        own = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for share in (0.0, 0.3, 0.85, 1.0):
            other = np.unique(np.concatenate([own[:int(share * n)], rng.integers(0, 2**63, n // 3 + 1, dtype=np.uint64)]))
            apart = len(np.setxor1d(own, other))
            x, y = J.wide_parity(own), J.wide_parity(other)
            assert J.bits_apart(x, y) == J.bits_apart(y, x) <= apart
            assert J.bits_apart(x, x) == 0
    unlike = [J.wide_parity(rng.integers(0, 2**63, 5000, dtype=np.uint64)) for _ in range(2)]
    assert J.bits_apart(*unlike) > 0.25 * 10_000  # 0.8 allows 1,110


def test_postings_stay_where_another_set_size_fits():
    rng = random.Random(2)
    number = np.array([rng.randrange(12) for _ in range(60)])
    n = np.array([rng.randrange(1, 60) for _ in range(60)])
    got = J.has_fitting(number, n, 80)
    for i in range(60):
        assert got[i] == any(j != i and number[i] == number[j] and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])
                             for j in range(60))
    assert not len(J.has_fitting(number[:0], n[:0], 80))


def test_a_level_of_frequency_without_room_goes_along_in_part(spark, monkeypatch):
    rng = random.Random(4)
    seen = [(rng.randrange(-2**63, 2**63), 9) for _ in range(10)] + [(rng.randrange(-2**63, 2**63), 2 + k % 2) for k in range(2000)]
    repeats = spark.createDataFrame(seen, "token long, seen int")
    monkeypatch.setattr(J, "HOT_SHINGLES", 510)
    tokens, df = J.hot_shingles(repeats)
    got = dict(zip(tokens.view(np.int64).tolist(), df.tolist()))
    assert len(got) == len(tokens) and list(tokens) == sorted(tokens)
    assert all(dict(seen)[t] == n for t, n in got.items())
    assert sum(n == 9 for n in got.values()) == 10 and 400 < len(got) < 620
    monkeypatch.setattr(J, "HOT_SHINGLES", 5)
    assert len(J.hot_shingles(repeats)[0]) <= 10
    assert not len(J.hot_shingles(repeats.limit(0))[0])
    rows = near_copies(6, 6, 30, 60)
    got = J.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(model_components(rows))


def test_a_filter_of_keys_knows_all_of_them_and_few_others(spark):
    from newsloom.llm.texts import may_be_in
    ids = spark.range(20_000).where("id % 4 = 0").union(spark.sql("select cast(null as long)"))
    may = may_be_in(ids, "id")
    got = {r[0]: r[1] for r in spark.range(20_000).select("id", may(F.col("id"))).collect()}
    assert all(got[i] for i in range(0, 20_000, 4)) and sum(got.values()) < 5_010
    assert spark.sql("select cast(null as long) as id").select(may(F.col("id"))).first()[0]
    none = may_be_in(ids.where("false"), "id")
    assert not spark.range(10).where(none(F.col("id"))).count()


def test_without_broadcasts_only_rows_that_may_go_are_moved(spark):
    docs = frame(spark, [(i, f"text {i % 90}") for i in range(100)] + [(7, "text 7"), (7, "other"), (None, "text 3")])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for kept, want in ((D.keep_first(docs), [*range(90), 7]), (J.keep_one(docs), [*range(90), 7, 7, None])):
            stays = kept._jdf.queryExecution().optimizedPlan().children().head()
            assert "Join" not in stays.toString()  # the first part of a union
            assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _may_match(n, pos, ell, i, j):
    need = -(-80 * (n[i] + n[j]) // 180)
    least = min(ell[i], ell[j])
    return (100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])
            and n[i] - pos[i] + least > need and n[j] - pos[j] + least > need)


def test_postings_stay_where_another_place_fits():
    rng = random.Random(3)
    for groups in (30, 3, 1):
        number = np.array(sorted(rng.randrange(groups) for _ in range(60)))
        n = np.array([rng.randrange(1, 60) for _ in range(60)])
        ell = np.array([rng.choice([1, 1, 2, 4]) for _ in range(60)])
        pos = np.array([rng.randrange(max(1, k // 5 + 1)) for k in n])
        got = J.has_match(number, n, pos, ell, 80)
        size = np.bincount(number)[number]
        for i in range(60):
            want = any(j != i and number[i] == number[j] and _may_match(n, pos, ell, i, j) for j in range(60))
            assert got[i] == want if size[i] <= J.FEW else got[i] >= want
        assert 0 < got.sum() < 60
    assert not len(J.has_match(number[:0], n[:0], pos[:0], ell[:0], 80))


def test_only_postings_at_fitting_places_leave_their_task(spark):
    rows = near_copies(8, 60, 3, 60)
    sets = {J.name_of(s)[0]: s for s in J.shingle_sets(pa.array([t for _, t in rows]))}
    posted = {(s, k): int(x) for s, own in sets.items() for k, x in enumerate(own[:len(own) - -(-80 * len(own) // 100) + 1])}
    want = set()
    for (a, i), (b, j) in itertools.combinations(posted, 2):
        if posted[a, i] == posted[b, j] and _may_match([len(sets[a]), len(sets[b])], [i, j], [1, 1], 0, 1):
            want |= {(a, i), (b, j)}
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = J.postings(frame(spark, rows), none, 4, 80).select("sig", "pos").collect()
    assert sorted(map(tuple, got)) == sorted(want) and 0 < len(want) < 0.8 * len(posted)


def test_postings_travel_in_planes():
    rng = np.random.default_rng(2)
    rows = np.zeros(500, J.POSTING)
    for c in J.POSTING.names:
        rows[c] = rng.integers(0, 2**8, 500)
    rows["sig"] = rng.integers(0, 2**63, 500)
    for part in (rows, rows[:1], rows[:0]):
        assert (J.from_planes(pa.py_buffer(J.to_planes(part))) == part).all()


def test_names_are_drawn_again_if_two_classes_share_one(spark, monkeypatch):
    drawn = J.name_of
    monkeypatch.setattr(J, "name_of", lambda s, draw=0: len(s) and (drawn(s, draw) if draw else (7, drawn(s)[1])))
    rows = near_copies(9, 12, 6, 60) + [(20_000, None)]
    got = J.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(model_components(rows))
