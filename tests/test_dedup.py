import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import dedup
from newsloom.operators.dedup import first_by_key, two_key_insert
from newsloom.operators.numbering import with_position
from newsloom.operators.components import connected_components
from newsloom.operators.joins import known_keys, new_items_only, stored_flag, title_conflicts


def one_by_one(rows, stored=()):
    """(arrival, url, title) rows inserted in order: arrival -> reason, None if accepted."""
    old_urls, old_titles = {u for u, _ in stored}, {t for _, t in stored}
    urls, titles, reasons = set(), set(), {}
    for n, u, t in sorted(rows):
        if u is None or t is None:
            reasons[n] = "missing_key"
        elif u in old_urls:
            reasons[n] = "already_exists"
        elif u in urls:
            reasons[n] = "duplicate_url"
        elif t in titles or t in old_titles:
            reasons[n] = "duplicate_title"
        else:
            reasons[n] = None
            urls.add(u)
            titles.add(t)
    return reasons


def insert(spark, rows, stored=None):
    df = spark.createDataFrame(rows, "arrival long, url string, title string").repartition(3)
    old = stored and tuple(
        spark.createDataFrame([(v,) for v in {r[k] for r in stored}], f"{name} string")
        for k, name in enumerate(("url", "title")))
    got = two_key_insert(df, "arrival", stored=old).collect()
    assert all(r.accepted == (r.reason is None) for r in got)
    assert len(got) == len(rows)
    return {r.arrival: r.reason for r in got}


def random_rows(seed, n, keys):
    rng = random.Random(seed)
    return [(i, f"u{rng.randrange(keys)}", f"t{rng.randrange(keys)}") for i in range(n)]


@pytest.fixture
def low_thresholds(spark):
    """Let adaptive execution see skew in partitions of a few rows."""
    lowered = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
               "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in lowered.items():
        spark.conf.set(key, value)
    yield
    for key in lowered:
        spark.conf.unset(key)


def test_either_key_alone_would_be_wrong(spark):
    rows = [(1, "u1", "t1"), (2, "u2", "t1"), (3, "u2", "t3")]
    assert insert(spark, rows) == {1: None, 2: "duplicate_title", 3: None}


@pytest.mark.parametrize("seed", range(3))
def test_equals_one_by_one(spark, seed):
    rows = random_rows(seed, 300, 120)
    stored = [(f"u{i}", f"t{i + 7}") for i in range(0, 120, 11)]
    assert insert(spark, rows, stored) == one_by_one(rows, stored)


def test_copies_nulls_and_nothing(spark):
    rows = [(1, "u", "t"), (2, "u", "t"), (3, None, "t2"), (4, "u4", None), (5, "u5", "t2")]
    assert insert(spark, rows) == one_by_one(rows)
    assert insert(spark, []) == {}


def test_a_hot_title_and_a_hot_url(spark, low_thresholds):
    rng = random.Random(9)
    rows = [(i, f"u{i}" if i % 3 else "hot", "hot" if i % 3 == 1 else f"t{rng.randrange(200)}")
            for i in range(400)]
    assert insert(spark, rows) == one_by_one(rows)


def chain(n):
    """Every row conflicts with the one before: one decision per round."""
    return [(i, f"u{(i + 1) // 2}", f"t{i // 2}") for i in range(n)]


def test_a_long_chain_is_decided_in_order(spark):
    assert insert(spark, chain(60)) == one_by_one(chain(60))


def test_a_chain_takes_one_round_and_no_task_holds_it(spark, monkeypatch):
    n, rounds = 50_000, []
    follow = dedup._to_their_ends
    monkeypatch.setattr(dedup, "_to_their_ends", lambda links: rounds.append(1) or follow(links))
    rows = spark.range(n).select(
        F.col("id").alias("arrival"), F.format_string("u%d", F.floor((F.col("id") + 1) / 2)).alias("url"),
        F.format_string("t%d", F.floor(F.col("id") / 2)).alias("title"))
    got = two_key_insert(rows, "arrival")
    assert got.where("accepted != (arrival % 2 = 0)").count() == 0 and got.where("accepted").count() == n // 2
    assert len(rounds) == 1


def test_chains_that_meet(spark):
    """Trees of conflicts: edges with one edge before them, with two, and several beginnings."""
    rng = random.Random(13)
    for spread in (3, 9, 40):
        rows = [(i, f"u{max(0, i // 2 - rng.randrange(spread))}", f"t{max(0, i // 2 - rng.randrange(spread))}")
                for i in range(150)]
        assert insert(spark, rows) == one_by_one(rows)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201)]
    got = connected_components(spark.createDataFrame(edges, "a int, b int")).collect()
    roots = {r.node: r.root for r in got}
    assert len(got) == len(roots) == 41 + 30 + 2
    assert {roots[i] for i in range(41)} == {0} and {roots[i] for i in range(100, 130)} == {100}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_first_by_key_cuts_hot_keys_before_the_shuffle(spark, plan):
    rows = [("hot" if i % 3 == 0 else f"k{i % 20}", i) for i in range(300, 0, -1)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(3)
    first = first_by_key(df, "k", ["n"])
    want = {}
    for k, n in rows:
        want[k] = min(n, want.get(k, n))
    assert {r.k: r.n for r in first.collect()} == want
    before = plan(first).split("Exchange hashpartitioning(k")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_hot_keys_are_split_by_adaptive_execution(spark, low_thresholds, plan):
    items = spark.range(3000).select(
        F.col("id").alias("arrival"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
        F.lit("t").alias("title"), F.repeat(F.lit("x"), 50).alias("description"))
    articles = spark.createDataFrame([("hot", "t"), ("3", "u")], "url string, title string")
    assert new_items_only(items, articles).count() == 999
    assert title_conflicts(items, articles).count() == 999
    flagged = stored_flag(items, articles)
    assert {r.url for r in flagged.where("is_stored").collect()} == {"hot", "3"}
    flagged.collect()
    assert "skew=true" in plan(flagged)


def test_no_job_runs_before_a_join_is_asked_for(spark):
    items = spark.createDataFrame([(1, "u", "t")], "arrival int, url string, title string")
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("joins", "joins")
    try:
        title_conflicts(items, items.select("url", "title"))
        known_keys(items, items)
        assert not seen.getJobIdsForGroup("joins")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_both_keys_of_history_are_one_scan(spark, tmp_path, plan):
    rows = spark.createDataFrame([("u1", "t1", "c"), ("u2", "t2", "c")], "url string, title string, content string")
    rows.write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    items = spark.createDataFrame([("u1", "t2"), ("u9", None)], "url string, title string")
    found = known_keys(history, items)
    assert {tuple(r) for r in found.collect()} == {("url", "u1"), ("title", "t2")}
    assert plan(found).split("Initial Plan")[0].count("FileScan parquet") == 1
    assert "content" not in plan(found)


def test_positions_are_dense_and_ordered(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(10**9), i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "a long, b int").repartition(7)
    got = with_position(df, "b", F.col("a").desc()).orderBy("position").collect()
    assert [r.position for r in got] == list(range(2000))
    assert [(r.b, -r.a) for r in got] == sorted((b, -a) for a, b in rows)
