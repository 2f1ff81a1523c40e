"""Merged commits and the stored summary: the same rows whatever loads came, came again or were merged."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from newsloom.operators import commits as C
from newsloom.operators import compaction as M
from newsloom.operators import store
from newsloom.operators import summary as S
from newsloom.operators.views import daily_country_counts, daily_summary, recent_articles
from newsloom.sources.page_store import STORED_PAGE, PageStore, store_pages
from newsloom.sources.tables import scan_articles
from tests.test_store import article, batch  # noqa: F401

START = datetime(2024, 7, 1, 12)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "articles")


def add(batch, path, load, *numbers, days=3):  # noqa: F811
    rows = [article(n, date_published=START + timedelta(days=n % days), origin_country="GB" if n % 2 else "FR")
            for n in numbers]
    store.append_articles(batch(*rows) if rows else batch(article(0)).limit(0), path, load)


def stored(spark, path):
    return sorted((r.load_id, int(r.url.rsplit("/", 1)[1])) for r in scan_articles(spark, path).collect())


def check_summary(spark, path):
    articles = scan_articles(spark, path)
    assert [r.asDict(True) for r in S.stored_summary(spark, path).collect()] == [
        r.asDict(True) for r in daily_summary(articles).collect()]
    assert sorted(map(str, S.stored_country_counts(spark, path).collect())) == sorted(
        map(str, daily_country_counts(articles).collect()))


def files_by_day(spark, path):
    files = {f for f in scan_articles(spark, path).inputFiles()}
    return Counter(f.split("/pub_date=")[1].split("/")[0] for f in files)


def test_days_have_few_files_after_many_loads(spark, batch, path):  # noqa: F811
    for k in range(5):
        add(batch, path, f"l{k}", *range(10 * k, 10 * k + 6))
    rows = stored(spark, path)
    assert max(files_by_day(spark, path).values()) == 5
    assert set(M.compact(spark, path, fanout=4)) == {C.ARTICLES, C.KEYS, S.URLS}
    assert max(files_by_day(spark, path).values()) == 1 and stored(spark, path) == rows
    assert M.compact(spark, path, fanout=4) == []
    check_summary(spark, path)
    # The keys are still known, and a merged load can be done again.
    add(batch, path, "late", 3, 21, 90)
    assert stored(spark, path) == sorted([*rows, ("late", 90)])
    add(batch, path, "l2", 21, 70)
    want = sorted([r for r in rows if r[0] != "l2"] + [("l2", 21), ("l2", 70), ("late", 90)])
    assert stored(spark, path) == want
    check_summary(spark, path)
    assert C.ARTICLES in M.compact(spark, path)   # the rows that were replaced go
    assert not any(p.masked for p in C.manifest(spark, path).of(C.ARTICLES)) and stored(spark, path) == want
    add(batch, path, "more", 20, 22)              # l2 does not hold 20 and 22 any more
    assert ("more", 20) in stored(spark, path)


def test_vacuum_after_a_merge(spark, batch, path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(C, "KEPT_VERSIONS", 1)
    for k in range(3):
        add(batch, path, f"l{k}", k, 10 + k)
    rows = stored(spark, path)
    gone = M.maintain(spark, path, fanout=2)
    assert len([g for g in gone if "/articles/commit=" in g]) == 3 and stored(spark, path) == rows
    check_summary(spark, path)


def test_tiers_bound_the_number_of_commits():
    part = lambda k: C.Part(f"c{k}", (f"l{k}",))
    sizes, count = {}, 0
    for k in range(300):
        sizes[part(count)] = 1 << 20
        count += 1
        while len(old := M.to_merge(sizes, 4)) > 1:
            size = sum(sizes.pop(p) for p in old)
            sizes[part(count)] = size
            count += 1
    tiers = Counter(M.tier(size, 4) for size in sizes.values())
    assert max(tiers.values()) <= 3 and sum(sizes.values()) == 300 << 20
    assert M.to_merge({C.Part("a", ("x", "y"), ("y",)): 1 << 40}, 4)


def test_a_load_and_a_merge_do_not_hinder_each_other(spark, batch, path, monkeypatch):  # noqa: F811
    for k in range(3):
        add(batch, path, f"l{k}", 10 * k, 10 * k + 1)
    waiting = C.Commit(spark, path, "waiting")
    waiting.write("notes", spark.range(1))
    M.compact(spark, path, fanout=2)
    waiting.publish()
    rewritten, times = M._rewritten, []

    def meanwhile(rows, name, *rest):
        if not times:   # while the articles are merged, a load is done again and a new one comes
            times.append(1)
            add(batch, path, "l1", 11, 12)
            add(batch, path, "new", 40)
        return rewritten(rows, name, *rest)

    add(batch, path, "l3", 30)
    monkeypatch.setattr(M, "_rewritten", meanwhile)
    M.compact(spark, path, fanout=2)
    assert stored(spark, path) == [("l0", 0), ("l0", 1), ("l1", 11), ("l1", 12), ("l2", 20), ("l2", 21), ("l3", 30),
                                   ("new", 40)]
    check_summary(spark, path)


def test_summary_equals_the_view_after_random_loads(spark, batch, path):  # noqa: F811
    rng = random.Random(3)
    for k in range(7):
        load = rng.choice("abcd")
        add(batch, path, load, *rng.sample(range(40), rng.randrange(9)), days=rng.choice([2, 5]))
        if k == 4:
            M.compact(spark, path, fanout=2)
    check_summary(spark, path)


def test_only_touched_days_are_written(spark, batch, path):  # noqa: F811
    add(batch, path, "a", 0, 1, 2)
    before = C.manifest(spark, path).days
    add(batch, path, "b", 4)
    after = C.manifest(spark, path).days
    assert sorted(before) == ["2024-07-01", "2024-07-02", "2024-07-03"]
    assert [day for day in after if after[day] != before.get(day)] == ["2024-07-02"]
    add(batch, path, "b")                         # done again without a row: the day is as before
    check_summary(spark, path)
    add(batch, path, "a", 0)                      # days that lose their only rows go
    assert list(C.manifest(spark, path).days) == ["2024-07-01"]
    check_summary(spark, path)


def test_the_latest_articles_open_the_newest_days_only(spark, batch, path, plan):  # noqa: F811
    add(batch, path, "a", *range(20), days=10)
    add(batch, path, "b", *range(30, 36), days=10)
    for k in (0, 1, 3, 4, 25, 100):
        got = S.recent_stored(spark, path, k)
        assert [r.url for r in got.collect()] == [r.url for r in recent_articles(scan_articles(spark, path), k).collect()]
    assert "(pub_date#" in plan(S.recent_stored(spark, path, 3)).split("PartitionFilters")[1].split("]")[0]
    days = {f.split("/pub_date=")[1][:10] for f in S.recent_stored(spark, path, 3).inputFiles()}
    assert len(days) == 10 or days == {"2024-07-09", "2024-07-10"}
    assert S.recent_stored(spark, path + "-none", 5).count() == 0


def test_an_empty_table_has_an_empty_summary(spark, path):
    assert S.stored_summary(spark, path).count() == 0 and M.compact(spark, path) == []


def test_page_loads_are_merged_too(spark, tmp_path):
    path = str(tmp_path / "pages")
    for k in range(4):
        rows = [(10 * k + i, f"u{i}", "h", date(2024, 6, 1 + i % 2)) for i in range(6)]
        store_pages(spark.createDataFrame(rows, STORED_PAGE), path, f"l{k}", 4)
    before = sorted(map(str, PageStore.at(spark, path).since().collect()))
    assert M.compact(spark, path, fanout=2) == [C.PAGES]
    store = PageStore.at(spark, path)
    assert len(store.seen.of(C.PAGES)) == 1 and sorted(map(str, store.since().collect())) == before
    store_pages(spark.createDataFrame([(99, "u9", "h", date(2024, 6, 3))], STORED_PAGE), path, "l1", 4)
    assert {r.page_id // 10 for r in PageStore.at(spark, path).since().collect()} == {0, 2, 3, 9}
