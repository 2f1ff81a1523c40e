"""Pages laid out by crawl day and URL: the same results, with HTML left where it lies."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsloom.operators.build import build_items, page_contents, with_contents
from newsloom.plans.run import contents_of, wanted_pages
from newsloom.sources.page_store import STORED_PAGE, PageStore, store_pages
from newsloom.streaming.daily_run import daily_run
from tests.test_build import ITEM, RUN_TS, TESTING, page
from tests.test_run import SETTINGS, html, site  # noqa: F401


def stored(spark, path, rows, load="a"):
    store_pages(spark.createDataFrame(rows, STORED_PAGE), path, load, 4)
    return PageStore.at(spark, path)


def items(spark, *urls, day=RUN_TS):
    return spark.createDataFrame([
        (i, "de-DE", f"T{i}", url, "D", day, "P", "DE", None, "de", "Api") for i, url in enumerate(urls)], ITEM)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "pages")


DAY = date(2024, 6, 1)


def some_pages(n):
    rows = [(k, f"u{k % (n // 2)}", page(f"{k} is here. " * 20 + str(k)), date(2024, 6, 1 + k % 3)) for k in range(n)]
    return rows + [(n, "empty", "", DAY), (n + 1, "none", None, DAY)]


def test_a_crawl_stored_again_takes_the_place_of_the_first(spark, path):
    stored(spark, path, some_pages(20), "a")
    stored(spark, path, some_pages(10), "b")
    store = stored(spark, path, some_pages(20), "a")
    assert store.since().count() == 22 + 12
    assert {r.url for r in store.since().where("html is null").collect()} == {"empty", "none"}


def test_no_store_and_pages_without_a_day(spark, path):
    assert PageStore.at(spark, path) is None
    with pytest.raises(Exception, match="crawl_day"):
        stored(spark, path, [(1, "u", "h", None)])
    assert PageStore.at(spark, path) is None


def test_only_asked_days_are_listed(spark, path, plan):
    store = stored(spark, path, some_pages(30))
    late = store.since(date(2024, 6, 3))
    assert {r.crawl_day for r in late.collect()} == {date(2024, 6, 3)}
    assert "InMemoryFileIndex(1 paths)" in plan(late) and "PartitionFilters: [isnotnull(commit" in plan(late)
    assert store.since(date(2025, 1, 1)).count() == 0


def exchanges_above_html(text):
    """Exchanges on the way from a scan that reads HTML to the result, by the plan's indentation."""
    lines = text.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    found = []
    for at, line in enumerate(lines):
        if "FileScan" in line and "html:string" in line:
            level = depth(line)
            for above in reversed(lines[:at]):
                if depth(above) < level:
                    level = depth(above)
                    if "Exchange" in above:
                        found.append(above.strip())
    return found


def test_html_is_in_no_exchange(spark, path, plan, monkeypatch):
    store = stored(spark, path, some_pages(40))
    wanted = items(spark, *(f"u{k}" for k in range(9)), "gone")
    contents = page_contents(wanted_pages(store.since(), wanted, in_place=True), TESTING, in_place=True)
    text = plan(contents)
    assert text.count("html:string") == 1 and exchanges_above_html(text) == []
    assert "Bucketed: true" in text and contents.count() == 9
    # Pages that lie anyhow move to their URL once.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loose = str(path) + "-loose"
        store.since().drop("crawl_day").write.parquet(loose)
        moved = plan(page_contents(wanted_pages(spark.read.parquet(loose), wanted), TESTING))
        assert len(exchanges_above_html(moved)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_same_items_are_built(spark, path):
    rows = some_pages(40)
    store = stored(spark, path, rows)
    asked = items(spark, *(f"u{k % 12}" for k in range(30)), *["u1"] * 50, "gone", "empty", "none")
    loose = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    want = build_items(asked, loose, TESTING).select("arrival", "url", "outcome", "content").collect()
    got = with_contents(asked, contents_of(asked, store, TESTING, None), TESTING)
    assert sorted(got.select("arrival", "url", "outcome", "content").collect()) == sorted(want)
    assert {r.outcome for r in want} == {"built", "no_content"}


def test_a_capture_from_before_the_eve_does_not_hold_the_article(spark, path):
    body = page("A sentence of some length that is here. " * 10)
    store = stored(spark, path, [
        (1, "old", body, date(2024, 5, 30)), (2, "eve", body, date(2024, 5, 31)), (3, "later", body, date(2024, 7, 1))])
    asked = items(spark, "old", "eve", "later")
    early = items(spark, "x", day=datetime(2024, 1, 1)).withColumn("arrival", F.lit(9).cast("long"))
    for rows in (asked, asked.unionByName(early)):   # what else a load holds makes no difference
        done = with_contents(rows, contents_of(rows, store, TESTING, None), TESTING)
        got = {r.url: r.outcome for r in done.collect() if r.url != "x"}
        assert got == {"old": "no_content", "eve": "built", "later": "built"}


def test_a_run_reads_a_page_store(spark, site, tmp_path):  # noqa: F811
    path = str(tmp_path / "crawled")
    store_pages(spark.createDataFrame(
        [(k, f"https://h.example.com/{name}", html(), date(2024, 6, 1)) for k, name in enumerate("abc")], STORED_PAGE),
        path, "crawl", 4)
    site.land("en-GB", "1", ("a", "A"), ("b", "B"), ("gone", "G"))
    daily_run(spark, str(tmp_path / "landing"), path, str(tmp_path / "table"), str(tmp_path / "mark"),
              settings=SETTINGS, run_ts=RUN_TS)
    assert site.stored() == ["a", "b"]
