from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsloom.operators import store
from newsloom.operators.joins import known_keys
from newsloom.operators.views import (by_country, daily_country_counts, daily_summary,
                                      filtered_articles, recent_articles)
from newsloom.schemas import ARTICLE, QUARANTINE
from newsloom.sources.tables import scan_articles

DAY = datetime(2024, 7, 1, 23, 30)


def article(n, **changed):
    row = {"title": f"T{n}", "title_translated": None, "url": f"https://h.example.com/{n}",
           "description": "D", "description_translated": None, "date_published": DAY,
           "provider": "P", "language": "en", "content": "C", "origin_country": "GB",
           "keywords": [], "source_api": "Api", "schema_version": "1.1", "date_scraped": DAY,
           "category": None, "authors": ["A"], "related_countries": None, "image_url": None,
           "post_processed": False}
    return {**row, **changed}


@pytest.fixture
def batch(spark):
    from pyspark.sql import types as T

    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in ARTICLE.fields])
    loose.add("arrival", T.LongType())

    def make(*rows):
        full = [{**r, "arrival": 10 * i} for i, r in enumerate(rows)]
        return spark.createDataFrame([tuple(r.values()) for r in full], loose)

    return make


def append(batch, path, load):
    accepted, errors = store.append_articles(batch, path, load)
    return ({r.url for r in accepted.collect()},
            {r["index"]: (r.url, r.error) for r in errors.collect()})


def test_good_rows_are_written_even_if_others_fail(spark, batch, tmp_path):
    path = str(tmp_path / "articles")
    accepted, errors = append(batch(
        article(1), article(1, title="other"), article(2, title="T1"), article(3, language="eng"),
        article(4, image_url=""), article(5, url="ftp://x"), article(6, content=None),
        article(7, related_countries=["GB", "gb"])), path, "a")
    assert accepted == {"https://h.example.com/1", "https://h.example.com/4"}
    assert {i: e for i, (_, e) in errors.items()} == {
        1: "duplicate_url", 2: "duplicate_title", 3: "bad language", 5: "bad url",
        6: "missing content", 7: "bad related_countries"}
    stored = scan_articles(spark, path).orderBy("url").collect()
    assert [r.url[-1] for r in stored] == ["1", "4"]
    assert (stored[1].image_url, stored[0].pub_date, stored[0].load_id) == (
        None, date(2024, 7, 1), "a")


def test_the_next_load_sees_the_table(spark, batch, tmp_path):
    path = str(tmp_path / "articles")
    append(batch(article(1), article(2)), path, "a")
    accepted, errors = append(batch(article(2), article(3, title="T1"), article(4)), path, "b")
    assert accepted == {"https://h.example.com/4"}
    assert [errors[i][1] for i in (0, 1)] == ["already_exists", "duplicate_title"]
    assert scan_articles(spark, path).count() == 3


def test_a_load_written_again_replaces_itself(spark, batch, tmp_path):
    path = str(tmp_path / "articles")
    append(batch(article(1)), path, "a")
    for _ in range(2):
        accepted, _ = append(batch(article(1), article(2)), path, "b")
        assert accepted == {"https://h.example.com/2"}
    assert scan_articles(spark, path).count() == 2


def test_a_load_written_again_keeps_nothing_of_the_first_attempt(spark, batch, tmp_path):
    path = str(tmp_path / "articles")
    append(batch(article(1)), path, "a")
    other = datetime(2024, 7, 9, 1)
    append(batch(article(2), article(3)), path, "b")
    append(batch(article(4, date_published=other)), path, "b")
    stored = {(r.url[-1], r.load_id, r.pub_date) for r in scan_articles(spark, path).collect()}
    assert stored == {("1", "a", date(2024, 7, 1)), ("4", "b", date(2024, 7, 9))}
    append(batch(article(5)).limit(0), path, "b")
    assert [r.url[-1] for r in scan_articles(spark, path).collect()] == ["1"]


def test_a_refused_row_needs_a_reason(spark, batch, tmp_path):
    rows = batch(article(1)).withColumn("failure_reason", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="failure_reason"):
        store.quarantine(rows, str(tmp_path / "failed"), "a")


def test_an_empty_batch_writes_nothing(spark, batch, tmp_path):
    path = str(tmp_path / "articles")
    assert append(batch(article(1)).limit(0), path, "a") == (set(), {})
    assert scan_articles(spark, path).count() == 0


def test_quarantine_keeps_the_rows_and_their_reason(spark, batch, tmp_path):
    rows = batch(article(1), article(2, title="T1"), article(3, language="EN"))
    known = known_keys(scan_articles(spark, str(tmp_path / "none")), rows)
    verdicts = store.judge(rows, known)
    kept = store.quarantine(verdicts.rejected, str(tmp_path / "failed"), "a")
    assert kept.columns == [f.name for f in QUARANTINE.fields]
    assert {r.title: r.failure_reason for r in kept.collect()} == {
        "T1": "duplicate_title", "T3": "bad language"}


def test_country_reads_only_its_row_groups(spark, batch, tmp_path, plan):
    path = str(tmp_path / "articles")
    store.write_articles(batch(article(1), article(2, origin_country="FR")), path, "a")
    one = by_country(scan_articles(spark, path), "FR")
    assert one.count() == 1
    assert "EqualTo(origin_country,FR)" in plan(one)
    assert "PartitionFilters: [isnotnull" in plan(
        scan_articles(spark, path).where(F.col("pub_date") == date(2024, 7, 1)))


def test_summary_of_days_and_countries(spark, batch):
    rows = batch(article(1), article(2), article(2, title="again"),
                 article(3, origin_country="FR"),
                 article(4, date_published=datetime(2024, 7, 2, 0, 30)))
    days = daily_summary(rows).collect()
    assert days[0].asDict().keys() == {"date", "countries", "total_count"}
    assert [(d.date, d.total_count) for d in days] == [("2024-07-02", 1), ("2024-07-01", 4)]
    assert [(c.country, c["count"], [u[-1] for u in c.article_urls])
            for c in days[1].countries] == [("FR", 1, ["3"]), ("GB", 3, ["1", "2"])]


def test_parts_of_a_day_add_up(spark, batch):
    rows = batch(*(article(i, origin_country="GB" if i % 3 else "FR") for i in range(200)))
    parts = daily_summary(rows, parts=10).collect()
    assert len(parts) == 10 and {p.date for p in parts} == {"2024-07-01"}
    assert sum(p.total_count for p in parts) == 200
    urls = [u for p in parts for c in p.countries for u in c.article_urls]
    assert len(urls) == len(set(urls)) == 200
    flat = daily_country_counts(rows, parts=10).collect()
    assert sum(r["count"] for r in flat if r.origin_country == "FR") == 67


def test_summary_moves_urls_once_after_their_distinct(spark, batch, plan):
    text = plan(daily_summary(batch(article(1))))
    assert text.count("Exchange rangepartitioning(date") == 1
    assert text.count("Exchange hashpartitioning(date") == 1


def test_curated_view(spark, batch):
    rows = batch(article(1), article(2, post_processed=True, title_translated="TT",
                                     description_translated="DT"))
    (row,) = filtered_articles(rows).collect()
    assert (row.title, row.description, row.url[-1]) == ("TT", "DT", "2")
    assert "content" not in row


def test_latest_articles_need_no_full_sort(spark, batch, plan):
    assert "TakeOrderedAndProject" in plan(recent_articles(batch(article(1)), 5))
