import json
from datetime import datetime

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.config import Settings
from newsloom.schemas import RESPONSE
from newsloom.sources.news_json import explode_response, with_item_columns, with_judgement
from newsloom.sources.registry import Source
from newsloom.sources.tables import scan_articles
from newsloom.streaming.daily_run import daily_run, read_log

RUN_TS = datetime(2024, 6, 1, 2)
BODY = "This is a sentence of an article that is long enough to be stored by the run. " * 3
SETTINGS = Settings(markets=("en-GB", "de-DE"), min_content_length=100, max_content_length=10_000)


def html(body=BODY, lang='lang="en"'):
    return f"<html {lang}><body><article><p>{body}</p></article></body></html>"


@pytest.fixture
def site(spark, tmp_path):
    """A landing folder, a page table and an article table to run against."""

    class Site:
        pages = []

        def page(self, name, content):
            self.pages.append((len(self.pages), f"https://h.example.com/{name}", content))

        def land(self, mkt, file, *items):
            folder = tmp_path / "landing" / f"mkt={mkt}"
            folder.mkdir(parents=True, exist_ok=True)
            value = [{"name": title, "url": f"https://h.example.com/{name}", "description": "D",
                      "datePublished": "2024-05-31T10:00:00Z"} for name, title in items]
            (folder / f"{file}.json").write_text(json.dumps({"value": value}))

        def run(self, **kw):
            spark.createDataFrame(self.pages, "page_id long, url string, html string").write.mode(
                "overwrite").parquet(str(tmp_path / "pages"))
            daily_run(spark, str(tmp_path / "landing"), str(tmp_path / "pages"),
                      str(tmp_path / "table"), str(tmp_path / "mark"), settings=SETTINGS,
                      run_ts=RUN_TS, **kw)

        def stored(self):
            rows = scan_articles(spark, str(tmp_path / "table" / "articles")).collect()
            return sorted(r.url.rsplit("/", 1)[1] for r in rows)

        def log(self, name):
            return read_log(spark, str(tmp_path / "table"), name)

    made = Site()
    made.pages = []
    return made


def test_runs_take_only_what_is_new(spark, site):
    for name in "abcdef":
        site.page(name, html())
    site.page("short", html("Too short."))
    site.page("nolang", html(lang=""))
    # b comes in both markets and twice in the first; c's title is a's.
    site.land("en-GB", "1", ("a", "A"), ("b", "B"), ("b", "B2"), ("short", "S"), ("gone", "G"))
    site.land("de-DE", "1", ("b", "B3"), ("c", "A"), ("d", "D"), ("nolang", "N"))
    site.run()
    assert site.stored() == ["a", "b", "d"]
    outcomes = {}
    for r in site.log("build_log").collect():
        outcomes.setdefault(r.url.rsplit("/", 1)[1], []).append((r.mkt, r.outcome, r.accepted))
    assert sorted(outcomes["b"]) == [
        ("de-DE", "already_exists", False), ("en-GB", "built", False), ("en-GB", "built", True)]
    assert outcomes["c"] == [("de-DE", "built", False)]
    assert outcomes["short"] == [("en-GB", "invalid_content", False)]
    assert outcomes["gone"] == [("en-GB", "no_content", False)]
    assert outcomes["nolang"] == [("de-DE", "extract_failed", False)]
    places = {(r.mkt, r["index"], r.error) for r in site.log("errors").collect()}
    assert places == {("en-GB", 2, "duplicate_url"), ("de-DE", 0, "duplicate_title")}
    errors = {(r.url.rsplit("/", 1)[1], r.error) for r in site.log("errors").collect()}
    assert errors == {("b", "duplicate_url"), ("c", "duplicate_title")}
    stats = {r.mkt: (r.total_trending, r.built, r.inserted, r.build_rate_text)
             for r in site.log("market_stats").collect()}
    assert stats == {"en-GB": (5, 3, 2, "60.00%"), "de-DE": (4, 2, 1, "50.00%")}
    summary = site.log("run_summary").first()
    assert (summary.stored, summary.attempts) == (3, 8)

    site.run()
    assert site.stored() == ["a", "b", "d"]
    assert site.log("run_summary").count() == 1

    site.land("en-GB", "2", ("a", "A"), ("e", "E"), ("f", "D"))
    site.run()
    assert site.stored() == ["a", "b", "d", "e"]
    failed = read_log(spark, str(site.log("errors").inputFiles()[0]).split("/errors/")[0],
                      "failed_articles")
    assert sorted(r.failure_reason for r in failed.collect()) == [
        "duplicate_title", "duplicate_title", "duplicate_url"]


def test_a_backlog_may_be_split_into_loads(site):
    for name in "abc":
        site.page(name, html())
    for i, name in enumerate("abc"):
        site.land("en-GB", str(i), (name, name.upper()))
    site.run(files_per_load=1)
    assert site.stored() == ["a", "b", "c"]
    assert site.log("run_summary").count() == 3


def test_a_run_reports_on_sources_requests_and_what_it_lost(spark, site, tmp_path):
    for name in "abc":
        site.page(name, html())
    site.land("en-GB", "1", ("a", "A"))
    site.land("de-DE", "1", ("b", "B"))
    site.land("xx-XX", "1", ("c", "C"))
    (tmp_path / "landing" / "mkt=en-GB" / "2.json").write_text('{"value": [{"name": "cut')
    bad = tmp_path / "landing" / "mkt=de-DE" / "2.json"
    bad.write_text(json.dumps({"value": [{"name": "N", "url": "https://h.example.com/c"}]}))
    item = ("C", "https://h.example.com/c", "D", RUN_TS, "P", "GB", None, "en", "Feed", "en-GB", "r", 0)
    kinds = ("title string, url string, description string, date_published timestamp, provider string, "
             "origin_country string, image_url string, language string, source_api string, mkt string, "
             "response string, pos int")
    site.run(
        more_sources=lambda s: [Source("Feed", s.createDataFrame([item], kinds), ("en-GB",), lambda rows: rows)],
        attempts=lambda s: s.createDataFrame([("basic", 200), ("basic", 403)], "method string, status int"))
    assert site.stored() == ["a", "b", "c"]
    assert {(r.mkt, r["items"], r.first_bad, r.reason) for r in site.log("failed_responses").collect()} == {
        ("xx-XX", 1, None, "unknown_market"), ("en-GB", 0, None, "corrupt"), ("de-DE", 1, 0, "bad_item")}
    assert {(r.source_api, r.mkt, r.inserted) for r in site.log("market_stats").collect()} == {
        ("BingNewsSource", "en-GB", 1), ("BingNewsSource", "de-DE", 1), ("Feed", "en-GB", 1)}
    assert [(r.provider, r.successful) for r in site.log("article_stats").where("not is_total").collect()] == [
        ("h.example.com", 3)]
    assert site.log("request_summary").first().success_rate_text == "50.00%"
    assert {(r.status, r.share) for r in site.log("status_breakdown").collect()} == {(200, 0.5), (403, 0.5)}
    assert site.log("status_overall").count() == 2


@pytest.mark.parametrize("on_error, lost", [("fail_market", 2), ("quarantine_row", 1)])
def test_every_source_records_what_it_lost(spark, site, on_error, lost):
    good = {"name": "N", "url": "https://h.example.com/n", "description": "D", "datePublished": "2024-05-31T10:00:00Z"}
    bad = {k: v for k, v in good.items() if k != "description"}
    site.land("en-GB", "1", ("a", "A"))
    site.land("xx-XX", "1", ("b", "B"))
    rows = [("en-GB", "r1", [good], False), ("en-GB", "r2", [good, bad], False), ("xx-XX", "r3", [good], False),
            ("en-GB", "r4", None, True)]
    plain = [("en-GB", "p1", 0, "u"), ("en-GB", "p1", 1, None), ("xx-XX", "p2", 0, "v")]

    def own(raw):
        return with_item_columns(raw.where("link is not null").select(
            "mkt", "response", "pos", F.lit(None).cast(RESPONSE["value"].dataType.elementType).alias("item")), "Own").drop("is_bad")

    def more(s):
        landed = s.createDataFrame(rows, T.StructType([
            T.StructField("mkt", T.StringType()), T.StructField("response", T.StringType()), RESPONSE["value"],
            T.StructField("corrupt", T.BooleanType())]))
        feed = with_judgement(landed)
        return [Source("Feed", feed, ("en-GB",)), Source("Rows", explode_response(feed), ("en-GB",)),
                Source("Own", s.createDataFrame(plain, "mkt string, response string, pos int, link string"), ("en-GB",), own)]

    site.run(on_error=on_error, more_sources=more)
    got = {(r.source_api, r.mkt, r["items"], r.first_bad, r.reason) for r in site.log("failed_responses").collect()}
    assert got == {
        ("BingNewsSource", "xx-XX", 1, None, "unknown_market"), ("Feed", "en-GB", lost, 1, "bad_item"),
        ("Feed", "xx-XX", 1, None, "unknown_market"), ("Feed", "en-GB", 0, None, "corrupt"),
        ("Rows", "en-GB", lost, 1, "bad_item"), ("Rows", "xx-XX", 1, None, "unknown_market"),
        ("Own", "en-GB", 1, None, "bad_item"), ("Own", "xx-XX", 1, None, "unknown_market")}
