import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsloom.config import MARKETS
from newsloom.sources import dims
from newsloom.sources.news_json import (LANDED, bad_items, explode_response, failed_responses,
                                        normalize_items, read_responses, scan_news_json)
from newsloom.sources.registry import Registry, union_sources
from newsloom.sources.tables import latest_pages, scan_articles, scan_pages, write_pages

FULL = {
    "name": "Title", "url": "https://a.example.com/1", "description": "About",
    "datePublished": "2024-07-01T10:00:00.0000000Z", "provider": [{"name": "Paper"}],
    "image": {"thumbnail": {"contentUrl": "https://i.example.com/x&pid=1"}},
}


def without(*names, **changed):
    return {**{k: v for k, v in FULL.items() if k not in names}, **changed}


@pytest.fixture
def landing(tmp_path):
    def land(mkt, value, name="1"):
        folder = tmp_path / "landing" / f"mkt={mkt}"
        folder.mkdir(parents=True, exist_ok=True)
        body = {} if value is None else {"value": value}
        (folder / f"{name}.json").write_text(json.dumps(body, indent=1))
        return str(tmp_path / "landing")

    return land


def test_items_keep_their_place_and_get_defaults(spark, landing):
    landing("de-CH", [FULL, without("name", "url"), without("provider"), without("image"),
                      without(provider=[{}]), without(image={"thumbnail": {"contentUrl": "&x"}})])
    landing("en-GB", [])
    path = landing("en-US", None)
    rows = normalize_items(scan_news_json(spark, path), "Api").orderBy("pos").collect()
    assert [r.pos for r in rows] == [0, 1, 2, 3, 4, 5]
    assert {(r.mkt, r.language, r.origin_country, r.source_api) for r in rows} == {
        ("de-CH", "de", "CH", "Api")}
    assert [r.provider for r in rows] == ["Paper", "Paper", "MSN", "Paper", "MSN", "Paper"]
    assert (rows[1].title, rows[1].url) == ("", "")
    assert [r.image_url for r in rows] == ["https://i.example.com/x"] * 3 + [
        None, "https://i.example.com/x", None]
    assert rows[0].date_published == datetime(2024, 7, 1, 10)


@pytest.mark.parametrize("bad", [without("description"), without("datePublished"),
                                 without(datePublished="soon"), without(provider=[])])
def test_a_bad_item_fails_its_market_or_only_itself(spark, landing, bad):
    landing("en-GB", [FULL, bad])
    raw = scan_news_json(spark, landing("en-US", [FULL]))
    assert [r.mkt for r in normalize_items(raw, "Api").collect()] == ["en-US"]
    kept = normalize_items(raw, "Api", on_error="quarantine_row")
    assert sorted(r.mkt for r in kept.collect()) == ["en-GB", "en-US"]
    assert [r.mkt for r in bad_items(raw, "Api").collect()] == ["en-GB"]
    with pytest.raises(ValueError):
        normalize_items(raw, "Api", on_error="ignore")


@pytest.mark.parametrize("bad", [
    without(name=None), without(url=None), without(description=None), without(provider=None), without(image=None),
    without(datePublished=None), without(provider=[None]), without(provider=[{"name": None}]), without(provider="Paper"),
    without(provider={"name": "Paper"}), without(provider=[{"name": 5}]), without(image={"thumbnail": None}),
    without(image={"thumbnail": {"contentUrl": None}}), without(image=[]), without(name=7), without(url=["u"]),
    without(description={"text": "D"}), without(datePublished=20240701), None, 5, "text", [FULL]])
def test_null_and_wrong_types_fail_what_missing_does_not(spark, landing, bad):
    landing("en-GB", [FULL, bad, without("provider", "name")])
    raw = scan_news_json(spark, landing("en-US", [without("image", "url")]))
    assert [r.mkt for r in normalize_items(raw, "Api").collect()] == ["en-US"]
    kept = normalize_items(raw, "Api", on_error="quarantine_row")
    assert sorted((r.mkt, r.pos, r.title, r.provider) for r in kept.collect()) == [
        ("en-GB", 0, "Title", "Paper"), ("en-GB", 2, "", "MSN"), ("en-US", 0, "Title", "Paper")]
    assert [(r.mkt, r.pos) for r in bad_items(raw, "Api").collect()] == [("en-GB", 1)]


def test_values_that_are_no_list_are_corrupt(spark, landing, tmp_path):
    landing("en-GB", {"name": "N"})
    path = landing("en-US", "text", "2")
    (tmp_path / "landing" / "mkt=en-US" / "3.json").write_text('{"value": null}')
    landing("en-US", None, "4")
    landing("en-US", [], "5")
    got = read_responses(spark.read.schema(LANDED).option("multiLine", True).json(path))
    assert {(r.mkt, r.response[-6]): r.corrupt for r in got.collect()} == {
        ("en-GB", "1"): True, ("en-US", "2"): True, ("en-US", "3"): True, ("en-US", "4"): False, ("en-US", "5"): False}


def test_what_a_response_loses_is_recorded(spark, landing, tmp_path):
    landing("en-GB", [FULL, without("description"), without(provider=[])])
    landing("xx-XX", [FULL])
    landing("de-DE", [without(provider="Paper"), FULL])
    path = landing("en-US", [FULL])
    (tmp_path / "landing" / "mkt=en-US" / "2.json").write_text('{"value": [{"name": "T"')
    landed = spark.read.schema(LANDED).option("multiLine", True).json(path)
    responses = read_responses(landed)
    markets = dims.market_dim(spark, MARKETS)
    lost = {(r.mkt, r.reason): (r["items"], r.first_bad) for r in failed_responses(responses, markets).collect()}
    assert lost == {("de-DE", "bad_item"): (2, 0), ("en-GB", "bad_item"): (3, 1), ("xx-XX", "unknown_market"): (1, None),
                    ("en-US", "corrupt"): (0, None)}
    only = failed_responses(responses, markets, "quarantine_row").where("reason = 'bad_item'").collect()
    assert {(r.mkt, r["items"], r.first_bad) for r in only} == {("en-GB", 2, 1), ("de-DE", 1, 0)}
    kept = normalize_items(explode_response(responses), "Api", "quarantine_row").collect()
    assert sorted(r.mkt for r in kept) == ["de-DE", "en-GB", "en-US", "xx-XX"]


def test_pages_of_other_days_are_not_read(spark, tmp_path, plan):
    rows = [(1, "u1", "old", date(2024, 1, 1)), (2, "u2", "new", date(2024, 1, 2))]
    path = str(tmp_path / "dated")
    write_pages(spark.createDataFrame(rows, "page_id long, url string, html string, crawl_day date"), path)
    new = scan_pages(spark, path, since=date(2024, 1, 2))
    assert [r.url for r in new.collect()] == ["u2"]
    assert "PartitionFilters: [isnotnull(crawl_day" in plan(new)


def test_code_lists(spark):
    assert len(dims.iso_countries(spark)) == 249
    assert len(dims.iso_languages(spark)) == 183
    assert {"GB", "TW", "ZA"} <= set(dims.iso_countries(spark))
    assert {"en", "no", "zh"} <= set(dims.iso_languages(spark))


def test_markets_are_expanded_and_unknown_ones_left_out(spark):
    rows = dims.market_dim(spark, (*MARKETS, "xx-US", "en-ZZ", "en")).orderBy("ord").collect()
    assert [r.mkt for r in rows] == list(MARKETS)
    assert (rows[1].ord, rows[1].lang, rows[1].country) == (1, "en", "AU")


def test_sources_are_concatenated_in_order(spark, landing):
    landing("en-GB", [FULL])
    raw = scan_news_json(spark, landing("en-US", [FULL]))
    sources = Registry()
    sources.register_source("First", raw, ("en-US", "en-GB"))
    sources.register_source("Second", raw, ("en-US", "xx-XX"),
                            lambda r: normalize_items(r, "Renamed"))
    rows = union_sources(spark, sources).orderBy("source_ord", "market_ord").collect()
    assert [(r.source_ord, r.market_ord, r.mkt, r.source_api) for r in rows] == [
        (0, 0, "en-US", "First"), (0, 1, "en-GB", "First"), (1, 0, "en-US", "Renamed")]
    with pytest.raises(ValueError):
        sources.register_source("First", raw)
    with pytest.raises(ValueError):
        union_sources(spark, Registry())


def test_pages(spark, tmp_path):
    rows = [(1, "u1", "old"), (3, "u1", "new"), (2, "u2", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.json(
        str(tmp_path / "pages"))
    pages = scan_pages(spark, str(tmp_path / "pages"), "json")
    assert {r.page_id: r.html for r in pages.collect()} == {1: "old", 3: "new", 2: None}
    assert {r.url: r.html for r in latest_pages(pages).collect()} == {"u1": "new", "u2": None}


def test_a_table_that_is_not_there_is_empty(spark, tmp_path):
    assert scan_articles(spark, str(tmp_path / "none")).count() == 0


def test_bad_items_do_not_shuffle_by_market(spark, landing, plan):
    raw = scan_news_json(spark, landing("en-US", [FULL]))
    text = plan(normalize_items(raw, "Api").select(F.col("url")))
    assert "Window" not in text
