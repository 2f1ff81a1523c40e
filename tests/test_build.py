from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.config import Settings
from newsloom.operators.build import build_articles, merge_article, page_contents
from newsloom.schemas import ARTICLE

RUN_TS = datetime(2024, 6, 1, 2)
TESTING = Settings(markets=("de-DE", "es-ES"), min_content_length=100, max_content_length=10_000)
BODY = "This is a sentence of an article that is long enough to be stored by the run. " * 3

ITEM = ("arrival long, mkt string, title string, url string, description string, "
        "date_published timestamp, provider string, origin_country string, image_url string, "
        "language string, source_api string")


def page(body=BODY, lang='lang="es"', head=""):
    return f"<html {lang}><head>{head}</head><body><article><p>{body}</p></article></body></html>"


@pytest.fixture
def build(spark):
    def run(pages, settings=TESTING, **changed):
        items, crawled = [], []
        for i, html in enumerate(pages):
            url = f"https://h.example.com/{i}"
            row = {"arrival": i, "mkt": "de-DE", "title": f"T{i}", "url": url,
                   "description": "D", "date_published": RUN_TS, "provider": "P",
                   "origin_country": "DE", "image_url": None, "language": "de",
                   "source_api": "Api", **changed}
            items.append(tuple(row.values()))
            if html is not None:
                crawled.append((i, url, html))
        made, log = build_articles(
            spark.createDataFrame(items, ITEM),
            spark.createDataFrame(crawled, "page_id long, url string, html string"),
            RUN_TS, settings)
        outcomes = [r.outcome for r in log.orderBy("arrival").collect()]
        return made.orderBy("arrival").collect(), outcomes

    return run


def test_every_outcome(build):
    _, outcomes = build([page(), None, "", page(lang=""), page(lang='lang="zz"'),
                         page("Too short."), page("x" * 10_001), page("$<i></i>foo " + BODY)])
    assert outcomes == ["built", "no_content", "no_content", "extract_failed", "lang_unknown",
                        "invalid_content", "invalid_content", "built"]


def test_an_item_without_a_required_field_cannot_be_built(build):
    assert build([page()], description=None)[1] == ["build_failed"]


def test_language_may_be_optional(build):
    relaxed = Settings(min_content_length=100, require_meta_lang=False)
    rows, outcomes = build([page(lang="")], relaxed)
    assert outcomes == ["built"] and rows[0].language == "de"


def test_item_wins_and_empty_counts_as_none(build):
    head = ('<meta name="keywords" content="test, article"><meta name="author" content="Ann">'
            '<meta property="og:image" content="https://i.example.com/top.jpg">')
    ((row,), _) = build([page(head=head)])
    assert [f.name for f in ARTICLE.fields] == list(row.asDict())[:19]
    assert row.language == "de" and row.keywords == ["test,", "article"]
    assert row.authors == ["Ann"] and row.image_url == "https://i.example.com/top.jpg"
    assert (row.schema_version, row.post_processed, row.date_scraped) == ("1.1", False, RUN_TS)
    assert row.title_translated is None and row.category is None
    ((row,), _) = build([page(head=head)], image_url="https://i.example.com/own.jpg", language="")
    assert row.image_url == "https://i.example.com/own.jpg" and row.language == "es"


def test_escaping_counts_towards_the_length(build):
    text = "x" * 90 + "'" + "y" * 91
    ((row,), _) = build([page(text)])
    assert len(row.content) == 187


def test_items_of_one_page_share_its_work(spark, plan):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    items = pages.select(
        F.col("page_id").alias("arrival"), F.lit("de-DE").alias("mkt"),
        *(F.lit("x").alias(c) for c in ("title", "description", "provider", "origin_country",
                                        "image_url", "language", "source_api")),
        "url", F.lit(RUN_TS).alias("date_published"))
    made, _ = build_articles(items.unionByName(items), pages, RUN_TS)
    text = plan(made)
    # The last captures are found by URL and id alone and sent to the page scan: nothing that
    # moves below the page work holds HTML.
    page_side = text[text.index("ArrowEvalPython"):]
    moved = page_side[page_side.index("BroadcastExchange"):]
    assert "html" not in moved and "SortMergeJoin" not in page_side
    assert "html" not in text[:text.index("ArrowEvalPython")].replace("html#", "")


def test_copies_of_a_page_give_one(spark):
    rows = [(1, "u", page("old " + BODY)), (2, "u", page("new " + BODY))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    (got,) = page_contents(pages, TESTING).collect()
    assert got.content.startswith("new")


def test_merge_keeps_extra_columns(spark):
    joined = spark.range(1).selectExpr(
        "id as arrival", "'t' as title", "'u' as url", "'d' as description",
        "timestamp '2024-01-01' as date_published", "'p' as provider", "'DE' as origin_country",
        "'' as image_url", "'' as language", "'a' as source_api", "'c' as content",
        "'fr' as meta_lang", "cast(null as string) as meta_keywords", "array('x') as authors",
        "cast(null as string) as top_image")
    row = merge_article(joined, RUN_TS, "arrival").first()
    assert (row.language, row.image_url, row.keywords, row.arrival) == ("fr", None, [], 0)
