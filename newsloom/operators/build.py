"""Items and pages to articles, with an outcome for every item."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.config import SCHEMA_VERSION, Settings
from newsloom.functions.contract import content_issues, required_ok
from newsloom.functions.scalars import falsy_coalesce, split_keywords, utc_date
from newsloom.functions.text import with_sanitized
from newsloom.operators.extraction import Extractors, extract_articles
from newsloom.operators.joins import attach_pages
from newsloom.schemas import ARTICLE, NEWS_ITEM
from newsloom.sources.dims import iso_languages
from newsloom.sources.tables import latest_pages

# Outcomes of a build, and those that count as an attempt.
ALREADY_EXISTS = "already_exists"
NO_CONTENT = "no_content"
EXTRACT_FAILED = "extract_failed"
LANG_UNKNOWN = "lang_unknown"
INVALID_CONTENT = "invalid_content"
BUILD_FAILED = "build_failed"
BUILT = "built"
FAILED_ATTEMPTS = (NO_CONTENT, EXTRACT_FAILED, INVALID_CONTENT, BUILD_FAILED)
ATTEMPTS = (*FAILED_ATTEMPTS, BUILT)
EVE_DAYS = 1  # an article may be crawled the day before its stated publishing day, by time zones

_PAGE_COLUMNS = ("content", "issues", "page_lang", "meta_lang", "meta_keywords", "authors",
                 "top_image")
_REQUIRED_ITEM = tuple(f.name for f in NEWS_ITEM.fields if not f.nullable)


def page_contents(pages: DataFrame, settings: Settings = Settings(),
                  extractors: Extractors | None = None, in_place: bool = False) -> DataFrame:
    """Extracted, sanitized and judged content, one row per URL whose last capture has any.

    The capture is chosen before any page is worked on, from URL and id alone, so that a page that
    many items point to, or that was captured often, is worked on once. Pages meet their last
    capture by URL alone (none is later, so one not earlier is it): their HTML moves to its URL at
    most once, and not at all where pages lie by URL already, which ``in_place`` says. A URL whose
    last capture is empty has no content: an older capture does not stand in for it. A
    ``crawl_day`` of the pages is kept.
    """
    languages = iso_languages(pages.sparkSession)
    last = pages.groupBy(F.col("url").alias("_url")).agg(F.max("page_id").alias("_last"))
    is_last = (F.col("url") == F.col("_url")) & (F.col("page_id") >= F.col("_last"))
    captures = pages.join(last.hint("shuffle_hash") if in_place else last, is_last, "left_semi")
    extracted = extract_articles(captures, languages, extractors)
    judged = with_sanitized(extracted, "cleaned_text", "content").drop("cleaned_text").withColumn(
        "issues",
        content_issues(F.col("content"), settings.min_content_length,
                       settings.max_content_length),
    )
    day = [c for c in ("crawl_day",) if c in pages.columns]
    return latest_pages(judged).select("url", *_PAGE_COLUMNS, *day)


def with_outcome(joined: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``outcome``: the first step that failed, or ``built``."""
    no_lang = F.col("page_lang").isNull() & F.lit(settings.require_meta_lang)
    return joined.withColumn(
        "outcome",
        F.when(F.col("content").isNull(), NO_CONTENT)
        .when(no_lang, EXTRACT_FAILED)
        .when(F.col("page_lang").isNotNull() & F.col("meta_lang").isNull(), LANG_UNKNOWN)
        .when(F.size("issues") > 0, INVALID_CONTENT)
        .when(~required_ok(_REQUIRED_ITEM), BUILD_FAILED)
        .otherwise(BUILT),
    )


def merge_article(joined: DataFrame, run_ts: datetime, *keep: str) -> DataFrame:
    """Article columns from an item and its page.

    The item decides where both have a value; an empty string counts as none.
    """
    none = F.lit(None)
    made = {
        "title_translated": none.cast("string"),
        "description_translated": none.cast("string"),
        "language": falsy_coalesce(F.col("language"), F.col("meta_lang")),
        "keywords": split_keywords(F.col("meta_keywords")),
        "schema_version": F.lit(SCHEMA_VERSION),
        "date_scraped": F.lit(run_ts).cast("timestamp"),
        "category": none.cast("string"),
        "related_countries": none.cast("array<string>"),
        "image_url": falsy_coalesce(F.col("image_url"), F.col("top_image")),
        "post_processed": F.lit(False),
    }
    return joined.select(
        *(made.get(f.name, F.col(f.name)).alias(f.name) for f in ARTICLE.fields), *keep)


def with_contents(items: DataFrame, contents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Items with their page's content and their outcome.

    Where the day of the capture is known, one from before the eve of the item's publishing day (UTC)
    does not hold the article and counts as none.
    """
    joined = attach_pages(items, contents)
    if "crawl_day" in contents.columns:
        fits = F.col("crawl_day") >= F.date_sub(utc_date(F.col("date_published")), EVE_DAYS)
        joined = joined.withColumn("content", F.when(fits, F.col("content"))).drop("crawl_day")
    return with_outcome(joined, settings)


def build_items(items: DataFrame, pages: DataFrame, settings: Settings = Settings(),
                extractors: Extractors | None = None) -> DataFrame:
    """Every item with its page's columns and its outcome."""
    return with_contents(items, page_contents(pages, settings, extractors), settings)


def build_articles(items: DataFrame, pages: DataFrame, run_ts: datetime,
                   settings: Settings = Settings(),
                   extractors: Extractors | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles that could be built, and the log (arrival, mkt, url, outcome) of all items."""
    done = build_items(items, pages, settings, extractors)
    articles = merge_article(done.where(F.col("outcome") == BUILT), run_ts, "arrival", "mkt")
    return articles, done.select("arrival", "mkt", "url", "outcome")
