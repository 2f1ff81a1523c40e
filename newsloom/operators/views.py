"""The served views and the access paths of the article table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scalars import utc_day

# Fixed value: the columns of the curated view.
_FILTERED = ("url", "title", "description", "date_published", "provider", "language",
             "origin_country", "keywords", "category", "authors", "related_countries",
             "image_url")


def daily_urls(articles: DataFrame) -> DataFrame:
    """Rows by (date, origin_country, url): the form for bulk use, of any size."""
    return (
        articles.select(utc_day(F.col("date_published")).alias("date"), "origin_country", "url")
        .groupBy("date", "origin_country", "url").agg(F.count(F.lit(1)).alias("count"))
    )


def by_country_of(urls: DataFrame, *day: str) -> DataFrame:
    """Per day and country, of rows that count a URL there: all counts, and the set of URLs."""
    day = day or ("date",)
    distinct = urls.groupBy(*day, "origin_country", "url").agg(F.sum("count").alias("count"))
    return (
        distinct.repartitionByRange(F.col("date").desc(), *day[1:])
        .groupBy(*day, "origin_country")
        .agg(F.sum("count").alias("count"),
             F.sort_array(F.collect_list("url")).alias("article_urls"))
    )


def summary_of(counts: DataFrame, *day: str) -> DataFrame:
    """Per day, newest first, of ``by_country_of`` rows: the countries, and the total."""
    day = day or ("date",)
    return (
        counts.groupBy(*day)
        .agg(
            F.array_sort(F.collect_list(F.struct(
                F.col("origin_country").alias("country"), "count", "article_urls",
            ))).alias("countries"),
            F.sum("count").alias("total_count"),
        )
        .orderBy(F.col("date").desc(), *day[1:])
    )


def _grouped(articles: DataFrame, parts: int) -> tuple[DataFrame, list[str]]:
    """Per (date, part, country): rows, and the set of URLs.

    Range-partitioned by day: this one exchange of the distinct URLs serves the grouping by
    country, the grouping by day and the newest-first order of the view.
    """
    urls = daily_urls(articles)
    day = ["date"]
    if parts > 1:
        urls = urls.withColumn("part", F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int"))
        day.append("part")
    made = (
        urls.repartitionByRange(F.col("date").desc(), *day[1:])
        .groupBy(*day, "origin_country")
        .agg(F.sum("count").alias("count"),
             F.sort_array(F.collect_list("url")).alias("article_urls"))
    )
    return made, day


def daily_country_counts(articles: DataFrame, parts: int = 1) -> DataFrame:
    """Rows and URLs by UTC day and country.

    A row lists all URLs of its day and country. ``parts`` cuts every day by URL hash into
    so many parts (0, 1, ...; column ``part``), whatever the day's size: counts of parts add
    up, their URL sets do not overlap. See ``daily_urls`` for days that no row should hold.
    """
    made, day = _grouped(articles, parts)
    return made.select(*day, "origin_country", "count", "article_urls")


def daily_summary(articles: DataFrame, parts: int = 1) -> DataFrame:
    """By day, newest first: the countries with their counts and URLs, and the total.

    ``parts`` as in ``daily_country_counts``.
    """
    made, day = _grouped(articles, parts)
    return summary_of(made, *day)


def filtered_articles(articles: DataFrame) -> DataFrame:
    """Curated articles under their translated title and description."""
    renamed = {"title": "title_translated", "description": "description_translated"}
    return articles.where("post_processed").select(
        *(F.col(renamed.get(c, c)).alias(c) for c in _FILTERED))


def by_category(articles: DataFrame, category: str) -> DataFrame:
    return articles.where(F.col("category") == category)


def by_country(articles: DataFrame, country: str) -> DataFrame:
    return articles.where(F.col("origin_country") == country)


def recent_articles(articles: DataFrame, k: int) -> DataFrame:
    """The k latest articles; ties by URL."""
    return articles.orderBy(F.col("date_published").desc(), "url").limit(k)


def processing_backlog(articles: DataFrame, k: int) -> DataFrame:
    """The k articles scraped last among those not yet curated; ties by URL."""
    return (
        articles.where(~F.col("post_processed"))
        .orderBy(F.col("date_scraped").desc(), "url").limit(k)
    )
