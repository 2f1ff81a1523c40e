"""Joins of items with stored articles and pages.

Plain joins: adaptive execution broadcasts a side that turned out small, splits the partitions
of a hot key on the items' side, and a runtime Bloom filter of the batch's keys keeps most of
the history out of the shuffle. No join here counts its input first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stored_keys(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The stored values of ``key`` that occur in ``batch``."""
    return stored.select(key).join(batch.select(key).distinct(), key, "left_semi")


def new_items_only(items: DataFrame, articles: DataFrame) -> DataFrame:
    """Items whose URL is not stored; run this before any page is touched."""
    return items.join(stored_keys(articles, items, "url"), "url", "left_anti")


def existing_urls(urls: DataFrame, articles: DataFrame) -> DataFrame:
    """Which of the URLs are stored, each once. Copies collapse before the join."""
    return stored_keys(articles, urls, "url").distinct()


def title_conflicts(items: DataFrame, articles: DataFrame) -> DataFrame:
    """New items whose title is stored under another URL; the store will refuse them."""
    new = new_items_only(items, articles)
    return new.join(stored_keys(articles, items, "title"), "title", "left_semi").select(*items.columns)


def attach_pages(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Every item with its page's columns, null where the page was not fetched.

    ``pages`` must hold a URL once (see ``latest_pages``).
    """
    return items.join(pages, "url", "left")


def known_keys(articles: DataFrame, items: DataFrame) -> DataFrame:
    """(key, kind) of stored URLs and titles that occur among the items, in one scan of history.

    ``kind`` is ``url`` or ``title``. A value of a batch is looked up once, however often it
    occurs.
    """
    pair = lambda rows: rows.select(F.explode(F.array(*(
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("key")) for kind in ("url", "title")
    ))).alias("p")).select("p.kind", "p.key").where(F.col("key").isNotNull())
    wanted = pair(items).distinct()
    return pair(articles).join(wanted, ["kind", "key"], "left_semi").distinct()


def stored_flag(items: DataFrame, urls: DataFrame) -> DataFrame:
    """All items with ``is_stored``, for runs that also report the skipped ones."""
    stored = urls.select("url").withColumn("is_stored", F.lit(True))
    return (
        items.join(stored, "url", "left")
        .withColumn("is_stored", F.coalesce("is_stored", F.lit(False)))
    )
