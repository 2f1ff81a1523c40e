"""Crawled pages laid out for the builds that read them: by crawl day, and bucketed by URL.

Whole pages are moved once, when they are stored. A build then brings its items' URLs to the buckets,
and works on each page where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.scalars import empty_to_null
from newsloom.operators.bucketed import read_bucketed, write_bucketed
from newsloom.operators.commits import PAGES, Commit, Manifest, manifest
from newsloom.schemas import PAGE

BUCKETS = 32  # of a new store; as many as keep a day's bucket to some hundred MB
STORED_PAGE = T.StructType([*PAGE.fields, T.StructField("crawl_day", T.DateType(), True)])


def store_pages(pages: DataFrame, path: str, load_id: str, buckets: int = BUCKETS) -> None:
    """Publish one crawl load of pages (``STORED_PAGE``); stored again, it takes the place of the first.

    ``page_id`` must rise with time: a URL's last capture is the one with the greatest. A page
    without a crawl day is refused.
    """
    commit = Commit(pages.sparkSession, path, load_id, buckets)
    day = F.coalesce("crawl_day", F.raise_error(F.lit("a page has no crawl_day")).cast("date"))
    rows = pages.select("page_id", "url", "html", F.lit(load_id).alias("load_id"), day.alias("crawl_day"))
    folder = commit.folder(PAGES)
    commit.cells[PAGES] = write_bucketed(rows, folder, "crawl_day", "url", commit.base.buckets)
    commit.publish()


@dataclass(frozen=True)
class PageStore:
    """The pages at ``path`` as one manifest has them."""

    spark: SparkSession
    path: str
    seen: Manifest

    @staticmethod
    def at(spark: SparkSession, path: str) -> PageStore | None:
        """The store at a path, None where there is none but perhaps other page files."""
        seen = manifest(spark, path)
        return PageStore(spark, path, seen) if seen.of(PAGES) else None

    def since(self, day: date | None = None) -> DataFrame:
        """Pages crawled on that day or later, with ``crawl_day``; only these days' files are listed."""
        days = {cell for p in self.seen.of(PAGES) for cell in p.cells}
        if day is not None:
            days = {d for d in days if d >= day.isoformat()}
        rows = read_bucketed(self.spark, self.path, PAGES, self.seen, "page_id long, url string, html string, load_id string",
                             "crawl_day", "date", "url", cells=days)
        if rows is None:
            return self.spark.createDataFrame([], STORED_PAGE)
        return rows.drop("load_id").withColumn("html", empty_to_null(F.col("html")))
