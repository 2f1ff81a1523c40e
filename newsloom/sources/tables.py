"""Tables a run starts from."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.scalars import empty_to_null
from newsloom.operators.commits import ARTICLES, Manifest, read_part
from newsloom.operators.dedup import first_by_key
from newsloom.schemas import ARTICLE, PAGE

# The article table is laid out by load and publishing day.
STORED = T.StructType([*ARTICLE.fields, T.StructField("load_id", T.StringType(), True),
                       T.StructField("pub_date", T.DateType(), True)])


def write_pages(pages: DataFrame, path: str) -> None:
    """Add pages, laid out by the day of their crawl (``crawl_day``, a date).

    Added again they are there twice; ``store_pages`` keeps loads apart and lays pages out by URL too.
    """
    pages.write.mode("append").partitionBy("crawl_day").parquet(path)


def scan_pages(spark: SparkSession, path: str, fmt: str = "parquet",
               since: date | None = None) -> DataFrame:
    """Crawled pages; an empty page is a page without content.

    ``since`` reads only the folders of that crawl day and later ones, of a table laid out
    by ``write_pages``.
    """
    if since is None:
        pages = spark.read.schema(PAGE).format(fmt).load(path)
    else:
        dated = T.StructType([*PAGE.fields, T.StructField("crawl_day", T.DateType(), True)])
        pages = spark.read.schema(dated).format(fmt).load(path).where(
            F.col("crawl_day") >= F.lit(since)).drop("crawl_day")
    return pages.withColumn("html", empty_to_null(F.col("html")))


def latest_pages(pages: DataFrame) -> DataFrame:
    """One row per URL, the last one captured."""
    return first_by_key(pages, "url", [F.col("page_id").desc()])


def scan_articles(spark: SparkSession, path: str, seen: Manifest | None = None,
                  but: tuple[str, ...] = ()) -> DataFrame:
    """The stored articles, as the newest manifest has them or the one given; none where nothing is
    published. ``but`` leaves loads out."""
    rows = read_part(spark, path, ARTICLES, STORED, seen, but)
    return spark.createDataFrame([], STORED) if rows is None else rows
