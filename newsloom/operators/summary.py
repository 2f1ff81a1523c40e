"""The daily summary as a stored view that a load brings up to date for the days it touches.

Each load keeps its own part of the summary: how often it has each URL of a day and country. Such parts
add up, whatever loads are done again or merged. The days that a load touches, and those that its
earlier attempt touched, are added up anew and stored; all other days stay as they are, and the
manifest says which commit has a day's latest rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.commits import COUNTRIES, Commit, Manifest, manifest, part_folder, read_part
from newsloom.operators.views import by_country_of, daily_urls, recent_articles, summary_of
from newsloom.session import file_system
from newsloom.sources.tables import scan_articles

URLS = "daily_urls"
_COUNTED = T.StructType([
    T.StructField("origin_country", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("count", T.LongType()), T.StructField("load_id", T.StringType()),
    T.StructField("date", T.StringType())])
_BY_COUNTRY = T.StructType([
    T.StructField("origin_country", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("article_urls", T.ArrayType(T.StringType())), T.StructField("date", T.StringType()),
    T.StructField("commit", T.StringType())])


def write_by_day(rows: DataFrame, folder: str) -> tuple[str, ...]:
    """Write rows by ``date``, and return the days there are."""
    rows.hint("rebalance", "date").write.partitionBy("date").parquet(folder)
    fs, at = file_system(rows.sparkSession, folder)
    names = (f.getPath().getName() for f in fs.listStatus(at))
    return tuple(sorted(n.removeprefix("date=") for n in names if n.startswith("date=")))


def add_summary(commit: Commit, accepted: DataFrame) -> None:
    """Add a load's part of the summary to its commit, and the days it touches as they are with it."""
    spark, path, load = commit.spark, commit.path, commit.load_id
    folder = commit.folder(URLS)
    days = commit.cells[URLS] = write_by_day(daily_urls(accepted).withColumn("load_id", F.lit(load)), folder)
    touched = set(days)
    earlier = [p for p in commit.base.of(URLS) if load in p.live()]
    if earlier:  # at most one row for each day of the attempt that is replaced
        old = read_part(spark, path, URLS, _COUNTED, Manifest(parts={URLS: tuple(earlier)}))
        touched |= {r.date for r in old.where(F.col("load_id") == load).select("date").distinct().collect()}
    if not touched:
        return
    rows = read_part(spark, path, URLS, _COUNTED, commit.base, but=(load,), by="date", cells=touched)
    if days:
        own = spark.read.schema(_COUNTED).parquet(folder)
        rows = own if rows is None else rows.unionByName(own)
    left: tuple[str, ...] = ()
    if rows is not None:
        left = write_by_day(by_country_of(rows), f"{part_folder(path, COUNTRIES)}/commit={commit.id}")
    commit.days = {day: commit.id if day in left else "" for day in touched}


def stored_country_counts(spark: SparkSession, path: str, seen: Manifest | None = None) -> DataFrame:
    """``daily_country_counts`` of the table at ``path``, as its loads have stored it."""
    seen = seen or manifest(spark, path)
    base = part_folder(path, COUNTRIES)
    folders = [f"{base}/commit={commit}/date={day}" for day, commit in seen.days.items()]
    if not folders:
        rows = spark.createDataFrame([], _BY_COUNTRY)
    else:
        rows = spark.read.schema(_BY_COUNTRY).option("basePath", base).parquet(*folders)
    return rows.select("date", "origin_country", "count", "article_urls")


def stored_summary(spark: SparkSession, path: str, seen: Manifest | None = None) -> DataFrame:
    """``daily_summary`` of the table at ``path``, newest day first, without reading its articles."""
    return summary_of(stored_country_counts(spark, path, seen))


def recent_stored(spark: SparkSession, path: str, k: int) -> DataFrame:
    """``recent_articles`` of the table at ``path``, from the newest days alone.

    The stored summary says from which day on there are k articles; only these days' folders are
    read. It has a row for each day and country, of which this reads no URLs.
    """
    seen = manifest(spark, path)
    by_day = stored_country_counts(spark, path, seen).groupBy("date").agg(F.sum("count").alias("n"))
    # One small row for each day; the running sum needs them in one place.
    running = F.sum("n").over(Window.orderBy(F.col("date").desc()))
    first = by_day.withColumn("upto", running).where(F.col("upto") - F.col("n") < k).agg(F.min("date")).first()[0]
    rows = scan_articles(spark, path, seen)
    if first is not None:
        rows = rows.where(F.col("pub_date") >= F.lit(first).cast("date"))
    return recent_articles(rows, k)
