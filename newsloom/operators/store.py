"""Appending to the article table, and what happens to rows that are refused."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.contract import with_contract_issues
from newsloom.functions.scalars import empty_to_null, utc_date
from newsloom.operators.commits import ARTICLES, Commit
from newsloom.operators.dedup import two_key_insert
from newsloom.operators.key_index import BUCKETS, add_keys, known_in_index
from newsloom.operators.numbering import with_position
from newsloom.operators.summary import add_summary
from newsloom.schemas import ARTICLE, QUARANTINE
from newsloom.session import stage


def serialize(df: DataFrame) -> DataFrame:
    """Last shaping before a write: URLs as text, an empty image URL as null."""
    return df.withColumns({
        "url": F.col("url").cast("string"),
        "image_url": empty_to_null(F.col("image_url").cast("string")),
    })


@dataclass(frozen=True)
class Verdicts:
    """A judged batch: ``accepted`` article rows, and ``rejected`` ones with a reason."""

    accepted: DataFrame
    rejected: DataFrame


def judge(batch: DataFrame, known: DataFrame) -> Verdicts:
    """Split a staged batch of articles (with ``arrival``) by contract and unique keys.

    ``known`` is what ``known_keys`` found stored, staged. A row that breaks the contract
    takes no key. The keys are judged on three narrow columns; the articles themselves move
    once, by arrival number, and are staged with their verdict for both results.
    """
    shaped = with_contract_issues(serialize(batch))
    good = stage(shaped.where(F.size("contract_issues") == 0).select("arrival", "url", "title"))
    old = tuple(known.where(F.col("kind") == k).select(F.col("key").alias(k)) for k in ("url", "title"))
    keyed = two_key_insert(good, "arrival", stored=old)
    verdict = keyed.select("arrival", "accepted", F.col("reason").alias("_reason"))
    rows = stage(shaped.join(verdict, "arrival", "left"))
    broken = F.array_join("contract_issues", ", ")
    rejected = rows.where(~F.coalesce("accepted", F.lit(False))).withColumn(
        "failure_reason", F.coalesce("_reason", broken))
    return Verdicts(
        rows.where("accepted").select(*batch.columns),
        rejected.select(*batch.columns, "failure_reason"),
    )


def write_errors(rejected: DataFrame, batch: DataFrame, *within: str) -> DataFrame:
    """(index, url, error) per refused row; ``index`` is the row's place in the batch.

    With ``within`` (columns of the batch, which must be sorted by them first) the batch is
    cut into batches of their own, and the columns come first in the result.
    """
    places = with_position(batch.select("arrival", *within), "arrival", name="index")
    if within:
        # One small row for each source and market.
        first = places.groupBy(*within).agg(F.min("index").alias("_first"))
        places = places.join(first, list(within)).withColumn("index", F.col("index") - F.col("_first"))
    return (
        rejected.select("arrival", "url", "failure_reason").join(places, "arrival")
        .select(*within, "index", "url", F.col("failure_reason").alias("error"))
    )


def add_articles(commit: Commit, accepted: DataFrame) -> None:
    """Add a load's articles, their keys and the days they touch to its commit.

    Large days are split over tasks and small ones share one (the rebalance hint lets the adaptive
    planner do both); rows of a country lie together in a file, so that its statistics prune the
    others.
    """
    laid_out(accepted.withColumn("load_id", F.lit(commit.load_id))).write.partitionBy("pub_date").parquet(
        commit.folder(ARTICLES))
    add_keys(commit, accepted)
    add_summary(commit, accepted)


def laid_out(articles: DataFrame) -> DataFrame:
    """Article rows (with ``load_id``) in the order they are stored in."""
    return (
        articles.select(*(f.name for f in ARTICLE.fields), "load_id")
        .withColumn("pub_date", utc_date(F.col("date_published")))
        .hint("rebalance", "pub_date")
        .sortWithinPartitions("pub_date", "origin_country")
    )


def write_articles(accepted: DataFrame, path: str, load_id: str) -> None:
    """Publish one load of the article table; written again, it takes the place of the first."""
    commit = Commit(accepted.sparkSession, path, load_id, BUCKETS)
    add_articles(commit, accepted)
    commit.publish()


def refused(rejected: DataFrame) -> DataFrame:
    """The refused rows as they are kept, with their reason; one without a reason stops the write."""
    reason = F.coalesce("failure_reason", F.raise_error(F.lit("a refused row has no failure_reason")))
    return rejected.withColumn("failure_reason", reason).select(*(f.name for f in QUARANTINE.fields))


def quarantine(rejected: DataFrame, path: str, load_id: str) -> DataFrame:
    """Write the refused rows of a load to a folder of their own, and return them as stored."""
    folder = f"{path}/load_id={load_id}"
    refused(rejected).write.mode("overwrite").parquet(folder)
    return rejected.sparkSession.read.schema(QUARANTINE).parquet(folder)


def append_articles(batch: DataFrame, path: str, load_id: str) -> tuple[DataFrame, DataFrame]:
    """Unordered append of articles (with ``arrival``): good rows are written even if
    others fail. Returns the accepted keys and the errors; an empty batch writes nothing.
    """
    spark = batch.sparkSession
    commit = Commit(spark, path, load_id, BUCKETS)
    staged = stage(batch)
    known = known_in_index(spark, path, commit.base, staged, but=(load_id,))
    verdicts = judge(staged, stage(known))
    add_articles(commit, verdicts.accepted)
    commit.publish()
    accepted = verdicts.accepted.select("arrival", "url", "title")
    return accepted, write_errors(verdicts.rejected, staged)
