"""One whole run: items of all sources and markets against pages and stored articles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.config import Settings
from newsloom.functions.scalars import utc_date
from newsloom.operators.build import (ALREADY_EXISTS, BUILT, EVE_DAYS, merge_article, page_contents,
                                      with_contents)
from newsloom.operators.extraction import Extractors
from newsloom.operators.joins import stored_flag
from newsloom.operators.numbering import with_position
from newsloom.operators.store import judge
from newsloom.session import stage
from newsloom.sources.page_store import PageStore

ARRIVAL = ("source_ord", "market_ord", "response", "pos")


@dataclass(frozen=True)
class Run:
    """``items`` has one row per item with its outcome and whether it was accepted."""

    items: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def wanted_pages(pages: DataFrame, items: DataFrame, in_place: bool = False) -> DataFrame:
    """Only the pages the items point to.

    The staged items' URLs have a known size: where they are small, Spark sends them to the
    page scan; where they are not, a Bloom filter of them keeps the other pages out of the
    join's shuffle. ``in_place`` says that the pages lie by URL: then the URLs go to them.
    """
    urls = items.select("url").distinct()
    return pages.join(urls.hint("shuffle_hash") if in_place else urls, "url", "left_semi")


def contents_of(items: DataFrame, pages: DataFrame | PageStore, settings: Settings,
                extractors: Extractors | None) -> DataFrame:
    """The contents of the items' pages.

    From a page store only the crawl days are read on which these items' pages can have been
    crawled: from the eve of the earliest publishing day on. Its pages are worked on in place, and
    what they give is staged, so that a URL with very many items is the items' matter only.
    """
    if isinstance(pages, DataFrame):
        return page_contents(wanted_pages(pages, items), settings, extractors)
    first = items.agg(F.date_sub(F.min(utc_date(F.col("date_published"))), EVE_DAYS)).first()[0]
    wanted = wanted_pages(pages.since(first), items, in_place=True)
    return stage(page_contents(wanted, settings, extractors, in_place=True))


def plan_run(items: DataFrame, pages: DataFrame | PageStore, known_of: Callable[[DataFrame], DataFrame], run_ts: datetime,
             settings: Settings = Settings(), extractors: Extractors | None = None) -> Run:
    """Plan a run for items with the ``ARRIVAL`` columns.

    ``known_of`` gives (kind, key) of the items' URLs and titles that are stored; it is asked once, for
    both unique keys (see ``known_in_index`` and, for a history without an index, ``known_keys``). All
    markets are one job. The reference order - markets one after another, each seeing what the
    markets before it stored - is restored from the accepted URLs: an item whose URL an earlier
    market stored was never tried.
    """
    arrived = with_position(items, *ARRIVAL, name="arrival")
    known = stage(known_of(arrived))
    urls = known.where(F.col("kind") == "url").select(F.col("key").alias("url"))
    flagged = stage(stored_flag(arrived, urls))
    new = flagged.where(~F.col("is_stored"))
    done = stage(with_contents(new, contents_of(new, pages, settings, extractors), settings))

    batch = merge_article(done.where(F.col("outcome") == BUILT), run_ts, "arrival")
    verdicts = judge(batch, known)

    market = F.struct("source_ord", "market_ord")
    placed = done.select("arrival", "source_api", "mkt", "url", "outcome", market.alias("_mine"))
    # Accepted URLs are unique, so each has one owner.
    owners = verdicts.accepted.select("arrival").join(placed, "arrival").select(
        "url", F.col("arrival").alias("_owner"), F.col("_mine").alias("_market"))
    tried = placed.join(owners, "url", "left")
    outcome = F.when(F.col("_market") < F.col("_mine"), ALREADY_EXISTS).otherwise(F.col("outcome"))
    log = tried.select(
        "arrival", "source_api", "mkt", "url", outcome.alias("outcome"),
        F.coalesce(F.col("_owner") == F.col("arrival"), F.lit(False)).alias("accepted"),
    ).unionByName(flagged.where("is_stored").select(
        "arrival", "source_api", "mkt", "url", F.lit(ALREADY_EXISTS).alias("outcome"),
        F.lit(False).alias("accepted"),
    ))
    log = stage(log)
    # A refused row is one that was inserted in vain; a skipped one never was.
    skipped = log.where(F.col("outcome") == ALREADY_EXISTS).select("arrival")
    return Run(log, verdicts.accepted, verdicts.rejected.join(skipped, "arrival", "left_anti"))
