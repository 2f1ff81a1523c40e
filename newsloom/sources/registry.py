"""The sources a run asks, and their union."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.config import MARKETS
from newsloom.sources.dims import market_dim
from newsloom.sources.news_json import (explode_response, failed_responses, lost_rows, normalize_items,
                                        response_rows)

Normalize = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Source:
    """A named source: its raw rows, its markets, and how raw rows become items. Without
    ``normalize`` they are landed API responses, whole or as rows of items."""

    name: str
    raw: DataFrame
    markets: tuple[str, ...]
    normalize: Normalize | None = None
    on_error: str = "fail_market"
    landed: DataFrame | None = None   # the API responses that were registered


class Registry:
    """Sources in the order they were registered."""

    def __init__(self) -> None:
        self._sources: dict[str, Source] = {}

    def register_source(self, name: str, raw: DataFrame, markets: tuple[str, ...] = MARKETS,
                        normalize: Normalize | None = None,
                        on_error: str = "fail_market") -> Source:
        """Add a source; without ``normalize`` its rows are landed API responses, whole (see
        ``read_responses``) or exploded, in which ``on_error`` says what a bad item fails."""
        if name in self._sources:
            raise ValueError(f"source {name!r} is already registered")
        landed = None
        if normalize is None:
            landed = raw if "value" in raw.columns else response_rows(raw)
            raw = explode_response(raw) if "value" in raw.columns else raw
        made = Source(name, raw, tuple(markets),
                      normalize or (lambda rows: normalize_items(rows, name, on_error)), on_error, landed)
        self._sources[name] = made
        return made

    def __iter__(self):
        return iter(self._sources.values())


def union_sources(spark: SparkSession, registry: Registry) -> DataFrame:
    """Items of all sources over their valid markets.

    (source_ord, market_ord, response, pos) is the order of arrival. A market that is
    not configured, not valid or failed contributes nothing; ``source_failures`` records it.
    """

    def items_of(ord_: int, source: Source) -> DataFrame:
        markets = market_dim(spark, source.markets).select(
            F.col("ord").alias("market_ord"), "mkt")
        # At most as many rows as configured markets.
        return (
            source.normalize(source.raw)
            .join(F.broadcast(markets), "mkt")
            .withColumn("source_ord", F.lit(ord_))
        )

    parts = [items_of(i, source) for i, source in enumerate(registry)]
    if not parts:
        raise ValueError("no source is registered")
    return reduce(DataFrame.unionByName, parts)


def source_failures(spark: SparkSession, registry: Registry) -> DataFrame:
    """``failed_responses`` of every source, by its own raw rows and markets, with its name.

    Of a source with a normalizer of its own, raw rows that give no item are recorded if they
    have mkt and response, and its items of markets that it does not have in any case.
    """

    def of(source: Source) -> DataFrame:
        markets = market_dim(spark, source.markets)
        if source.landed is not None:
            lost = failed_responses(source.landed, markets, source.on_error)
        else:
            lost = lost_rows(source.raw, source.normalize(source.raw), markets)
        return lost.withColumn("source_api", F.lit(source.name))

    return reduce(DataFrame.unionByName, [of(source) for source in registry])
