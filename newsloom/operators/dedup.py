"""First-arrival deduplication under one unique key, and under two."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

ROUNDS = 2  # before chains of conflicts are followed


def first_by_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key.

    Spark cuts each map task's output to one row per key before the shuffle (the window
    has a limit of one), so a hot key costs a task no more than any other.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def _first_two(live: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """The least and the second least place of every value of a key."""
    first = live.groupBy(key).agg(F.min("_ord").alias(names[0]))
    later = live.join(first, key).where(F.col("_ord") > F.col(names[0]))
    return first.join(later.groupBy(key).agg(F.min("_ord").alias(names[1])), key, "left")


def _to_their_ends(links: DataFrame) -> DataFrame:
    """(_ord, _to, _odd): where chains of links end, and whether after an odd number of them.

    The distance doubles in every round, so that rounds grow with the logarithm of the longest
    chain. Each is staged.
    """
    now = stage(links.withColumn("_odd", F.lit(True)))
    while True:
        ahead = now.select(F.col("_ord").alias("_to"), F.col("_to").alias("_next"), F.col("_odd").alias("_more"))
        both = stage(now.join(ahead, "_to", "left"))
        if both.where(F.col("_next").isNotNull()).isEmpty():
            return now
        now = both.select("_ord", F.coalesce("_next", "_to").alias("_to"),
                          (F.col("_odd") != F.coalesce("_more", F.lit(False))).alias("_odd"))


def _accepted_in_chains(live: DataFrame, k1: str, k2: str) -> DataFrame:
    """The edges that are first at both keys, and those that this decides along chains.

    An edge that is first at one key and second at the other has one edge before it that it
    conflicts with: it is accepted if that one is not. Such links form chains, and of a chain that
    begins at an edge that is first at both keys every second edge is accepted.
    """
    placed = stage(
        live.join(_first_two(live, k1, ("_a1", "_b1")), k1).join(_first_two(live, k2, ("_a2", "_b2")), k2))
    first1, first2 = F.col("_ord") == F.col("_a1"), F.col("_ord") == F.col("_a2")
    winners = placed.where(first1 & first2).select(k1, k2, "_ord")
    before = F.when(first1 & (F.col("_ord") == F.col("_b2")), F.col("_a2")).when(
        first2 & (F.col("_ord") == F.col("_b1")), F.col("_a1"))
    links = placed.select("_ord", before.alias("_to")).where(F.col("_to").isNotNull())
    ends = _to_their_ends(links).where(~F.col("_odd"))
    even = ends.join(winners.select(F.col("_ord").alias("_to")), "_to", "left_semi").select("_ord")
    return winners.unionByName(placed.join(even, "_ord", "left_semi").select(k1, k2, "_ord"))


def accepted_edges(edges: DataFrame, k1: str, k2: str) -> DataFrame:
    """Of the (k1, k2, _ord) edges, those a one-by-one insert in _ord would accept.

    In a round the edges that come first among all edges of both their keys are accepted,
    and the edges that share a key with them are dropped. An accepted edge cannot be beaten
    by a later one and a dropped edge is beaten for certain, so this is the sequential
    result; nearly all edges are decided in the first round. From the third round on, chains of
    conflicts are followed to their ends as well, so that a chain of any length takes one round.
    What is left then are edges with two or more undecided ones before them. No round gathers the
    edges of a key or of a component in a task.
    """
    live = stage(edges.select(k1, k2, "_ord"))
    won, rounds = [], 0
    while not live.isEmpty():
        if rounds < ROUNDS:
            first1 = live.groupBy(k1).agg(F.min("_ord").alias("_ord"))
            first2 = live.groupBy(k2).agg(F.min("_ord").alias("_ord"))
            winners = stage(first1.join(first2, "_ord").select(k1, k2, "_ord"))
        else:
            winners = stage(_accepted_in_chains(live, k1, k2))
        won.append(winners)
        rest = live.join(winners.select(k1), k1, "left_anti").join(winners.select(k2), k2, "left_anti")
        live = stage(rest.select(k1, k2, "_ord"))
        rounds += 1
    return reduce(DataFrame.unionByName, won) if won else live


def two_key_insert(df: DataFrame, order: str, keys: tuple[str, str] = ("url", "title"),
                   stored: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Add ``accepted`` and ``reason`` as an unordered insert under two unique keys would.

    In the order of ``order`` (a unique whole number), a row is accepted if neither of
    its keys belongs to a stored or an already accepted row. The reason of a refused row
    is ``already_exists`` (first key stored), ``duplicate_<first>`` or
    ``duplicate_<second>``; the first key is checked first. A row with a null key is
    refused as ``missing_key``.

    ``stored`` holds the stored values of either key, each once (see ``stored_keys``). Pass
    few columns, staged: the rows are shuffled on each key.
    """
    k1, k2 = keys
    # Only the first of several copies of a pair can win, and the map side finds it.
    pairs = (
        df.where(F.col(k1).isNotNull() & F.col(k2).isNotNull())
        .groupBy(k1, k2).agg(F.min(order).alias("_ord"))
    )
    verdict = df
    if stored is not None:
        for k, old, mark in zip(keys, stored, ("_old1", "_old2")):
            pairs = pairs.join(old.select(k), k, "left_anti")
            verdict = verdict.join(old.select(k).withColumn(mark, F.lit(True)), k, "left")
    else:
        verdict = verdict.withColumns({"_old1": F.lit(None).cast("boolean"),
                                       "_old2": F.lit(None).cast("boolean")})
    won = accepted_edges(pairs, k1, k2)
    verdict = verdict.join(won.select(k1, F.col("_ord").alias("_first1")), k1, "left")
    verdict = verdict.join(won.select(k2, F.col("_ord").alias("_first2")), k2, "left")
    reason = (
        F.when(F.col(k1).isNull() | F.col(k2).isNull(), F.lit("missing_key"))
        .when(F.col("_old1"), F.lit("already_exists"))
        .when(F.col("_first1") < F.col(order), F.lit(f"duplicate_{k1}"))
        .when(F.col("_old2") | (F.col("_first2") < F.col(order)), F.lit(f"duplicate_{k2}"))
    )
    return (
        verdict.withColumn("accepted", F.coalesce(F.col("_first1") == F.col(order), F.lit(False)))
        .withColumn("reason", reason)
        .select(*df.columns, "accepted", "reason")
    )
