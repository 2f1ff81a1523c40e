"""Crawl and build statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scalars import percent_text
from newsloom.functions.urls import url_netloc
from newsloom.operators.build import ATTEMPTS, BUILT
from newsloom.operators.fetch import OK


def _rate(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 of nothing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("method", "status").agg(F.count(F.lit(1)).alias("count"))


def success_rates(log: DataFrame) -> DataFrame:
    """Share of 200s per method; 0.0 for a method without one."""
    ok = F.count_if(F.col("status") == OK)
    return log.groupBy("method").agg(_rate(ok, F.count(F.lit(1))).alias("success_rate"))


def success_rate(log: DataFrame, method: str) -> DataFrame:
    """The rate of one method, 0.0 if it was never used."""
    ok = F.count_if(F.col("status") == OK)
    return log.where(F.col("method") == method).agg(
        _rate(ok, F.count(F.lit(1))).alias("success_rate"))


def _each_once(log: DataFrame) -> DataFrame:
    return log.select("method", "status", F.lit(1).alias("count"))


def request_summary_of(counts: DataFrame, *by: str) -> DataFrame:
    """Successes, failures and their rate per method, of counted attempts (``by``, method, status,
    count); no success counts as 0."""
    total = lambda of: F.coalesce(F.sum(F.when(of, F.col("count"))), F.lit(0))
    counted = counts.groupBy(*by, "method").agg(
        total(F.col("status") == OK).alias("success_count"),
        total(~(F.col("status") == OK)).alias("failure_count"),
    )
    rate = _rate(F.col("success_count"), F.col("success_count") + F.col("failure_count"))
    return counted.withColumn("success_rate", rate).withColumn(
        "success_rate_text", percent_text(F.col("success_rate")))


def request_summary(log: DataFrame) -> DataFrame:
    return request_summary_of(_each_once(log))


def _with_share(counts: DataFrame, *of: str) -> DataFrame:
    """Counted rows with the total of ``of`` and their share of it. One row for each status at most."""
    total = F.sum("count").over(Window.partitionBy(*of))
    return counts.withColumns({"total_requests": total, "share": _rate(F.col("count"), total)})


def status_breakdown_of(counts: DataFrame, *by: str) -> DataFrame:
    """Each status of a method with its share, of attempts counted by (``by``, method, status)."""
    return _with_share(counts.select(*by, "method", "status", "count"), *by, "method")


def status_breakdown(log: DataFrame) -> DataFrame:
    return status_breakdown_of(request_counts(log))


def status_overall_of(counts: DataFrame, *by: str) -> DataFrame:
    """Each status with its share over all methods, of counted attempts."""
    counted = counts.groupBy(*by, "status").agg(F.sum("count").alias("count"))
    if by:
        return _with_share(counted, *by)
    total = counted.agg(F.sum("count")).scalar()
    return counted.select(
        "status", "count", total.alias("total_requests"),
        _rate(F.col("count"), total).alias("share"),
    )


def status_overall(log: DataFrame) -> DataFrame:
    return status_overall_of(_each_once(log))


def request_totals(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count_if(F.col("status") == OK).alias("total_success"),
        F.count_if(~(F.col("status") == OK)).alias("total_failure"),
    )


def attempts_of(build_log: DataFrame) -> DataFrame:
    """The log's rows that count as an attempt, with their provider."""
    return build_log.where(F.col("outcome").isin(*ATTEMPTS)).select(
        url_netloc(F.col("url")).alias("provider"), (F.col("outcome") == BUILT).alias("ok"))


def provider_stats(build_log: DataFrame) -> DataFrame:
    return attempts_of(build_log).groupBy("provider").agg(
        F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("failed"))


def attempts_total(build_log: DataFrame) -> DataFrame:
    return attempts_of(build_log).agg(F.count(F.lit(1)).alias("total_attempted"))


def article_stats(build_log: DataFrame) -> DataFrame:
    """Provider statistics and, in the row with ``is_total``, their total.

    The total is taken from the provider rows, not from the log a second time.
    """
    return provider_stats(build_log).rollup("provider").agg(
        F.sum("successful").alias("successful"), F.sum("failed").alias("failed"),
        F.sum(F.col("successful") + F.col("failed")).alias("attempts"),
        (F.grouping("provider") == 1).alias("is_total"),
    )


def market_stats(items: DataFrame, built: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per market: items, built, inserted and the two rates (null of nothing).

    All three inputs need only ``mkt``; they are counted in one aggregation.
    """
    flags = ("total_trending", "built", "inserted")
    tagged = reduce(DataFrame.unionByName, (
        df.select("mkt", *(F.lit(int(f == flag)).alias(f) for f in flags))
        for flag, df in zip(flags, (items, built, inserted))
    ))
    return with_rates(tagged.groupBy("mkt").agg(*(F.sum(f).alias(f) for f in flags)))


def with_rates(counted: DataFrame) -> DataFrame:
    build = F.try_divide(F.col("built").cast("double"), F.col("total_trending"))
    insert = F.try_divide(F.col("inserted").cast("double"), F.col("built"))
    return counted.withColumns({
        "build_rate": build,
        "insert_rate": insert,
        "build_rate_text": percent_text(build),
        "insert_rate_text": percent_text(insert, "N/A"),
    })


def market_stats_of_run(rows: DataFrame, *by: str) -> DataFrame:
    """The same from one row per item with ``outcome`` and ``accepted``, per market or, with
    ``by``, per those columns."""
    return with_rates(rows.groupBy(*(by or ("mkt",))).agg(
        F.count(F.lit(1)).alias("total_trending"),
        F.count_if(F.col("outcome") == BUILT).alias("built"),
        F.count_if("accepted").alias("inserted"),
    ))


def run_summary(build_log: DataFrame, inserted: DataFrame) -> DataFrame:
    """Stored N out of M attempts."""
    tagged = build_log.where(F.col("outcome").isin(*ATTEMPTS)).select(
        F.lit(0).alias("s"), F.lit(1).alias("a")
    ).unionByName(inserted.select(F.lit(1).alias("s"), F.lit(0).alias("a")))
    return tagged.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("stored"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("attempts"),
    )
