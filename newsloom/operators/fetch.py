"""Outcome of a page fetch from the log of its attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.urls import CUSTOM_DOMAINS, url_netloc

# The cascade's methods, in order, and the label when all of them fail.
CASCADE = ("basic", "postman", "playwright")
ALL_FAILED = "all_methods_failed"
OK = 200


def resolve_fetch(attempts: DataFrame, custom: tuple[str, ...] = CUSTOM_DOMAINS) -> DataFrame:
    """One (url, method, status) per URL of ``attempts(url, method, step, status)``.

    The first method of the cascade that got a 200 gives the outcome; if none did, it is
    ``all_methods_failed`` with the last attempt's status. A host with a fetcher of its
    own has one attempt and no cascade. Where a step was tried again, its highest status
    counts as the last.

    Steps and statuses are packed into whole numbers, so that the one aggregation keeps
    plain numbers and combines on the map side.
    """
    rank = F.lit(None).cast("bigint")
    for i, method in enumerate(CASCADE):
        rank = F.when(F.col("method") == method, F.lit(i)).otherwise(rank)
    packed = F.shiftleft(F.col("step").cast("bigint"), 32) + F.col("status")
    seen = attempts.groupBy("url").agg(
        F.min(F.when(F.col("status") == OK, rank)).alias("_ok"),
        F.max(packed).alias("_last"),
        F.min(packed).alias("_first"),
    )
    host = url_netloc(F.col("url"))
    low = F.lit((1 << 32) - 1)
    is_custom = host.isin(*custom)
    won = F.get(F.array(*map(F.lit, CASCADE)), F.col("_ok").cast("int"))
    return seen.select(
        "url",
        F.when(is_custom, F.concat(F.lit("custom_"), host, F.lit("_request")))
        .when(F.col("_ok").isNotNull(), F.concat(won, F.lit("_request")))
        .otherwise(F.lit(ALL_FAILED)).alias("method"),
        F.when(is_custom, F.col("_first").bitwiseAND(low))
        .when(F.col("_ok").isNotNull(), F.lit(OK))
        .otherwise(F.col("_last").bitwiseAND(low)).cast("int").alias("status"),
    )
