"""Landed news-API responses to news items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.scalars import (default_string, market_country, market_language,
                                        parse_iso_ts, provider_name)
from newsloom.functions.urls import clean_image_url
from newsloom.schemas import RESPONSE

# A response file lies under mkt=<market>/. Its items are read as they are, so that one of another
# shape does not hide the others; a file that is no JSON leaves its text in _corrupt_record.
LANDED = T.StructType([T.StructField("value", T.VariantType(), True),
                       T.StructField("_corrupt_record", T.StringType(), True),
                       T.StructField("mkt", T.StringType(), True)])

# Why a response gave no items, or not all of its items.
CORRUPT, UNKNOWN_MARKET, BAD_ITEM = "corrupt", "unknown_market", "bad_item"


def item_is_bad(item: Column) -> Column:
    """No description, no readable date, or an empty provider list.

    For items of a source's own rows, in which a null is a field that is missing.
    """
    return (
        item.isNull() | item["description"].isNull() | parse_iso_ts(item["datePublished"]).isNull()
        | F.coalesce(F.size(item["provider"]) == 0, F.lit(False))
    )


def _kind(v: Column) -> Column:
    """What a JSON value is: STRING, VOID for null, OBJECT or ARRAY among others; empty if missing."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), F.lit(""))


def _at(item: Column, path: str) -> Column:
    return F.try_variant_get(item, f"$.{path}", "variant")


def _text(item: Column, path: str) -> Column:
    return F.when(_kind(_at(item, path)) == "STRING", F.try_variant_get(item, f"$.{path}", "string"))


def json_item(item: Column) -> Column:
    """A JSON item as the struct of a response; fields that are missing or not as they should be are null."""
    named = F.array(F.struct(_text(item, "provider[0].name").alias("name")))
    thumbnail = F.struct(_text(item, "image.thumbnail.contentUrl").alias("contentUrl"))
    return F.struct(
        *(_text(item, name).alias(name) for name in ("name", "url", "description", "datePublished")),
        F.when(_at(item, "provider").isNotNull(), named).alias("provider"),
        F.struct(thumbnail.alias("thumbnail")).alias("image"))


def json_item_is_bad(item: Column) -> Column:
    """The item cannot be taken: it is no object, a text that must be there is not, a date is not
    readable, or any field that is there is null or of another type. A missing name, URL, provider or
    image has a default; a null one has not. Of the providers only the first is looked at."""
    def unlike(path: str, kind: str) -> Column:
        return ~_kind(_at(item, path)).isin("", kind)

    first = _kind(_at(item, "provider[0]"))
    return (
        (_kind(item) != "OBJECT") | unlike("name", "STRING") | unlike("url", "STRING")
        | _text(item, "description").isNull() | parse_iso_ts(_text(item, "datePublished")).isNull()
        | (_at(item, "provider").isNotNull() & ((first != "OBJECT") | unlike("provider[0].name", "STRING")))
        | unlike("image", "OBJECT") | unlike("image.thumbnail", "OBJECT")
        | unlike("image.thumbnail.contentUrl", "STRING")
    )


def read_responses(landed: DataFrame) -> DataFrame:
    """(mkt, response, value, corrupt, bad) of landed files, one row each.

    ``bad`` says for each item whether it is one; it is judged before the items are taken
    apart, so that a response fails as a whole without a join. A response without ``value`` has no
    items; one whose ``value`` is not a list is corrupt.
    """
    items = F.try_variant_get("value", "$", "array<variant>")
    return landed.select(
        "mkt", F.col("_metadata.file_path").alias("response"),
        F.transform(items, json_item).alias("value"),
        (F.col("_corrupt_record").isNotNull() | ~_kind(F.col("value")).isin("", "ARRAY")).alias("corrupt"),
        F.transform(items, json_item_is_bad).alias("bad"))


def with_judgement(responses: DataFrame) -> DataFrame:
    return responses.withColumn("bad", F.transform("value", item_is_bad))


def explode_response(responses: DataFrame) -> DataFrame:
    """One row per element of ``value`` (mkt, response, failed, pos, item, bad); a response without
    the array gives none, nor does a corrupt one, whose other items cannot be trusted."""
    failed = F.exists("bad", lambda b: b)
    rows = responses.where(~F.col("corrupt")).select(
        "mkt", "response", failed.alias("failed"),
        F.posexplode(F.arrays_zip(F.col("value").alias("item"), F.col("bad").alias("bad"))).alias("pos", "_of"))
    return rows.select("mkt", "response", "failed", "pos", F.col("_of.item").alias("item"), F.col("_of.bad").alias("bad"))


def _bad_row(raw: DataFrame) -> Column:
    """Whether a row's item is a bad one, as its response said or by the item alone."""
    return F.col("bad") if "bad" in raw.columns else item_is_bad(F.col("item"))


def scan_news_json(spark: SparkSession, path: str) -> DataFrame:
    """Responses as (mkt, response, failed, pos, item, bad); ``pos`` is the place in its response."""
    landed = spark.read.schema(LANDED).option("multiLine", True).json(path)
    return explode_response(read_responses(landed))


def failed_responses(responses: DataFrame, markets: DataFrame, on_error: str = "fail_market") -> DataFrame:
    """(mkt, response, items, first_bad, reason) of every response whose items are not all taken.

    ``items`` counts those lost: all of a corrupt response (0 if it could not be read at all),
    of one of a market that is not among ``markets(mkt)``, or of one with a bad item; only
    the bad ones under ``quarantine_row``.
    """
    known = markets.select("mkt").withColumn("_known", F.lit(True))
    bad = F.coalesce(F.size(F.filter("bad", lambda b: b)), F.lit(0))
    first = F.array_position("bad", F.lit(True)).cast("int") - 1
    every = F.greatest(F.coalesce(F.size("value"), F.lit(0)), F.lit(0))
    reason = (
        F.when(F.col("corrupt"), CORRUPT).when(F.col("_known").isNull(), UNKNOWN_MARKET)
        .when(bad > 0, BAD_ITEM))
    lost = F.when((F.col("reason") == BAD_ITEM) & F.lit(on_error == "quarantine_row"), F.greatest(bad, F.lit(0)))
    # At most as many rows as configured markets.
    return (
        responses.join(F.broadcast(known), "mkt", "left").withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("mkt", "response", F.coalesce(lost, every).alias("items"),
                F.when(first >= 0, first).alias("first_bad"), "reason")
    )


def response_rows(raw: DataFrame) -> DataFrame:
    """Responses, as ``failed_responses`` takes them, of exploded rows (mkt, response, pos, item)."""
    rows = F.sort_array(F.collect_list(F.struct("pos", _bad_row(raw).alias("bad"))))
    return raw.groupBy("mkt", "response").agg(rows.alias("value")).select(
        "mkt", "response", "value", F.lit(False).alias("corrupt"), F.col("value.bad").alias("bad"))


def lost_rows(raw: DataFrame, items: DataFrame, markets: DataFrame) -> DataFrame:
    """The same record for raw rows and what a normalizer made of them.

    ``items`` counts the raw rows of a response that are more than its items; all of its rows if
    its market is not among ``markets(mkt)``. Raw rows without mkt and response are counted by
    the items.
    """
    keys = ["mkt", "response"]
    took = items.select(*(F.col(k) if k in items.columns else F.lit(None).cast("string").alias(k) for k in keys))
    came = raw if set(keys) <= set(raw.columns) else took
    counts = came.select(*keys, F.lit(1).alias("n_raw"), F.lit(0).alias("n")).unionByName(
        took.select(*keys, F.lit(0).alias("n_raw"), F.lit(1).alias("n")))
    counts = counts.groupBy(*keys).agg(F.sum("n_raw").alias("n_raw"), F.sum("n").alias("n"))
    unknown = F.col("_known").isNull()
    known = markets.select("mkt").withColumn("_known", F.lit(True))
    # At most as many rows as configured markets.
    return (
        counts.join(F.broadcast(known), "mkt", "left")
        .where(unknown | (F.col("n_raw") > F.col("n")))
        .select("mkt", "response", F.when(unknown, F.greatest("n_raw", "n")).otherwise(F.col("n_raw") - F.col("n"))
                .cast("int").alias("items"), F.lit(None).cast("int").alias("first_bad"),
                F.when(unknown, UNKNOWN_MARKET).otherwise(BAD_ITEM).alias("reason"))
    )


def with_item_columns(raw: DataFrame, source_api: str) -> DataFrame:
    """The item columns with their default rules, and ``is_bad``.

    Country and language are the market's, never the article's.
    """
    item, mkt = F.col("item"), F.col("mkt")
    return raw.select(
        *(c for c in raw.columns if c not in ("item", "bad")),
        default_string(item["name"]).alias("title"),
        default_string(item["url"]).alias("url"),
        item["description"].alias("description"),
        parse_iso_ts(item["datePublished"]).alias("date_published"),
        provider_name(item["provider"]).alias("provider"),
        market_country(mkt).alias("origin_country"),
        clean_image_url(item["image"]["thumbnail"]["contentUrl"]).alias("image_url"),
        market_language(mkt).alias("language"),
        F.lit(source_api).alias("source_api"),
        _bad_row(raw).alias("is_bad"),
    )


def normalize_items(raw: DataFrame, source_api: str, on_error: str = "fail_market") -> DataFrame:
    """News items of ``raw(mkt, response, failed, pos, item)``.

    One bad item fails its whole response (``fail_market``), or only itself
    (``quarantine_row``; see ``bad_items`` for those rows, ``failed_responses`` for a record).
    """
    if on_error not in ("fail_market", "quarantine_row"):
        raise ValueError(f"on_error: {on_error!r}")
    items = with_item_columns(raw, source_api).where(~F.col("is_bad"))
    if on_error == "fail_market":
        items = items.where(~F.col("failed"))
    return items.drop("is_bad", "failed")


def bad_items(raw: DataFrame, source_api: str) -> DataFrame:
    """The rows ``quarantine_row`` leaves out."""
    return with_item_columns(raw, source_api).where("is_bad").drop("is_bad", "failed")
