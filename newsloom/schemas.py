"""Table schemas. Every source is read with one of these, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from newsloom.config import SCHEMA_VERSION  # noqa: F401  (re-exported for callers)


def _field(name: str, kind: T.DataType, nullable: bool) -> T.StructField:
    return T.StructField(name, kind, nullable)


_STR, _TS = T.StringType(), T.TimestampType()
_STRINGS = T.ArrayType(T.StringType(), containsNull=False)

# The landed response, the news item and the stored article, column by column.

# One landed API response: value[] of nested article objects.
RESPONSE = T.StructType([
    _field("value", T.ArrayType(T.StructType([
        _field("name", _STR, True),
        _field("url", _STR, True),
        _field("description", _STR, True),
        _field("datePublished", _STR, True),
        _field("provider", T.ArrayType(T.StructType([_field("name", _STR, True)])), True),
        _field("image", T.StructType([
            _field("thumbnail", T.StructType([_field("contentUrl", _STR, True)]), True),
        ]), True),
    ])), True),
])

NEWS_ITEM = T.StructType([
    _field("title", _STR, False),
    _field("url", _STR, False),
    _field("description", _STR, False),
    _field("date_published", _TS, False),
    _field("provider", _STR, False),
    _field("origin_country", _STR, False),
    _field("image_url", _STR, True),
    _field("language", _STR, True),
    _field("source_api", _STR, False),
])

PAGE = T.StructType([
    _field("page_id", T.LongType(), True),
    _field("url", _STR, False),
    _field("html", _STR, True),
])

ARTICLE = T.StructType([
    _field("title", _STR, False),
    _field("title_translated", _STR, True),
    _field("url", _STR, False),
    _field("description", _STR, False),
    _field("description_translated", _STR, True),
    _field("date_published", _TS, False),
    _field("provider", _STR, False),
    _field("language", _STR, True),
    _field("content", _STR, False),
    _field("origin_country", _STR, False),
    _field("keywords", _STRINGS, True),
    _field("source_api", _STR, False),
    _field("schema_version", _STR, False),
    _field("date_scraped", _TS, False),
    _field("category", _STR, True),
    _field("authors", _STRINGS, True),
    _field("related_countries", _STRINGS, True),
    _field("image_url", _STR, True),
    _field("post_processed", T.BooleanType(), False),
])

QUARANTINE = T.StructType([
    *(T.StructField(f.name, f.dataType, True) for f in ARTICLE.fields),
    _field("failure_reason", _STR, False),
])

# What the store requires to be present, in the order it is reported.
REQUIRED = (
    "title", "url", "description", "date_published", "provider", "content",
    "origin_country", "source_api", "schema_version", "date_scraped", "post_processed",
)

BUILD_LOG = T.StructType([
    _field("arrival", T.LongType(), True),
    _field("source_api", _STR, True),
    _field("mkt", _STR, True),
    _field("url", _STR, True),
    _field("outcome", _STR, True),
    _field("accepted", T.BooleanType(), True),
    _field("load_id", _STR, True),
])
