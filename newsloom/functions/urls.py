"""URL parts and the routes that depend on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: hosts whose pages have a fetcher of their own.
CUSTOM_DOMAINS = ("www.msn.com",)


def url_netloc(url: Column) -> Column:
    """Authority with user and port; empty where the URL has none."""
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)


def clean_image_url(url: Column) -> Column:
    """Text before the first ``&``; null where nothing is left."""
    return F.nullif(F.split_part(url, F.lit("&"), F.lit(1)), F.lit(""))


def fetch_route(url: Column, custom: tuple[str, ...] = CUSTOM_DOMAINS) -> Column:
    """``custom_{host}`` for hosts with their own fetcher, else ``cascade``."""
    host = url_netloc(url)
    return F.when(host.isin(*custom), F.concat(F.lit("custom_"), host)).otherwise(F.lit("cascade"))
