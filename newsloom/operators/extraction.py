"""Pages to extracted articles: projections only, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.functions.scalars import lang_code
from newsloom.functions.urls import url_netloc

Extractor = Callable[[Column], Column]


class Extractors:
    """Main-text overrides by host; other hosts get the default."""

    def __init__(self, default: Extractor = H.main_raw) -> None:
        self._default = default
        self._by_host: dict[str, Extractor] = {}

    def register_extractor(self, host: str, extract: Extractor) -> None:
        """``extract`` maps pruned HTML to the (still encoded) main text."""
        self._by_host[host] = extract

    def main_raw(self, url: Column, pruned: Column) -> Column:
        chosen = self._default(pruned)
        host = url_netloc(url)
        for name, extract in self._by_host.items():
            chosen = F.when(host == name, extract(pruned)).otherwise(chosen)
        return chosen


def with_text(pages: DataFrame, extractors: Extractors | None = None) -> DataFrame:
    """Replace ``pruned`` by ``main_text`` and ``visible_text``.

    The visible text is the fallback; it is computed only for pages whose main text may
    turn out empty and is null elsewhere, so the page itself need not be carried on.
    """
    pick = extractors or Extractors()
    raw = pages.withColumn("_main", pick.main_raw(F.col("url"), F.col("pruned")))
    raw = raw.withColumn(
        "_visible", F.when(H.maybe_blank(F.col("_main")), H.visible_raw(F.col("pruned"))))
    # Both in one projection, so that they share a trip to Python.
    decoded = raw.drop("pruned").withColumns(
        {c: H.decode_entities(F.col(c)) for c in ("_main", "_visible")})
    return decoded.withColumns({
        "main_text": H.tidy_lines(F.col("_main")),
        "visible_text": H.visible_text(F.col("_visible")),
    }).drop("_main", "_visible")


def with_pruned(pages: DataFrame) -> DataFrame:
    return pages.withColumn("pruned", H.prune(F.col("html")))


def extract_articles(pages: DataFrame, languages: tuple[str, ...],
                     extractors: Extractors | None = None) -> DataFrame:
    """Text and metadata of every page that has content.

    ``page_lang`` is the page's language as written, ``meta_lang`` the same if it is a
    known code; the build tells a missing language from an unknown one.
    """
    pruned = with_pruned(pages.where(F.col("html") != "")).drop("html")
    page = F.col("pruned")
    described = pruned.select(
        "*",
        H.raw_lang(page).alias("page_lang"),
        H.meta_keywords(page).alias("meta_keywords"),
        H.authors(page).alias("authors"),
        H.top_image(page).alias("top_image"),
    )
    keep = [c for c in pages.columns if c != "html"]
    return with_text(described, extractors).select(
        *keep,
        F.coalesce(F.nullif("main_text", F.lit("")), "visible_text", F.lit(""))
        .alias("cleaned_text"),
        "page_lang",
        lang_code(F.col("page_lang"), languages).alias("meta_lang"),
        "meta_keywords", "authors", "top_image",
    )
