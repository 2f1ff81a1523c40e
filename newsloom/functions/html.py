"""Article text and metadata out of HTML, with regular expressions only.

``pruned`` below means HTML without comments, scripts and styles; take it once per page
and give it to the rest.
"""

from __future__ import annotations

import html

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.scalars import WS, WS_CHARS, collapse_ws
from newsloom.functions.text import text_udf

# What is left open runs to the end of the page. A pattern here never looks past the next
# '<' for the end of a tag, or takes all the rest: pages of unclosed tags cost no more
# than others.
_PRUNE = (r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*>|\z)"
          r"|style\b.*?(?:</style\s*>|\z))")
_ARTICLE = r"(?i)<article\b[^<>]*>"
_ARTICLE_END = r"(?i)</article\s*>"
_BLOCK = r"(?i)</?(?:p|br|h[1-6]|li|div)\b[^<>]*>"
# A paragraph ends at its own end tag or at the next block, whichever comes first.
_PARAGRAPH = (r"(?is)<p\b[^<>]*>(.*?)(?=</?(?:p|div|h[1-6]|li|ul|ol|table|section|nav|main|"
              r"aside|header|footer|article|body|html)\b|\z)")
_TAG = r"<[a-zA-Z/!?][^>]*(?:>|\z)"
_LANG = r"(?is)<html\b[^<>]*?(?<![\w:-])lang\s*=\s*[\"']?([^\"'\s<>]*)"
# The entities decoded without leaving the JVM, '&amp;' last.
_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)
_OTHER_ENTITY = (r"&(?!(?:" + "|".join(e[1:-1] for e, _ in _ENTITIES) + r");)"
                 r"(?:#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z])")


def prune(page: Column) -> Column:
    return F.regexp_replace(page, _PRUNE, " ")


def decode_entities(c: Column) -> Column:
    """Character references to characters.

    Text with references beyond the few above is decoded by the standard library; the
    UDF sees null for all other text. ``c`` is read several times: pass a plain column.

    The UDF is declared nondeterministic, which it is not, because the planner otherwise
    copies whatever is computed from its result into every place that uses that.
    """
    simple = c
    for entity, char in _ENTITIES:
        simple = F.replace(simple, F.lit(entity), F.lit(char))
    has_any = c.contains("&")
    other = has_any & c.rlike(_OTHER_ENTITY)
    decoded = text_udf(html.unescape).asNondeterministic()(F.when(other, c))
    return F.coalesce(decoded, F.when(has_any, simple).otherwise(c))


def visible_raw(pruned: Column) -> Column:
    """All text, tags to spaces; still encoded."""
    return F.regexp_replace(pruned, _TAG, " ")


def main_raw(pruned: Column) -> Column:
    """Body of the first ``<article>``, or the paragraphs of a page without one."""
    paragraphs = F.array_join(F.regexp_extract_all(pruned, F.lit(_PARAGRAPH), F.lit(1)), "\n")
    # Null without an <article>; one that is left open runs to the end of the page.
    after = F.get(F.split(pruned, _ARTICLE, 2), F.lit(1))
    body = F.coalesce(F.get(F.split(after, _ARTICLE_END, 2), F.lit(0)), paragraphs)
    return F.regexp_replace(F.regexp_replace(body, _BLOCK, "\n"), _TAG, "")


def maybe_blank(raw: Column) -> Column:
    """True unless the text starts with a character that is surely visible."""
    return ~raw.rlike(rf"(?U)^{WS}*+[^\s\x1c-\x1f&]")


def tidy_lines(decoded: Column) -> Column:
    """Trim every line, drop empty ones, and put a blank line between the rest."""
    lines = F.transform(F.split(decoded, "\n"), lambda line: F.btrim(line, F.lit(WS_CHARS)))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n\n")


def visible_text(decoded: Column) -> Column:
    return collapse_ws(decoded)


def _attribute(pruned: Column, tag_with: str, attribute: str) -> Column:
    """Value of ``attribute`` in the first ``<meta>`` that has ``tag_with``; '' if none."""
    return F.regexp_extract(pruned, _meta(tag_with, attribute), 2)


def _meta(tag_with: str, attribute: str) -> str:
    return (rf"(?is)<meta\b(?=[^<>]*?\s{tag_with}[\"'\s/>])[^<>]*?\s{attribute}\s*=\s*"
            r"([\"'])(.*?)\1")


def _named(*names: str) -> str:
    return rf"(?:name|property)\s*=\s*[\"']?(?:{'|'.join(names)})"


def meta_keywords(pruned: Column) -> Column:
    return _attribute(pruned, _named("keywords"), "content")


def authors(pruned: Column) -> Column:
    found = F.regexp_extract_all(
        pruned, F.lit(_meta(_named("author", "article:author"), "content")), F.lit(2))
    return F.array_remove(F.transform(found, F.trim), "")


def top_image(pruned: Column) -> Column:
    return F.nullif(_attribute(pruned, _named("og:image"), "content"), F.lit(""))


def raw_lang(pruned: Column) -> Column:
    """Two-letter page language in lower case; null where there is none.

    The ``<html lang>`` attribute, else the content-language or lang metas.
    """
    attr = F.regexp_extract(pruned, _LANG, 1)
    first, second = (
        _attribute(pruned, r"http-equiv\s*=\s*[\"']?content-language", "content"),
        _attribute(pruned, r"name\s*=\s*[\"']?lang", "content"),
    )
    # Not coalesce(nullif(..)): the metas are to be looked for only where nothing was found.
    found = F.when(attr != "", attr).otherwise(F.when(first != "", first).otherwise(second))
    two = F.lower(F.substring(found, 1, 2))
    return F.when(two.rlike("^[a-z]{2}$"), two)
