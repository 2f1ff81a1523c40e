"""Text sanitation.

Every step is a JVM expression but Unicode normalization, which Spark lacks; that one
goes through an Arrow UDF, and only for text that is not plain ASCII.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scalars import collapse_ws  # noqa: F401  (part of this surface)

# The blocked patterns, in the order they are removed and reported.
SCRIPT = r"<script.*?>.*?</script>"
IFRAME = r"<iframe.*?>.*?</iframe>"
SINGLE_QUOTED = r"(?<!\\)\'.*?(?<!\\)\'"
DOUBLE_QUOTED = r'(?<!\\)".*?(?<!\\)"'
DOLLAR_NAME = r"\$[a-zA-Z_][a-zA-Z0-9_]*"
BLOCKED = (SCRIPT, IFRAME, SINGLE_QUOTED, DOUBLE_QUOTED, DOLLAR_NAME)

# The first two as they are run: the same matches in linear time. If one start finds no
# end, no later one does, so the failing start takes the rest of the text as group 1.
_RUN_AS = {
    SCRIPT: r"<script[^>]*>.*?</script>|(<script.*+)",
    IFRAME: r"<iframe[^>]*>.*?</iframe>|(<iframe.*+)",
}

# A character without which a pattern cannot match.
TRIGGER = {SCRIPT: "<", IFRAME: "<", SINGLE_QUOTED: "'", DOUBLE_QUOTED: '"', DOLLAR_NAME: "$"}



def regex(pattern: str) -> str:
    """The Java pattern: case-insensitive over Unicode, and '.' matches line ends."""
    return "(?isu)" + _RUN_AS.get(pattern, pattern)


def remove(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, regex(pattern), "$1" if pattern in _RUN_AS else "")


def occurs(c: Column, pattern: str) -> Column:
    """Whether a blocked pattern matches somewhere."""
    if pattern not in _RUN_AS:
        return c.rlike(regex(pattern))
    first, rest = (F.regexp_extract(c, regex(pattern), k) for k in (0, 1))
    return (first != "") & (rest == "")


def strip_scripts(c: Column) -> Column:
    return remove(c, SCRIPT)


def strip_iframes(c: Column) -> Column:
    return remove(c, IFRAME)


def strip_single_quoted(c: Column) -> Column:
    return remove(c, SINGLE_QUOTED)


def strip_double_quoted(c: Column) -> Column:
    return remove(c, DOUBLE_QUOTED)


def strip_dollar_names(c: Column) -> Column:
    return remove(c, DOLLAR_NAME)


def strip_tags(c: Column) -> Column:
    """Remove ``<...>``. ``c`` is read several times: pass a plain column.

    Past the last ``>`` no tag can end, and there the pattern is not tried: text full of
    lone ``<`` would cost it the square of its length.
    """
    tail = F.substring_index(c, ">", -1)
    head = F.left(c, F.length(c) - F.length(tail))
    return F.when(c.contains("<"), F.concat(F.regexp_replace(head, "<[^>]+>", ""), tail)).otherwise(c)


def normalize_newlines(c: Column) -> Column:
    """``\\r\\n`` and ``\\r`` to ``\\n``, then runs of ``\\n`` to one."""
    return F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "\n{2,}", "\n")


def html_escape(c: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"),
                         ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def _is_wide(c: Column) -> Column:
    """Whether text is more than ASCII; compares two lengths and decodes nothing."""
    return F.length(c) != F.octet_length(c)


def strip_invisible(c: Column) -> Column:
    """Remove format, private-use and unassigned characters; none of them is ASCII."""
    return F.when(_is_wide(c), F.regexp_replace(c, r"[\p{Cf}\p{Co}\p{Cn}]", "")).otherwise(c)


def text_udf(call, *args: str):
    """Arrow UDF of a standard-library text function; nulls are left alone."""

    # A nested function travels to the workers by value: they need not have the package.
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else call(*args, t) for t in texts.to_pylist()],
                        type=pa.string())

    return F.arrow_udf(run, returnType="string")


def nfkc(c: Column) -> Column:
    """Unicode NFKC.

    ASCII text is its own normal form: the UDF sees null for it, and the test costs no
    decoding. For other text the test for a change would cost more than the change.
    """
    changed = text_udf(unicodedata.normalize, "NFKC")(F.when(_is_wide(c), c))
    return F.coalesce(changed, c)


def with_sanitized(df: DataFrame, source: str, target: str,
                   patterns: Sequence[str] = BLOCKED) -> DataFrame:
    """Add ``target``: ``source`` with every step above applied in order.

    ``patterns`` narrows what is removed. Every step is a projection of its own, so that
    it can first look for a character without which it has nothing to do; all of them up
    to the normalization still run as one generated loop.
    """
    df = df.withColumn(target, F.col(source))
    c = F.col(target)
    for pattern in patterns:
        df = df.withColumn(target, F.when(c.contains(TRIGGER[pattern]), remove(c, pattern))
                           .otherwise(c))
    breaks = c.contains("\r") | c.contains("\n\n")
    return (
        df.withColumn(target, strip_tags(c))
        .withColumn(target, F.when(breaks, normalize_newlines(c)).otherwise(c))
        .withColumn(target, html_escape(c))
        .withColumn(target, nfkc(c))
        .withColumn(target, strip_invisible(c))
    )
