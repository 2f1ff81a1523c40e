"""Main text by scored blocks: runs of paragraphs that read like prose.

A page is cut at every tag of a block. A block's own score rises with its length and its function
words, and is nothing for menus, teasers and other blocks that are mostly links. Neighbours pass half
of theirs on, so that a short line or a heading between paragraphs stays with them. The main text is
the run of blocks around the best one.

All of it is column expressions over arrays, a few linear patterns and no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent function words of the pages' languages, lower case.
FUNCTION_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "in", "is", "it", "of", "on", "or", "that",
    "the", "this", "to", "was", "with",
    "das", "dem", "den", "der", "des", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "dans", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ne", "pas", "pour", "que", "qui", "sur", "une",
    "al", "con", "de", "del", "el", "los", "no", "para", "por", "se", "su", "un", "una", "y",
)
BOUNDARY = (r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form"
            r"|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead"
            r"|title|tr|ul)\b[^<>]*>")
ANCHOR = r"(?i)<a\b[^<>]*>"
TITLE = r"(?is)<title\b.*?(?:</title\s*>|\z)"   # the page's own, which is no block
MIN_WORDS = 20     # of a block without function words
MIN_FUNCTION = 2   # function words of a shorter block
MOST_WORDS = 100   # that add to a score
PER_FUNCTION = 10
LINKED = 2         # a block counts unless more than one in so many words is in a link
NEAR = 4           # a block belongs to the best one's run with one in so many parts of its score
_CUT = "\x01"


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), of), 1)


def _words(raw: Column) -> Column:
    """The words of raw HTML without tags and entities, lower case."""
    bare = F.regexp_replace(F.regexp_replace(raw, r"<[^<>]*>", " "), r"&#?[a-zA-Z0-9]{1,31};?", " ")
    return F.filter(F.split(F.lower(bare), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def _link_words(block: Column) -> Column:
    """How many of a block's words are in links; a link that is not closed ends with the block."""
    after = F.filter(F.split(block, ANCHOR), lambda part, i: i > 0)
    return F.aggregate(
        after, F.lit(0),
        lambda n, part: n + F.size(_words(F.regexp_extract(part, r"(?is)^(.*?)(?:</a\s*>|\z)", 1))))


def _measured(block: Column) -> Column:
    """(raw, words, links, stops) of a block."""
    stops = F.array(*map(F.lit, FUNCTION_WORDS))
    return _let(_words(block), lambda words: F.struct(
        block.alias("raw"), F.size(words).alias("words"), _link_words(block).alias("links"),
        F.size(F.filter(words, lambda w: F.array_contains(stops, w))).alias("stops")))


def own_score(words: Column, links: Column, stops: Column) -> Column:
    """A block's score by itself, a whole number."""
    reads = (stops >= MIN_FUNCTION) | (words >= MIN_WORDS)
    score = F.least(words, F.lit(MOST_WORDS)) + PER_FUNCTION * stops
    return F.when(reads & (LINKED * links <= words), score).otherwise(F.lit(0))


def scored_blocks(pruned: Column) -> Column:
    """The blocks of a page that have a word, in order: (raw, words, links, stops, own, score).

    ``score`` is twice a block's own score and those of its two neighbours.
    """
    cut = F.split(F.regexp_replace(F.regexp_replace(pruned, TITLE, " "), BOUNDARY, _CUT), _CUT)
    full = F.filter(F.transform(cut, _measured), lambda b: b["words"] > 0)
    valued = F.transform(full, lambda b: b.withField("own", own_score(b["words"], b["links"], b["stops"])))

    def passed(blocks: Column) -> Column:
        def beside(i: Column) -> Column:
            return F.coalesce(F.get(blocks, i)["own"], F.lit(0))

        return F.transform(blocks, lambda b, i: b.withField("score", 2 * b["own"] + beside(i - 1) + beside(i + 1)))

    return _let(valued, passed)


def _run(blocks: Column, best: Column, at: Column) -> Column:
    """The blocks around place ``at`` that have a share of the best score without a gap, from the first
    to the last that has a score of its own."""
    def places(wanted: Callable[[Column, Column], Column]) -> Column:
        marked = F.transform(blocks, lambda b, i: F.when(wanted(b, i), i))
        return F.filter(marked, lambda i: i.isNotNull())

    far = lambda b: b["score"] * NEAR < best
    low = F.coalesce(F.array_max(places(lambda b, i: far(b) & (i < at))), F.lit(-1))
    high = F.coalesce(F.array_min(places(lambda b, i: far(b) & (i > at))), F.size(blocks))
    inside = lambda edge: places(lambda b, i: (b["own"] > 0) & (i > edge["low"]) & (i < edge["high"]))
    return _let(F.struct(low.alias("low"), high.alias("high")), lambda edge: _let(
        inside(edge), lambda own: F.slice(
            blocks, F.array_min(own) + 1, F.array_max(own) - F.array_min(own) + 1)))


def block_main_raw(pruned: Column) -> Column:
    """The main text of a pruned page, still encoded, one block to a line; empty if no block has a score.

    An extractor, as ``Extractors`` takes one.
    """
    def text(blocks: Column) -> Column:
        scores = F.transform(blocks, lambda b: b["score"])
        best = F.array_max(scores)
        peak = F.struct(best.alias("score"), (F.array_position(scores, best).cast("int") - 1).alias("at"))

        def lines(top: Column) -> Column:
            run = _run(blocks, top["score"], top["at"])
            plain = F.transform(run, lambda b: F.regexp_replace(b["raw"], r"<[^<>]*>", ""))
            return F.when(top["score"] > 0, F.array_join(plain, "\n")).otherwise(F.lit(""))

        return _let(peak, lines)

    return F.coalesce(_let(scored_blocks(pruned), text), F.lit(""))
