"""Main text by scored blocks, on pages with menus, teasers and comments."""

import re
import time

import pytest
from pyspark.sql import functions as F

from newsloom.functions import blocks as B
from newsloom.operators.extraction import Extractors, extract_articles

PROSE = [
    "The council of the town has decided that the old bridge at the mill is to be closed for a year, as it was "
    "found to be unsafe in the spring.",
    "Work on the bridge is to begin in May, and it is expected that traffic will have to take the road by the lake.",
    "A new bridge was asked for by many, but the money for it is not in the plan of the council for this year.",
]
MENU = "".join(f'<li><a href="/{n}">{n} of the day</a></li>' for n in ("News", "Sport", "Weather", "Culture"))
TEASERS = "".join(f'<div><a href="/t{k}">Read on: the story of the week that is on the list {k}</a></div>' for k in range(6))
COMMENTS = "".join(f"<div class=c><b>user{k}</b> <p>Nice one {k}!</p></div>" for k in range(8))


def page(*middle):
    return (f"<html><head><title>The bridge is closed</title></head><body><nav><ul>{MENU}</ul></nav>"
            + "".join(middle) + f"<section>{COMMENTS}</section><aside>{TEASERS}</aside><footer>All rights</footer></body></html>")


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.fixture
def main(column):
    return lambda *pages: column(B.block_main_raw, pages)


def test_prose_without_an_article_tag(main):
    (got,) = main(page("<div>", paragraphs(*PROSE), "</div>"))
    assert got.split("\n") == PROSE


def test_a_heading_between_paragraphs_stays(main):
    (got,) = main(page(paragraphs(PROSE[0]), "<h2>What comes next</h2>", paragraphs(*PROSE[1:])))
    assert got.split("\n") == [PROSE[0], "What comes next", *PROSE[1:]]


def test_an_article_of_teasers_does_not_win(main):
    (got,) = main(page(f"<article>{TEASERS}</article>", "<div>", paragraphs(*PROSE), "</div>"))
    assert got.split("\n") == PROSE


def test_links_inside_prose_do_no_harm(main):
    linked = PROSE[0].replace("old bridge", '<a href="/b">old bridge</a>')
    (got,) = main(page(paragraphs(linked, *PROSE[1:])))
    assert got.split("\n") == PROSE


def test_nothing_to_find(main):
    assert main("", None, "<p></p>", f"<ul>{MENU}</ul>", "<p>Short.</p>") == [""] * 5


def test_other_languages_and_entities(main):
    german = "Die Br&uuml;cke an der M&uuml;hle ist nicht sicher und wird mit dem Beginn des Sommers von der Stadt gesperrt."
    assert main(page(paragraphs(german))) == [german]


def python_blocks(html):
    """Words, links, function words and scores of a page's blocks, in plain Python."""
    def words(raw):
        bare = re.sub(r"&#?[a-zA-Z0-9]{1,31};?", " ", re.sub(r"<[^<>]*>", " ", raw))
        return [w for w in re.split(r"[^\w]+|_", bare.lower()) if w]

    out = []
    for raw in re.split(B.BOUNDARY, re.sub(B.TITLE.replace(r"\z", r"\Z"), " ", html)):
        own = words(raw)
        links = sum(len(words(re.match(r"(?is)(.*?)(?:</a\s*>|\Z)", part)[1])) for part in re.split(B.ANCHOR, raw)[1:])
        stops = sum(w in B.FUNCTION_WORDS for w in own)
        if own:
            counts = (stops >= 2 or len(own) >= 20) and 2 * links <= len(own)
            out.append((len(own), links, stops, min(len(own), 100) + 10 * stops if counts else 0))
    scores = [2 * b[3] + sum(out[k][3] for k in (i - 1, i + 1) if 0 <= k < len(out)) for i, b in enumerate(out)]
    return [(*b, s) for b, s in zip(out, scores)]


def test_scores_equal_plain_python(column):
    pages = [page(paragraphs(*PROSE)), page(f"<article>{TEASERS}</article>", "<div>", paragraphs(*PROSE)),
             "<p>a <a href=x>b c", "no tags at all, of the kind that is here", "<P>x<BR>y</P><A>z</A>"]
    got = column(B.scored_blocks, pages)
    assert [[(b.words, b.links, b.stops, b.own, b.score) for b in p] for p in got] == [python_blocks(p) for p in pages]


def test_open_tags_and_many_blocks_take_linear_time(spark):
    rows = [(1, "u", "<p <a <div " * 60_000), (2, "v", "<a>" * 200_000), (3, "w", "<p>the of and" * 60_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    began = time.time()
    pages.select(F.length(B.block_main_raw(F.col("html")))).collect()
    assert time.time() - began < 60


def test_blocks_as_an_extractor(spark):
    html = page(f"<article>{TEASERS}</article>", "<div>", paragraphs(*PROSE), "</div>")
    pages = spark.createDataFrame([(1, "https://h/1", html)], "page_id long, url string, html string")
    first = extract_articles(pages, ("en",)).first().cleaned_text
    scored = extract_articles(pages, ("en",), Extractors(B.block_main_raw)).first().cleaned_text
    assert "Read on" in first and scored.split("\n\n") == PROSE
