import random
import re
from html.parser import HTMLParser

from pyspark.sql import functions as F

from newsloom.operators.extraction import Extractors, extract_articles, with_pruned, with_text

LANGS = ("en", "de", "fr", "es")
LONG = "This sentence is here to make the article long enough to be kept. " * 6


class Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.parts.append(" ")
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.parts.append(" ")
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_comment(self, data):
        self.parts.append(" ")  # what it stood between stays apart

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def visible(page):
    parser = Visible()
    parser.feed(page)
    parser.close()
    return " ".join("".join(parser.parts).split())


def extract(spark, *pages, extractors=None):
    rows = [(i, f"https://h{i}.example.com/p", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_articles(df, LANGS, extractors).orderBy("page_id").collect()
    return [r.asDict() for r in got]


def test_article_body_and_metadata(spark):
    (got,) = extract(spark, f"""<html lang="en-GB"><head><title>T</title>
        <meta name="keywords" content="one, two"><META CONTENT='Ann' NAME='author'>
        <meta property="og:image" content="https://i.example.com/a.jpg">
        <script>var t = "<article>no</article>";</script></head>
        <body><nav><p>menu</p></nav><!-- <article>no</article> -->
        <article class="a"><h1>Head</h1><p>First &amp; <b>bold</b> &lt;3</p>
        <p>  second<br>third&nbsp;</p><p></p></article><footer>foot</footer></body></html>""")
    assert got["cleaned_text"] == "Head\n\nFirst & bold <3\n\nsecond\n\nthird"
    assert (got["meta_lang"], got["page_lang"]) == ("en", "en")
    assert got["meta_keywords"] == "one, two"
    assert got["authors"] == ["Ann"]
    assert got["top_image"] == "https://i.example.com/a.jpg"


def test_page_without_article_gives_its_paragraphs(spark):
    (got,) = extract(spark, "<html lang=de><body><div>menu</div><p>One<p>Two <b>x</b></p>"
                            "<pre>code</pre><p>Three<div>side</div></body></html>")
    assert got["cleaned_text"] == "One\n\nTwo x\n\nThree"
    assert got["meta_lang"] == "de"


def test_empty_main_text_falls_back_to_all_text(spark):
    got = extract(spark,
                  "<html><body><article> &nbsp; </article>Test <i>content</i></body></html>",
                  "<html><body>Only this</body></html>",
                  "<html><body><article>&#72;&#105;</article>rest</body></html>")
    assert [g["cleaned_text"] for g in got] == ["Test content", "Only this", "Hi"]


def test_entities_of_every_kind(spark):
    (got,) = extract(spark, "<article>&eacute;&#8217;&#x2019;&hellip; AT&T &amp;lt; &copy 1 "
                            "&notit;</article>")
    import html

    assert got["cleaned_text"] == html.unescape("&eacute;&#8217;&#x2019;&hellip; AT&T &amp;lt; "
                                                "&copy 1 &notit;")


def test_language_sources(spark):
    got = extract(
        spark,
        '<html data-lang="fr"><article>x</article>',
        '<html><meta http-equiv="Content-Language" content="es-MX"><article>x</article>',
        '<html><meta content="DE" name="lang"><article>x</article>',
        '<html lang="zz"><article>x</article>',
        '<html lang=""><article>x</article>',
        '<html lang="1x"><article>x</article>',
    )
    assert [g["page_lang"] for g in got] == [None, "es", "de", "zz", None, None]
    assert [g["meta_lang"] for g in got] == [None, "es", "de", None, None, None]


def test_pages_without_content_are_left_out(spark):
    assert extract(spark, "", None) == []


def test_open_script_and_comment_run_to_the_end(spark):
    got = extract(spark, "<p>seen</p><script>var a = '<p>no</p>'", "<p>seen</p><!-- <p>no</p>")
    assert [g["cleaned_text"] for g in got] == ["seen", "seen"]


def test_visible_text_equals_a_parser(spark):
    rng = random.Random(5)
    bits = ["<p>", "</p>", "<b>", "</b>", "<br>", "word ", "more", " ", "\n", "&amp;", "&eacute;",
            "&#65;", "<!-- c -->", "<script>var x='<p>';</script>", "<style>p{}</style>", "é"]
    pages = ["<html><body>" + "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40)))
             for _ in range(300)]
    # All of it goes through the fallback: an article that is empty, then the text.
    got = extract(spark, *(p.replace("<body>", "<body><article></article>") for p in pages))
    assert [g["cleaned_text"] for g in got] == [visible(p) for p in pages]


def test_given_pages_equal_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    hollow = pages.withColumn(
        "html", F.regexp_replace("html", "<article>", "<article></article>"))
    got = {r.page_id: r.cleaned_text for r in extract_articles(hollow, LANGS).collect()}
    for row in pages.collect():
        assert got[row.page_id] == visible(row.html)


def test_host_overrides(spark):
    own = Extractors()
    own.register_extractor("h1.example.com", lambda page: F.regexp_extract(page, "<i>(.*?)</i>", 1))
    page = "<article>main <i>part &amp; more</i></article>"
    got = extract(spark, page, page, extractors=own)
    assert [g["cleaned_text"] for g in got] == ["main part & more", "part & more"]


def test_hard_pages_take_linear_time(spark):
    """None of these may send a pattern into backtracking."""
    import time

    n = 200_000
    pages = ["<article>" + "<p" * n, "<article>" + " " * n + "x</article>",
             "<article>" + "&nbsp; " * n + "</article>", "<meta " * 5000,
             "<p>" * 50_000, "<script" + ">" * 50_000, "<html " + "lang " * 20_000]
    start = time.time()
    extract(spark, *pages)
    assert time.time() - start < 60


def test_extraction_is_one_stage_and_drops_the_page(spark, plan):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    text = plan(extract_articles(pages, LANGS))
    assert "Exchange" not in text
    assert re.search(r"ReadSchema: struct<page_id:bigint,url:string,html:string>", text)
    # One evaluation of the decoding per column: its result is not copied into later steps.
    assert text.count("ArrowEvalPython") == 1
    assert "pruned" not in text.split("ArrowEvalPython")[0]
    assert with_text(with_pruned(pages)).columns == ["page_id", "url", "html", "main_text",
                                                     "visible_text"]
