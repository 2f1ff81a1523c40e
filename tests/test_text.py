import html
import random
import re
import time
import unicodedata
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.functions import contract as C
from newsloom.functions import scalars as V
from newsloom.functions import text as X
from newsloom.functions import urls as U

FLAGS = re.IGNORECASE | re.DOTALL


def model_sanitize(text):
    for pattern in X.BLOCKED:
        text = re.sub(pattern, "", text, flags=FLAGS)
    text = re.sub("<[^>]+>", "", text).replace("\r\n", "\n").replace("\r", "\n")
    text = html.escape(re.sub("\n{2,}", "\n", text), quote=True)
    text = unicodedata.normalize("NFKC", text)
    return "".join(c for c in text if unicodedata.category(c) not in ("Cf", "Co", "Cn"))


def sanitize(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").repartition(4)
    done = X.with_sanitized(rows, "v", "o").orderBy("i")
    return [r.o for r in done.collect()]


def random_texts(alphabet, n, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(length))) for _ in range(n)]


def test_sanitize_drops_unsafe_and_keeps_the_rest(spark):
    given = ("<SCRIPT type=x>steal(document)</SCRIPT>Harbour fees rise by a tenth, $lookup says; "
             "ferry\u200boperators\u200c protest")
    (got,) = sanitize(spark, [given])
    for gone in ("SCRIPT", "steal", "$lookup", "\u200b", "\u200c"):
        assert gone not in got
    assert "Harbour fees rise by a tenth" in got and "ferryoperators protest" in got


def test_sanitize_equals_a_python_model(spark):
    texts = [
        *random_texts(["<script>", "</script>", "<SCRIPT a>", "<iframe>", "</iframe>", "a", " ",
                       "<", ">", "'", '"', "\\", "$x", "$", "\r", "\n", "&", "_1"], 1500, 25, 1),
        *random_texts(list("abc ſKİ＄＂＇ﬁｆé́한") + ["​", "", "<ſcript>",
                      "</script>", "$"], 1500, 20, 2),
    ]
    assert sanitize(spark, texts) == [model_sanitize(t) for t in texts]


def test_escape_lengthens_one_apostrophe_by_five(spark):
    text = "x" * 90 + "'" + "y" * 91
    (got,) = sanitize(spark, [text])
    assert len(text) == 182 and len(got) == 187


def test_text_that_later_steps_make_unsafe_is_refused(spark):
    given = ["$<b>foo" + "x" * 300, "＄foo " + "x" * 300, "$​foo " + "x" * 300,
             "plain " + "x" * 300]
    rows = spark.createDataFrame(list(enumerate(given)), "i int, v string")
    done = X.with_sanitized(rows, "v", "o").withColumn(
        "n", F.size(C.content_issues(F.col("o"), 300, 500)))
    assert [r.n for r in done.orderBy("i").collect()] == [1, 1, 1, 0]


def test_patterns_can_be_narrowed(spark):
    rows = spark.createDataFrame([("It's a don't",)], "v string")
    keep = [p for p in X.BLOCKED if p != X.SINGLE_QUOTED]
    assert X.with_sanitized(rows, "v", "o", keep).first().o == "It&#x27;s a don&#x27;t"
    assert X.with_sanitized(rows, "v", "o").first().o == "Itt"


def test_issues(column):
    def issues(c):
        return C.content_issues(c, 100, 10000)

    fine = ("The council voted on Tuesday to rebuild the old tram line along the river, and the "
            "first cars are to run in spring.")
    unsafe = ("<script>load('ad')</script>The council voted on Tuesday to rebuild the old tram "
              "line along the river; see $budget_2 for what it costs the town.")
    got = column(issues, [fine, "A note.", unsafe, "a" * 100, "a" * 99, "a" * 10000,
                          "a" * 10001])
    assert got[0] == []
    assert got[1] == ["Content does not meet minimum length of 100 characters"]
    assert len(got[2]) == 3
    assert all("potentially unsafe pattern: " in i for i in got[2])
    assert [len(g) for g in got[3:]] == [0, 1, 0, 1]
    assert got[6] == ["Content exceeds maximum length of 10000 characters"]


@pytest.mark.parametrize("piece", ["<script>", "<script ", "<iframe>", "<iframe a='b' "])
def test_two_megabytes_of_unclosed_tags_take_seconds(spark, piece):
    text = piece * (2_000_000 // len(piece))
    rows = spark.createDataFrame([(text,)], "v string")
    start = time.perf_counter()
    done = X.with_sanitized(rows, "v", "o").select(
        F.length("o").alias("n"), C.content_issues(F.col("v"), 1, 10).alias("issues")).first()
    assert time.perf_counter() - start < 30
    assert not [i for i in done.issues if "script" in i or "iframe" in i]


def test_unsafe_patterns_are_found_as_by_the_plain_pattern(column):
    texts = random_texts(["<script>", "</script>", "<SCRIPT a>", "<script", "a", " ", ">", "<"], 800, 12, 5)
    got = column(lambda c: X.occurs(c, X.SCRIPT), texts)
    assert got == [bool(re.search(X.SCRIPT, t, re.I | re.S)) for t in texts]


def test_nfkc_sends_only_wide_text_to_python(column, spark, plan):
    assert column(X.nfkc, ["plain", "ﬁｘ①", "é", "", None]) == [
        "plain", "fix1", "é", "", None]


def test_white_space_is_pythons(column):
    texts = random_texts(list("ab \t\n\r\x0b\x0c\x1c\x1f\x85\xa0   　"),
                         300, 15, 3)
    assert column(V.collapse_ws, texts) == [" ".join(t.split()) for t in texts]
    assert column(V.split_keywords, [*texts, None]) == [*(t.split() for t in texts), []]


def test_percent_text_rounds_as_python_does(column):
    rng = random.Random(4)
    rates = [0.0, 1.0, 0.00125, 0.00375, 1 / 3, 0.5, 0.00005, 0.00015, 2.5,
             *(rng.randrange(b + 1) / b for b in (rng.randrange(1, 9000) for _ in range(3000))),
             *(n / 80000 for n in range(0, 80000, 37)), *(n / 20000 for n in range(0, 20001, 7))]
    got = column(V.percent_text, rates, "double")
    assert got == [f"{r:.2%}" for r in rates]
    assert column(lambda c: V.percent_text(c, "N/A"), [None], "double") == ["N/A"]


def test_iso_timestamps(column):
    good = ["2024-07-01T10:00:00.1234567Z", "2024-07-01T10:00:00+02:00", "2024-07-01",
            "2024-07-01 10:11:12,5", "2024-07-01T10:00:00+0230", "2024-07-01T10:00",
            "2024-07-01T10", "2024-07-01T10:00Z", "2024-07-01T10+02", "2024-07-01T10:00:00-11:30"]
    bad = ["", "x", "2024", "2024-02-31T10:00:00Z", "2024-07-01T25:00:00Z", "10:00", None]
    got = column(lambda c: F.unix_micros(V.parse_iso_ts(c)), good + bad)

    def micros(t):
        stamp = datetime.fromisoformat(t)
        stamp = stamp if stamp.tzinfo else stamp.replace(tzinfo=timezone.utc)
        return round(stamp.timestamp() * 1_000_000)

    assert got == [micros(t) for t in good] + [None] * len(bad)


def test_utc_day_is_the_same_in_every_session_zone(spark, column):
    stamps = [datetime(2024, 1, 1, 23, 30, tzinfo=timezone.utc),
              datetime(1969, 12, 31, 23, 59, 59, tzinfo=timezone.utc)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert column(V.utc_day, stamps, "timestamp") == ["2024-01-01", "1969-12-31"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_urls(column):
    from urllib.parse import urlparse

    urls = ["https://a.example.com/x?y#z", "http://me@h:8080/p", "ftp://h?x", "no url", "", "//h/p",
            "mailto:a@b", "HTTP://UP.example.com"]
    assert column(U.url_netloc, urls) == [urlparse(u).netloc for u in urls]
    assert column(U.clean_image_url, ["https://i/x&w=1", "&x", "", None, "plain"]) == [
        "https://i/x", None, None, None, "plain"]
    assert column(U.fetch_route, ["https://www.msn.com/a", "https://msn.com/a"]) == [
        "custom_www.msn.com", "cascade"]


def test_falsy_values(column):
    assert column(lambda c: V.falsy_coalesce(c, F.lit("b")), ["a", "", None]) == ["a", "b", "b"]
    assert column(lambda c: V.lang_code(c, ("en", "de")), ["EN", "de", "xx", None]) == [
        "en", "de", None, None]
