from newsloom.operators import telemetry as T
from newsloom.operators.fetch import resolve_fetch


def log(spark, *rows):
    return spark.createDataFrame(rows, "method string, status int")


def rows_of(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_request_statistics(spark):
    data = log(spark, ("basic_request", 200), ("basic_request", 200), ("basic_request", 403),
               ("all_methods_failed", 408))
    assert rows_of(T.request_counts(data), "method", "status") == [
        ("all_methods_failed", 408, 1), ("basic_request", 200, 2), ("basic_request", 403, 1)]
    assert rows_of(T.success_rates(data), "method") == [
        ("all_methods_failed", 0.0), ("basic_request", 2 / 3)]
    assert T.success_rate(data, "never_used").first()[0] == 0.0
    assert rows_of(T.request_summary(data), "method") == [
        ("all_methods_failed", 0, 1, 0.0, "0.00%"), ("basic_request", 2, 1, 2 / 3, "66.67%")]
    assert rows_of(T.status_breakdown(data), "method", "status") == [
        ("all_methods_failed", 408, 1, 1, 1.0), ("basic_request", 200, 2, 3, 2 / 3),
        ("basic_request", 403, 1, 3, 1 / 3)]
    assert rows_of(T.status_overall(data), "status") == [
        (200, 2, 4, 0.5), (403, 1, 4, 0.25), (408, 1, 4, 0.25)]
    assert tuple(T.request_totals(data).first()) == (2, 2)
    assert tuple(T.request_totals(data.limit(0)).first()) == (0, 0)


def test_build_statistics(spark):
    built = [("https://a.example.com/1", "en-GB", "built"),
             ("https://a.example.com/2", "en-GB", "already_exists"),
             ("https://a.example.com/3", "en-GB", "invalid_content"),
             ("https://b.example.com/4", "en-US", "no_content"),
             ("https://b.example.com/5", "en-US", "lang_unknown")]
    data = spark.createDataFrame(built, "url string, mkt string, outcome string")
    assert rows_of(T.provider_stats(data), "provider") == [
        ("a.example.com", 1, 1), ("b.example.com", 0, 1)]
    assert T.attempts_total(data).first()[0] == 3
    assert rows_of(T.article_stats(data), "is_total", "provider") == [
        ("a.example.com", 1, 1, 2, False), ("b.example.com", 0, 1, 1, False),
        (None, 1, 2, 3, True)]
    done = data.where("outcome = 'built'")
    assert tuple(T.run_summary(data, done).first()) == (1, 3)
    assert rows_of(T.market_stats(data, done, done), "mkt") == [
        ("en-GB", 3, 1, 1, 1 / 3, 1.0, "33.33%", "100.00%"),
        ("en-US", 2, 0, 0, 0.0, None, "0.00%", "N/A")]


def test_fetch_outcomes(spark):
    tries = {
        "https://h/basic": [("basic", 0, 200)],
        "https://h/postman": [("basic", 0, 403), ("postman", 1, 200)],
        "https://h/browser": [("basic", 0, 403), ("postman", 1, 403), ("playwright", 2, 200)],
        "https://h/none": [("basic", 0, 500), ("postman", 1, 500), ("playwright", 2, 408)],
        "https://h/again": [("basic", 0, 500), ("basic", 0, 200), ("postman", 1, 200)],
        "https://www.msn.com/ok": [("custom", 0, 200)],
        "https://www.msn.com/no": [("custom", 0, 403), ("basic", 1, 200)],
    }
    rows = [(u, *t) for u, ts in tries.items() for t in ts]
    got = resolve_fetch(spark.createDataFrame(
        rows, "url string, method string, step int, status int")).collect()
    assert {r.url: (r.method, r.status) for r in got} == {
        "https://h/basic": ("basic_request", 200), "https://h/postman": ("postman_request", 200),
        "https://h/browser": ("playwright_request", 200),
        "https://h/none": ("all_methods_failed", 408), "https://h/again": ("basic_request", 200),
        "https://www.msn.com/ok": ("custom_www.msn.com_request", 200),
        "https://www.msn.com/no": ("custom_www.msn.com_request", 403)}


def test_fetch_is_one_combining_hash_aggregation(spark, plan):
    text = plan(resolve_fetch(spark.createDataFrame(
        [("u", "basic", 0, 200)], "url string, method string, step int, status int")))
    assert text.count("Exchange") == 1 and "SortAggregate" not in text
    assert text.count("HashAggregate") == 2
