"""Requests counted as a stream: each attempt once, in the run that found it."""

import json

import pytest

from newsloom.operators import telemetry as T
from newsloom.streaming import request_stats as R
from tests.test_run import html, site  # noqa: F401


@pytest.fixture
def attempts(spark, tmp_path):
    class Attempts:
        table = str(tmp_path / "table")

        def land(self, file, *rows):
            folder = tmp_path / "attempts"
            folder.mkdir(exist_ok=True)
            (folder / f"{file}.json").write_text(
                "\n".join(json.dumps({"method": m, "status": s}) for m, s in rows) + "\n")

        def count(self, run, **kw):
            R.count_requests(spark, str(tmp_path / "attempts"), self.table, str(tmp_path / "mark"), run, **kw)

        def counts(self, run=None):
            return {(r.run, r.method, r.status): r["count"] for r in R.request_counts(spark, self.table, run).collect()}

    return Attempts()


def test_a_run_counts_what_is_new_once(spark, attempts):
    assert R.request_counts(spark, attempts.table).count() == 0
    attempts.land("1", ("basic", 200), ("basic", 403))
    attempts.land("2", ("basic", 200), (None, None))
    attempts.count("one", files_per_batch=1)
    attempts.count("idle")
    attempts.land("3", ("basic", 200))
    attempts.count("two")
    first = {("one", "basic", 200): 2, ("one", "basic", 403): 1, ("one", None, None): 1}
    assert attempts.counts() == first | {("two", "basic", 200): 1} and attempts.counts("one") == first
    got = {(r.run, r.method): (r.success_count, r.failure_count) for r in R.request_view(
        spark, attempts.table, "request_summary").collect()}
    assert got == {("one", "basic"): (2, 1), ("one", None): (0, 0), ("two", "basic"): (1, 0)}


def test_a_batch_done_again_counts_once(spark, attempts, monkeypatch):
    attempts.land("1", ("basic", 200), ("basic", 200))
    attempts.count("one")
    attempts.land("2", ("basic", 200))
    keep, failed = R.keep_counts, []

    def fails(counts, *rest):
        keep(counts, *rest)
        if not failed:
            failed.append(1)
            raise RuntimeError("lost after publishing")

    monkeypatch.setattr(R, "keep_counts", fails)
    with pytest.raises(Exception, match="lost after publishing"):
        attempts.count("two")
    attempts.count("two")
    assert attempts.counts() == {("one", "basic", 200): 2, ("two", "basic", 200): 1}


def test_views_of_counts_equal_those_of_the_log(spark):
    log = spark.createDataFrame([(f"m{k % 3}", 200 if k % 2 else 400 + k % 5) for k in range(60)], "method string, status int")
    counts = T.request_counts(log)
    for of_log, of_counts in ((T.request_summary, T.request_summary_of), (T.status_breakdown, T.status_breakdown_of),
                              (T.status_overall, T.status_overall_of)):
        assert sorted(map(str, of_log(log).collect())) == sorted(map(str, of_counts(counts).collect()))


def test_loads_of_a_run_do_not_multiply_its_attempts(spark, site, tmp_path, attempts):  # noqa: F811
    attempts.land("1", ("basic", 200), ("basic", 403))
    for k, name in enumerate("abc"):
        site.page(name, html())
        site.land("en-GB", str(k), (name, name.upper()))
    site.run(files_per_load=1, attempts_path=str(tmp_path / "attempts"))
    assert site.log("run_summary").count() == 3
    (row,) = site.log("request_summary").collect()
    assert (row.success_count, row.failure_count) == (1, 1)
