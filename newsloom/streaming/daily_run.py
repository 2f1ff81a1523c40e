"""Incremental runs: each takes the response files that landed since the last one."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.config import Settings
from newsloom.operators import telemetry
from newsloom.operators.build import BUILT
from newsloom.operators.extraction import Extractors
from newsloom.operators.commits import Commit, read_part
from newsloom.operators.key_index import known_in_index
from newsloom.operators.store import add_articles, refused, write_errors
from newsloom.plans.run import plan_run
from newsloom.session import stage, staging
from newsloom.schemas import BUILD_LOG
from newsloom.sources.news_json import LANDED, read_responses
from newsloom.sources.page_store import PageStore
from newsloom.sources.registry import Registry, Source, source_failures, union_sources
from newsloom.sources.tables import scan_pages
from newsloom.streaming.request_stats import VIEWS, count_requests, keep_counts, request_view, stream_id


def process_load(responses: DataFrame, pages: DataFrame | PageStore, table: str, load_id: str,
                 run_ts: datetime, source_api: str, settings: Settings = Settings(),
                 extractors: Extractors | None = None, on_error: str = "fail_market",
                 more_sources: Iterable[Source] = ()) -> None:
    """Build and store one load of responses (see ``read_responses``) under ``table``.

    ``more_sources`` come after the landed one; ``on_error`` holds for those without a normalizer
    of their own too. ``failed_responses`` records what each source lost. All that a load writes is published together at its end (see
    ``commits``), so a load that failed half-way left nothing and is simply done again; one that was
    published does not see its own earlier rows and replaces them, with whatever it finds now.
    """
    spark, path = responses.sparkSession, f"{table}/articles"
    commit = Commit(spark, path, load_id, settings.key_buckets)
    with staging(spark):
        landed = stage(responses)
        registry = Registry()
        registry.register_source(source_api, landed, settings.markets, on_error=on_error)
        for source in more_sources:
            registry.register_source(source.name, stage(source.raw), source.markets, source.normalize, on_error)
        items = union_sources(spark, registry)
        run = plan_run(items, pages, lambda rows: known_in_index(spark, path, commit.base, rows, but=(load_id,)),
                       run_ts, settings, extractors)
        add_articles(commit, run.accepted)
        commit.write("failed_articles", refused(run.rejected))
        commit.write("build_log", run.items)
        commit.write("errors", write_errors(run.rejected, run.items.where(F.col("outcome") == BUILT),
                                            "source_api", "mkt"))
        commit.write("failed_responses", source_failures(spark, registry))
        commit.write("market_stats", telemetry.market_stats_of_run(run.items, "source_api", "mkt"))
        commit.write("run_summary", telemetry.run_summary(run.items, run.items.where("accepted")))
        commit.write("article_stats", telemetry.article_stats(run.items))
        commit.publish()


# Fixed value: the source name stored with every article of the landed API.
SOURCE_API = "BingNewsSource"


def daily_run(spark: SparkSession, landing: str, pages_path: str, table: str, checkpoint: str,
              source_api: str = SOURCE_API, settings: Settings = Settings(),
              extractors: Extractors | None = None, run_ts: datetime | None = None,
              files_per_load: int | None = None, on_error: str = "fail_market",
              more_sources: Callable[[SparkSession], Iterable[Source]] | None = None,
              attempts: Callable[[SparkSession], DataFrame] | None = None,
              pages_since: date | None = None, attempts_path: str | None = None) -> None:
    """Process what is new under ``landing`` (``mkt=<market>/*.json``), then stop.

    ``more_sources`` are asked for in every load. Requests are counted once in a run: those that landed
    at ``attempts_path`` since the last one (see ``count_requests``; its checkpoint is beside this
    run's), or what ``attempts(method, status)`` gives. A page store (``store_pages``) at
    ``pages_path`` is read from the days that a load's items can be from; of a table laid out by
    ``write_pages``, ``pages_since`` reads only pages crawled from that day on.

    The stream's checkpoint knows the files already taken; the article table knows the
    URLs. ``files_per_load`` splits a large backlog into several loads. Schedule the call
    outside. Of two runs that overlap on one table, the one that ends last fails with
    ``ConcurrentLoad`` and can be done again.
    """
    now = run_ts or datetime.now(timezone.utc)

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        pages = PageStore.at(session, pages_path) or scan_pages(session, pages_path, since=pages_since)
        process_load(batch, pages, table,
                     f"{stream_id(session, checkpoint)}-{batch_id:06d}", now, source_api,
                     settings, extractors, on_error,
                     more_sources(session) if more_sources else ())

    reader = spark.readStream.schema(LANDED).option("multiLine", True)
    if files_per_load:
        reader = reader.option("maxFilesPerTrigger", files_per_load)
    query = (
        read_responses(reader.json(landing))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    run = now.isoformat()
    if attempts_path:
        count_requests(spark, attempts_path, table, f"{checkpoint}-requests", run)
    if attempts:
        counts = telemetry.request_counts(attempts(spark)).withColumn("run", F.lit(run))
        keep_counts(counts, table, f"run {run}")


def read_log(spark: SparkSession, table: str, name: str) -> DataFrame:
    """One of the written logs over all loads that are published, or of the statistics of requests
    over all runs."""
    if name in VIEWS:
        return request_view(spark, table, name)
    schema = BUILD_LOG if name == "build_log" else None
    rows = read_part(spark, f"{table}/articles", name, schema)
    if rows is None:
        raise ValueError(f"no load of {table} has written {name}")
    return rows
