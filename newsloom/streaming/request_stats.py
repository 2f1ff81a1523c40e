"""Statistics of page requests as a stream over the attempts that land.

The stream counts by run, method and status. Its state and the files it has taken are in a checkpoint
of its own, so that an attempt counts once, however many loads a run has, and whether or not a batch
is done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators import telemetry
from newsloom.operators.commits import Commit, read_part

ATTEMPT = T.StructType([T.StructField("method", T.StringType()), T.StructField("status", T.IntegerType())])
COUNTS = "request_counts"
_STORED = T.StructType([
    T.StructField("run", T.StringType()), *ATTEMPT.fields, T.StructField("count", T.LongType()),
    T.StructField("load_id", T.StringType())])
VIEWS = {"request_summary": telemetry.request_summary_of, "status_breakdown": telemetry.status_breakdown_of,
         "status_overall": telemetry.status_overall_of}


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave this checkpoint.

    Batch numbers start again with a new checkpoint; with the id in the load's name, its
    loads do not replace those of the old one.
    """
    kept = spark.read.json(f"{checkpoint}/metadata").first()
    return kept["id"].split("-")[0]


def keep_counts(counts: DataFrame, table: str, load_id: str) -> None:
    """Publish (run, method, status, count) rows; they are totals as far as they were known then."""
    commit = Commit(counts.sparkSession, f"{table}/{COUNTS}", load_id)
    commit.write(COUNTS, counts.select("run", "method", "status", "count"))
    commit.publish()


def count_requests(spark: SparkSession, attempts_path: str, table: str, checkpoint: str, run: str,
                   fmt: str = "json", files_per_batch: int | None = None) -> None:
    """Count the attempts (``ATTEMPT``) that landed since the last call as those of ``run``.

    What an earlier call had begun and not finished counts in this run. The state has a row for each
    run, method and status.
    """
    reader = spark.readStream.schema(ATTEMPT).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # One key of all three: a constant that stood alone would be no part of the state's key.
    key = F.struct(F.lit(run).alias("run"), "method", "status").alias("key")
    counted = reader.load(attempts_path).groupBy(key).agg(F.count(F.lit(1)).alias("count")).select("key.*", "count")

    def take(batch: DataFrame, batch_id: int) -> None:
        name = stream_id(batch.sparkSession, checkpoint)
        keep_counts(batch, table, f"{name}-{batch_id:06d}")

    (counted.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def request_counts(spark: SparkSession, table: str, run: str | None = None) -> DataFrame:
    """(run, method, status, count) of a run, or of all of them.

    A total only grows, so the greatest of those kept is the latest.
    """
    kept = read_part(spark, f"{table}/{COUNTS}", COUNTS, _STORED)
    if kept is None:
        kept = spark.createDataFrame([], _STORED)
    if run is not None:
        kept = kept.where(F.col("run") == run)
    return kept.groupBy("run", "method", "status").agg(F.max("count").alias("count"))


def request_view(spark: SparkSession, table: str, name: str, run: str | None = None) -> DataFrame:
    """``request_summary``, ``status_breakdown`` or ``status_overall`` of each run."""
    return VIEWS[name](request_counts(spark, table, run), "run")
