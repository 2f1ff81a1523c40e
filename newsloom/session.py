"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def builder(app: str = "newsloom") -> SparkSession.Builder:
    """A session builder with the engine's settings and nothing cluster-specific."""
    made = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made


def scratch(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    A machine-local folder stands in only in local mode, where every task is on
    this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/newsloom-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """The store that a path is in, and the path as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


# The folders to delete at the end of the `staging` block that this thread is in.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new scratch table and read it back.

    Cuts the lineage so that a lost executor costs a re-read and not a re-run, and,
    unlike a checkpoint of rows, stays columnar: later steps read the columns they use.
    """
    spark = df.sparkSession
    path = scratch(spark)
    if (folders := _FOLDERS.get()) is not None:
        folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what was staged inside the block; its results must be written by its end.

    The list of folders belongs to the block and its thread: two runs in one driver do not
    see each other's.
    """
    folders: list[str] = []
    token = _FOLDERS.set(folders)
    try:
        yield
    finally:
        _FOLDERS.reset(token)
        for path in folders:
            fs, folder = file_system(spark, path)
            fs.delete(folder, True)
