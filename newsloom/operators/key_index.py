"""The unique keys that are stored, as an index bucketed by key.

Each commit adds the URLs and titles of its articles as hashes of 16 bytes, cut into the table's
buckets. A load that asks for its keys reads the hashes of those buckets that it has keys in, where
they are: only the load's own keys are exchanged, to the buckets' layout. No article file is opened.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.bucketed import read_bucketed, write_bucketed
from newsloom.operators.commits import KEYS, Commit, Manifest

KINDS = ("url", "title")
BUCKETS = 32  # of a new table; a large one wants as many as keep a bucket to some hundred MB


def key_of(kind: Column, value: Column) -> Column:
    """Half of the SHA-256 of kind and value, so that one column tells keys apart and buckets them."""
    return F.substring(F.unhex(F.sha2(F.concat_ws(":", kind, value), 256)), 1, 16)


def bucket_of(key: Column, buckets: int) -> Column:
    """The number of the bucket that Spark's writer puts a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


def keys_of(rows: DataFrame) -> DataFrame:
    """(kind, value, key) of the URLs and titles of some rows, each once; a null is no key."""
    pairs = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in KINDS))
    return (rows.select(F.explode(pairs).alias("p")).select("p.kind", "p.value")
            .where(F.col("value").isNotNull()).distinct()
            .withColumn("key", key_of(F.col("kind"), F.col("value"))))


def cut(rows: DataFrame, folder: str, buckets: int) -> tuple[str, ...]:
    """Write (kind, key, load_id), each bucket in a folder of its own, and return which there are."""
    numbered = rows.select("kind", "key", "load_id", bucket_of(F.col("key"), buckets).alias("slot"))
    return write_bucketed(numbered, folder, "slot", "key", buckets)


def add_keys(commit: Commit, accepted: DataFrame) -> None:
    """Add the keys of a load's accepted articles to its commit."""
    rows = keys_of(accepted).withColumn("load_id", F.lit(commit.load_id))
    commit.cells[KEYS] = cut(rows, commit.folder(KEYS), commit.base.buckets)


def scan_keys(spark: SparkSession, path: str, seen: Manifest, but: tuple[str, ...] = (),
              slots: Iterable[int] | None = None) -> DataFrame | None:
    """(kind, key, load_id) of the stored keys, of some buckets or all; None where there are none."""
    rows = read_bucketed(spark, path, KEYS, seen, "kind string, key binary, load_id string", "slot", "int", "key", but,
                         None if slots is None else map(str, slots))
    return None if rows is None else rows.drop("slot")


def known_in_index(spark: SparkSession, path: str, seen: Manifest, items: DataFrame,
                   but: tuple[str, ...] = ()) -> DataFrame:
    """(kind, key) of the items' URLs and titles that are stored, as ``known_keys`` gives them.

    Read once for the buckets that have keys (at most as many numbers as the table has buckets) and
    once for the join, so ``items`` should be staged. The hash join holds the items' keys of a
    bucket and lets the stored ones pass by, unsorted and where they lie.
    """
    wanted = keys_of(items)
    slots = []
    if seen.of(KEYS):
        slots = [r[0] for r in wanted.select(bucket_of(F.col("key"), seen.buckets)).distinct().collect()]
    stored = scan_keys(spark, path, seen, but, slots)
    if stored is None:
        return wanted.select("kind", F.col("value").alias("key")).where(F.lit(False))
    found = stored.select("key").join(wanted.hint("shuffle_hash"), "key")
    return found.select("kind", F.col("value").alias("key")).distinct()
