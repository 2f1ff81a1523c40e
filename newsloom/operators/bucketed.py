"""Folders of rows cut into buckets by a key, and reading them so that joins on it need no exchange.

Spark writes and reads buckets through tables of its catalogue only. The tables here are just names
for folders: one that is written to is given up again at once, and one that is read is told of the
folders asked for, so that the others are not even listed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.commits import Manifest, Part, counts, part_folder
from newsloom.session import file_system

DECLARED = 500  # folders told to the catalogue in a statement


def write_bucketed(rows: DataFrame, folder: str, by: str, key: str, buckets: int) -> tuple[str, ...]:
    """Write a folder by the values of ``by``, each as one sorted file for every bucket of ``key``, and
    return the values that have files."""
    spark, name = rows.sparkSession, f"newsloom_{uuid.uuid4().hex}"
    (rows.repartition(buckets, key)
     .write.partitionBy(by).bucketBy(buckets, key).sortBy(key)
     .option("path", folder).format("parquet").saveAsTable(name))
    spark.sql(f"drop table {name}")
    fs, at = file_system(spark, folder)
    names = (f.getPath().getName() for f in fs.listStatus(at))
    return tuple(sorted(n.partition("=")[2] for n in names if n.startswith(f"{by}=")))


def read_bucketed(spark: SparkSession, path: str, name: str, seen: Manifest, columns: str, by: str, kind: str, key: str,
                  but: Iterable[str] = (), cells: Iterable[str] | None = None) -> DataFrame | None:
    """The rows that count of a part written by ``write_bucketed``, of some values of ``by`` or all; None
    where there are none. ``columns`` (with load_id) and ``kind``, the type of ``by``, are DDL."""
    parts: list[Part] = [p for p in (p.without(but) for p in seen.of(name)) if p.live()]
    asked = None if cells is None else set(cells)
    wanted = [(p.commit, cell) for p in parts for cell in p.cells if asked is None or cell in asked]
    if not wanted:
        return None
    folder = part_folder(path, name)
    table = f"newsloom_{name}_{hashlib.sha256(folder.encode()).hexdigest()[:32]}"
    spark.sql(f"create table if not exists {table} ({columns}, commit string, {by} {kind}) using parquet "
              f"partitioned by (commit, {by}) clustered by ({key}) into {seen.buckets} buckets location '{folder}'")
    for k in range(0, len(wanted), DECLARED):
        listed = " ".join(f"partition (commit='{commit}', {by}='{cell}')" for commit, cell in wanted[k:k + DECLARED])
        spark.sql(f"alter table {table} add if not exists {listed}")
    commits, values = (sorted({w[k] for w in wanted}) for k in (0, 1))
    rows = spark.table(table).where(F.col("commit").isin(*commits))
    return rows.where(F.col(by).isin(*(F.lit(v).cast(kind) for v in values)) & counts(parts)).drop("commit")
