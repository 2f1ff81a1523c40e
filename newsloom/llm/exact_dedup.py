"""Exact deduplication through a cuckoo-filter index of text digests.

The index is a table cut into buckets by digest. A bucket holds its keys as rows, (digest, row
that stays, number of live copies), and one cuckoo filter over them. A batch of digests goes to
its buckets: a digest that the filter does not know is new and is inserted without a lookup; one
that it knows is looked up among the bucket's keys, since a filter may be wrong. A filter that
overflows is rebuilt at twice the size from the stored keys. Deletion counts copies down and
takes the digest out of filter and keys with the last one.

Copies are combined in the tasks that read them, so a digest of a third of all rows arrives
as one row for each Arrow batch, and no text is moved.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.texts import SPACE, may_be_in
from newsloom.session import stage

BUCKET_DIGESTS = 100_000  # digests that a task holds, on average


class Full(Exception):
    """The filter has no room for a fingerprint."""


class CuckooFilter:
    """Sixteen-bit fingerprints in buckets of four; each has two places."""

    SLOTS, KICKS = 4, 200

    def __init__(self, capacity: int = 256, slots: bytes | None = None):
        self.size = 1
        while self.size * self.SLOTS * 0.9 < capacity:
            self.size *= 2
        count = self.size * self.SLOTS
        self.slots = list(struct.unpack(f"<{count}H", slots)) if slots else [0] * count

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(int(len(data) // 2 * 0.9), data)

    def dump(self) -> bytes:
        return struct.pack(f"<{len(self.slots)}H", *self.slots)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark, first = struct.unpack_from("<HQ", digest.ljust(10, b"\0"))
        mark = mark or 1
        first &= self.size - 1
        return mark, first, self._other(mark, first)

    def _other(self, mark: int, place: int) -> int:
        return (place ^ (mark * 0x5BD1E995 >> 7)) & (self.size - 1)

    def _of(self, place: int) -> range:
        return range(place * self.SLOTS, place * self.SLOTS + self.SLOTS)

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        s = self.slots
        return any(s[i] == mark for i in self._of(a)) or any(s[i] == mark for i in self._of(b))

    def _put(self, mark: int, place: int) -> bool:
        for i in self._of(place):
            if not self.slots[i]:
                self.slots[i] = mark
                return True
        return False

    def insert(self, digest: bytes) -> None:
        """Raises Full when no room is found; the table may then have lost a fingerprint, and
        must be built anew from the keys."""
        mark, a, b = self._places(digest)
        if self._put(mark, a) or self._put(mark, b):
            return
        place = b
        for k in range(self.KICKS):
            i = place * self.SLOTS + k % self.SLOTS
            mark, self.slots[i] = self.slots[i], mark
            place = self._other(mark, place)
            if self._put(mark, place):
                return
        raise Full

    def delete(self, digest: bytes) -> None:
        """Takes out one fingerprint; only for a digest known to be in."""
        mark, a, b = self._places(digest)
        for place in (a, b):
            for i in self._of(place):
                if self.slots[i] == mark:
                    self.slots[i] = 0
                    return


def grown(keys, capacity: int) -> CuckooFilter:
    """A filter of at least that capacity over the keys."""
    while True:
        made = CuckooFilter(capacity)
        try:
            for k in keys:
                made.insert(k)
            return made
        except Full:
            capacity = 2 * max(capacity, 1)


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without ASCII white space, in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", ""), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged (row, id, points, sha), one row for each document; ``row`` tells equal rows apart."""
    return stage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.length(F.coalesce(text_col, F.lit(""))).cast("long").alias("points"),
        text_digest(F.col(text_col)).alias("sha")))


def index_schema(kind: T.DataType) -> T.StructType:
    """Keys are rows with a digest, filters rows without."""
    return T.StructType([
        T.StructField("bucket", T.IntegerType()), T.StructField("sha", T.BinaryType()),
        T.StructField("id", kind), T.StructField("points", T.LongType()),
        T.StructField("row", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("filter", T.BinaryType())])


def empty_index(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], index_schema(like.schema["id"].dataType))


ORDER = {"sha": True, "points": False, "id": True, "row": True}


def combined(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of one batch with the same digest become one: the row that stays and their number."""
    kind = rows.schema["id"].dataType
    schema = T.StructType([f for f in index_schema(kind) if f.name not in ("bucket", "filter")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.to_pandas(integer_object_nulls=True)
            t = t.sort_values(list(ORDER), ascending=list(ORDER.values()), na_position="last")
            first = t.drop_duplicates("sha").copy()
            first["size"] = t.groupby("sha", sort=False)["row"].size().to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[c], f.type) for c, f in zip(schema.names, _arrow(schema, batch))],
                names=schema.names)

    return rows.select("sha", "id", "points", "row").mapInArrow(run, schema).withColumn(
        "bucket", F.pmod(F.xxhash64("sha"), F.lit(buckets)).cast("int"))


def _arrow(schema: T.StructType, batch: pa.RecordBatch) -> list[pa.Field]:
    kinds = {"sha": pa.binary(), "points": pa.int64(), "row": pa.int64(), "size": pa.int64(),
             "bucket": pa.int32(), "filter": pa.binary()}
    kinds["id"] = batch.schema.field("id").type
    return [pa.field(c, kinds[c]) for c in schema.names]


def changed(index: DataFrame, batch: DataFrame, delete: bool = False) -> DataFrame:
    """The index after inserting, or deleting, combined digests of the same bucket count.

    Deleting counts copies down; the row that stays is forgotten only with the last of them.
    Digests that are not in the index are not deleted from it.
    """
    schema = index_schema(batch.schema["id"].dataType)

    def rank(r: tuple) -> tuple:
        return (-r[1], r[0] is None, r[0] if r[0] is not None else 0, r[2])

    def update(stored: pa.Table, new: pa.Table) -> pa.Table:
        bucket = (stored if stored.num_rows else new).column("bucket")[0].as_py()
        keys: dict[bytes, tuple] = {}
        known = None
        for r in stored.to_pylist():
            if r["sha"] is None:
                known = CuckooFilter.load(r["filter"])
            else:
                keys[r["sha"]] = (r["id"], r["points"], r["row"], r["size"])
        known = known or grown(keys, 2 * len(keys) + 64)
        for r in new.to_pylist():
            sha = r["sha"]
            hit = keys.get(sha) if sha in known else None  # a hit is verified, a miss is certain
            own = (r["id"], r["points"], r["row"], r["size"])
            if delete:
                if hit and hit[3] > r["size"]:
                    keys[sha] = (*hit[:3], hit[3] - r["size"])
                elif hit:
                    del keys[sha]
                    known.delete(sha)
            elif hit:
                keys[sha] = (*min(hit, own, key=rank)[:3], hit[3] + r["size"])
            else:
                keys[sha] = own
                try:
                    known.insert(sha)
                except Full:
                    known = grown(keys, 2 * known.size * CuckooFilter.SLOTS)
        n = len(keys)
        cols = list(zip(*keys.values())) or [(), (), (), ()]
        own = {"bucket": [bucket] * (n + 1), "sha": [*keys, None], "id": [*cols[0], None],
               "points": [*cols[1], None], "row": [*cols[2], None], "size": [*cols[3], None],
               "filter": [None] * n + [known.dump()]}
        kinds = _arrow(schema, new if new.num_columns else stored)
        return pa.table([pa.array(own[f.name], f.type) for f in kinds], names=schema.names)

    return (
        index.groupBy("bucket").cogroup(batch.select("bucket", "sha", "id", "points", "row", "size")
                                        .groupBy("bucket")).applyInArrow(update, schema)
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row, dropped ones too.

    Of equal texts the longest original stays, then the least id (a null id comes last), then
    the first row; a row that is repeated as a whole is kept once. Null texts equal empty ones.
    """
    rows = digests(docs, id_col, text_col)
    buckets = max(2 * docs.sparkSession.sparkContext.defaultParallelism,
                  rows.count() // BUCKET_DIGESTS + 1)
    index = changed(empty_index(rows), combined(rows, buckets))
    keys = stage(index).where("sha is not null").select(
        "sha", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"),
        F.col("size").alias("group_size"))
    return rows.join(keys, "sha").select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    What goes, and rows that are repeated as a whole, are staged first, as id and digest. Rows whose
    id is none of theirs stay where they are; only the text of others can be moved.
    """
    judged = stage(exact_dedup(docs, id_col, text_col).select(
        F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_sha"), "kept"))
    pairs = judged.groupBy("_id", "_sha").agg(F.max("kept").alias("any"), F.count("*").alias("rows"))
    named = stage(pairs.where("not any or rows > 1"))
    gone, twins = (named.where(c).select("_id", "_sha") for c in ("not any", "any"))
    may = may_be_in(named, "_id")(F.col(id_col))
    marked = docs.where(may).select(
        F.struct("*").alias("doc"), F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("sha"))
    same = lambda other: F.col("id").eqNullSafe(other["_id"]) & (F.col("sha") == other["_sha"])
    stays = marked.join(gone, same(gone), "left_anti")
    if not twins.isEmpty():
        stays = stays.join(twins, same(twins), "left_anti").union(
            stays.join(twins, same(twins), "left_semi").dropDuplicates(["id", "sha"]))
    return docs.where(~may).union(stays.select("doc.*"))
