"""What several operators need of texts: tables, bounded slices of batches, words, shingles."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 2 << 20  # text worked on at once in a task; one longer text is a slice of its own
SPACE = "[\\x20\\x09-\\x0D]"
STRETCH = 1 << 20        # characters of a text worked on at once by a Python pattern
KNOWN_BITS = 1 << 23     # of a filter of keys that is sent to every task: 1 MB
WIDTH = 5
# Odd multipliers of the five places of a shingle, and those of the mixing step.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def may_be_in(keys: DataFrame, *names: str) -> Callable[..., Column]:
    """Of columns like the named ones of ``keys``, whether they may be among them; never false for one that is.

    A Bloom filter with two bits a key, of a fixed size however many keys there are: it tells rows apart
    before a join moves them, and never instead of one.
    """
    spark = keys.sparkSession
    h = F.xxhash64(*names)
    places = F.array(F.pmod(h, F.lit(KNOWN_BITS)), F.pmod(F.shiftright(h, 32), F.lit(KNOWN_BITS)))
    got = keys.select(F.explode(places).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    known = np.zeros(KNOWN_BITS // 64, np.int64)
    known[got["word"].to_numpy()] = got["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(known)

    @F.pandas_udf("boolean")
    def known_hash(hashes: pd.Series) -> pd.Series:
        h, words = hashes.to_numpy(np.int64), sent.value
        out = np.ones(len(h), bool)
        for at in (h % KNOWN_BITS, (h >> 32) % KNOWN_BITS):
            out &= words[at >> 6] >> (at & 63) & 1 == 1
        return pd.Series(out)

    return lambda *columns: known_hash(F.xxhash64(*columns))


def slices(batch: pa.RecordBatch, text: int = 1) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most SLICE_BYTES of text each, or one longer row."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            pa.default_memory_pool().release_unused()  # workers live on; their pools should not
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def give_back() -> None:
    """Returns to the system what this worker's allocators hold and do not use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def giving_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The same function for mapInArrow, after which its worker, which lives on, keeps no memory of the task."""
    @wraps(run)
    def done(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return done


def stretches(text: str, gap: re.Pattern) -> Iterator[str]:
    """The text in parts of about STRETCH characters, cut where a match of ``gap`` begins; a
    part goes on as long as there is no such place."""
    at = 0
    while len(text) - at > STRETCH:
        found = gap.search(text, at + STRETCH)
        if found is None:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:] if at else text


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word number of every word, where each text's words begin, and the distinct words.

    Words are runs of other characters than ASCII white space; a null text has none.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, owner = parts.flatten(), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(full), owner.filter(full)
    coded = flat.dictionary_encode()
    begins = np.searchsorted(owner.to_numpy(), np.arange(len(texts) + 1))
    return coded.indices.to_numpy(zero_copy_only=False), begins, coded.dictionary


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles of WIDTH words, A-Z
    lower-cased; of fewer words the whole sequence is the one shingle; without words, none."""
    ids, begins, distinct = words(pc.ascii_lower(pc.fill_null(texts, "")))
    own = np.asarray(distinct.to_numpy(zero_copy_only=False), dtype=object)
    w = pd.util.hash_array(own, categorize=False)[ids] if len(own) else np.zeros(0, np.uint64)
    n = len(w)
    full = np.zeros(0, np.uint64)
    if n >= WIDTH:
        full = w[:n - WIDTH + 1] * PLACES[0]
        for k in range(1, WIDTH):
            full = full + w[k:n - WIDTH + 1 + k] * PLACES[k]
        full = mix(full)
    for s, e in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if e - s >= WIDTH:
            yield np.unique(full[s:e - WIDTH + 1])
        elif e > s:
            part = (w[s:e] * PLACES[:e - s]).sum(dtype=np.uint64) + np.uint64(e - s)
            yield mix(np.array([part], dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def binaries(raw: np.ndarray, width: int) -> pa.Array:
    """An Arrow binary column from consecutive bytes of equal width."""
    n = raw.nbytes // width
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(raw.tobytes())])
