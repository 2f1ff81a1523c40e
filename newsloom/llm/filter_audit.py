"""What filters do to each other in every order, by wide packed counters.

A document's outcome under any order of the filters follows from its mask, the set of filters that
it fails, and its labels. For each mask one big integer has a field for every order, step and
outcome, 1 where it happens to the document. Sums of these integers are the counts of all orders
at once: a field is wider than any count, so that no field runs into the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.texts import slices, words

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
MARKS = b"#$%&*|"
SAME = FILTERS.index("E")
FIELD_BITS = 64       # of a count, which is less than 2**63 in a table of that many rows at most
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEPS = [(order, step) for order in map("".join, permutations(FILTERS)) for step in range(len(FILTERS))]
_CAPITAL, _MARK = np.zeros(256, np.int64), np.zeros(256, np.int64)
_CAPITAL[ord("A"):ord("Z") + 1] = 1
_MARK[list(MARKS)] = 1


def _total(hits: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(hits)])
    return run[ends[1:]] - run[ends[:-1]]


def own_masks(texts: pa.Array) -> np.ndarray:
    """Bit k is set where a text fails filter k, of those that need only the text itself."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    ids, begins, _ = words(texts)
    n = np.diff(begins)
    owner = np.repeat(np.arange(len(texts)), n)
    pairs = np.unique(owner * (int(ids.max()) + 1 if len(ids) else 1) + ids) // (int(ids.max()) + 1 if len(ids) else 1)
    distinct = np.bincount(pairs, minlength=len(texts))
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:int(ends[-1])]
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    fails = (n < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * n,
             100 * _total(_CAPITAL[data], ends) > CAPITAL_PERCENT * chars, _total(_MARK[data], ends) > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def facts(docs: DataFrame, id_col: str, text_col: str, part: Column) -> DataFrame:
    """(id, part, text_sha256, mask) of every row; whole texts stay in the task that reads them."""
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_part", T.StringType()),
        T.StructField("_sha", T.BinaryType()), T.StructField("_mask", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2):
                texts = rows.column(2)
                shas = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in texts.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(shas, pa.binary()),
                     pa.array(own_masks(texts), pa.int32())], names=schema.names)

    return docs.select(F.col(id_col).alias("_id"), part.alias("_part"), F.col(text_col).alias("_text")).mapInArrow(
        run, schema)


def mask_counts(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, good, toxic, n) of ``facts``: how many rows have which mask and labels.

    Rows of the same text differ only in part, labels and id, so they are counted before the text's
    least id is looked for: of each such group only its own least id is wanted and how often it
    occurs. A text that very many rows share thus reaches a task as a few rows.
    """
    marked = labels.groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    kind = ["_part", "_mask", "good", "toxic"]
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    each = (rows.join(marked, "_id", "left").select("_id", "_sha", "_part", "_mask", *flags)
            .groupBy("_id", "_sha", *kind).agg(F.count(F.lit(1)).alias("n")))
    groups = each.groupBy("_sha", *kind).agg(
        F.sum("n").alias("n"), F.min("_id").alias("_least"), F.min_by("n", "_id").alias("_at_least"),
        F.sum(F.when(F.col("_id").isNull(), F.col("n")).otherwise(0)).alias("_without"))
    first = groups.groupBy("_sha").agg(F.min("_least").alias("_first"))
    fresh = F.col("_without") + F.when(F.col("_least") == F.col("_first"), F.col("_at_least")).otherwise(0)
    outcome = F.explode(F.array(
        F.struct(F.col("_mask").alias("mask"), fresh.alias("n")),
        F.struct(F.col("_mask").bitwiseOR(F.lit(1 << SAME)).alias("mask"), (F.col("n") - fresh).alias("n"))))
    return (
        groups.join(first, "_sha").select(F.col("_part").alias("part"), "good", "toxic", outcome.alias("o"))
        .where("o.n > 0").groupBy("part", "o.mask", "good", "toxic").agg(F.sum("o.n").alias("n")))


@cache
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The integer of a document with this mask and these labels: a field per step and outcome."""
    fields = bytearray(len(STEPS) * len(OUTCOMES) * FIELD_BITS // 8)
    at = 0
    for order, step in STEPS:
        fails = [mask >> FILTERS.index(f) & 1 for f in order]
        before, here = any(fails[:step]), fails[step]
        removed = here and not before
        for happens in (not before and not here, removed, here and before, here and sum(fails) == 1,
                        removed and good, removed and toxic):
            fields[at] = bool(happens)
            at += FIELD_BITS // 8
    return int.from_bytes(fields, "little")


def unpacked(total: int) -> np.ndarray:
    """The counts of a sum of ``packed`` integers, a row per step and a column per outcome."""
    raw = total.to_bytes(len(STEPS) * len(OUTCOMES) * FIELD_BITS // 8, "little")
    return np.frombuffer(raw, "<i8").reshape(len(STEPS), len(OUTCOMES))


def outcomes(counts: DataFrame) -> DataFrame:
    """The outcome of every order and step by part, of ``mask_counts``.

    A part has a row for each mask and pair of labels, 128 at most, so a group is small at any size.
    """
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
         T.StructField("step", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in (*OUTCOMES, "shapley")])

    def run(rows: pa.Table) -> pa.Table:
        total = sum(n * packed(mask, good, toxic) for mask, good, toxic, n in zip(
            *(rows.column(c).to_pylist() for c in ("mask", "good", "toxic", "n"))))
        made = unpacked(total)
        letters = np.array([order[step] for order, step in STEPS])
        shapley = np.zeros(len(STEPS), np.int64)
        for letter in FILTERS:
            shapley[letters == letter] = made[letters == letter, OUTCOMES.index("removed")].sum()
        return pa.table([
            pa.array([rows.column("part")[0].as_py()] * len(STEPS), pa.string()),
            pa.array([order for order, _ in STEPS], pa.string()),
            pa.array([step + 1 for _, step in STEPS], pa.int32()),
            *(pa.array(made[:, k], pa.int64()) for k in range(len(OUTCOMES))), pa.array(shapley, pa.int64()),
        ], names=schema.names)

    return counts.groupBy("part").applyInArrow(run, schema)


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """For every part, order of the filters and step: documents kept and removed, and why.

    The filters: A fewer than MIN_WORDS words; B fewer than DISTINCT_PERCENT distinct words of 100;
    C more than CAPITAL_PERCENT capitals A-Z of 100 code points; D any of MARKS; E the text of a row
    with a smaller id. A null text is empty, a null part the empty string. A row without an id equals
    no smaller one and no other row equals it. Rows that share an id and a text are not copies of each
    other. ``labels(quality, toxic)`` by id: any row with 1 marks its document. Extra columns of either
    input are not looked at. Without documents there is no part and no row.
    """
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    return outcomes(mask_counts(facts(docs, id_col, text_col, part), labels, id_col))
