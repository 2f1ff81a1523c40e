"""Severity of toxic text by cumulative-link ordinal regression on sparse text features.

One weight for each hashed feature is shared by all thresholds: P(grade > k) =
sigmoid(w.x - cut_k) with rising cuts. A feature's value is its damped count times its log odds. Features are words and their beginnings, so that
inflected forms share evidence. Training rows are staged as sparse rows; each step of
the descent sums gradients in the tasks. The result is the expected grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from newsloom.llm.texts import fold, slices, words
from newsloom.session import stage

BITS = 18                # hashed features
TRAIN_ROWS = 24_000      # at most about so many labelled rows are learned from, chosen by hash
SUMS = 6                 # tasks that sum gradients; each sends the driver one value a feature
STEPS = 40
SHRINK = 1e-4
HEADS = (4, 5, 6)        # lengths of word beginnings
MIN_ROWS = 5             # training rows that a feature occurs in
PRIOR = 3.0              # rows' worth of the overall rate in each feature's log odds
LEAST_ODDS = 1.0         # features of smaller absolute log odds are left out
EVIDENCE = 3.0           # log odds from which a feature counts as evidence
GRADES = (1, 3, 8)       # pieces of evidence from which a toxic row has grade 1, 2, 3


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the sorted numbers of its features and how often each occurs."""
    ids, begins, distinct = words(pc.utf8_lower(pc.fill_null(texts, "")))
    own = [w.strip(".,!?;:\"'()") for w in distinct.to_pylist()]
    mask = (1 << BITS) - 1
    forms = np.empty((len(own), 1 + len(HEADS)), np.int64)
    whole = np.array(own, object)
    if len(own):
        forms[:, 0] = (pd.util.hash_array(whole, categorize=False) & np.uint64(mask)).astype(np.int64)
        for k, n in enumerate(HEADS, 1):
            head = np.array([f"{w[:n]}*" if len(w) > n else "" for w in own], object)
            hashed = (pd.util.hash_array(head, categorize=True) & np.uint64(mask)).astype(np.int64)
            forms[:, k] = np.where(head == "", -1, hashed)
    for s, e in zip(begins[:-1].tolist(), begins[1:].tolist()):
        found = forms[ids[s:e]].ravel()
        yield np.unique(found[found >= 0], return_counts=True)


def value(count: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Of a feature in a text: damped count times log odds."""
    return np.sqrt(np.minimum(count, 3)) * odds


@dataclass
class Model:
    """Log odds and weights of the features, and the rising cuts between grades."""

    odds: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def exceed(self, total: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - total[:, None], -40, 40)))

    def expected(self, total: np.ndarray) -> np.ndarray:
        return self.exceed(total).sum(1)

    def total(self, texts: pa.Array) -> np.ndarray:
        one = self.odds * self.weights
        return np.array([value(c, one[i]).sum() for i, c in features(texts)])


def sparse(rows: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """Staged (label int, at array<int>, count array<int>)."""
    kind = T.StructType([
        T.StructField("label", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("count", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got = list(features(part.column(1)))
                ends = pa.array(np.cumsum([0] + [len(i) for i, _ in got]).astype(np.int32))
                flat = [np.concatenate([g[k] for g in got]).astype(np.int32) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.ListArray.from_arrays(ends, pa.array(f)) for f in flat)],
                    names=kind.names)

    return stage(rows.select(F.col(label_col).cast("int"), text_col).mapInArrow(run, kind).repartition(SUMS))


def log_odds(rows: DataFrame) -> np.ndarray:
    """Of each feature's occurring in toxic rows; 0 for rare features and weak ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS))
        for b in batches:
            at, owner = b.column(1).flatten().to_numpy(), pc.list_parent_indices(b.column(1)).to_numpy()
            bad = b.column(0).to_numpy(zero_copy_only=False)[owner] > 0
            for k in (0, 1):
                seen[k] += np.bincount(at[bad == k], minlength=1 << BITS)
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])],
                                         names=["f", "good", "bad"])

    by = rows.mapInArrow(count, "f long, good double, bad double").groupBy("f").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")).where(
        F.col("good") + F.col("bad") >= MIN_ROWS).toPandas()
    n = dict(rows.groupBy((F.col("label") > 0).cast("int")).count().collect())
    good, bad = max(n.get(0, 0), 1), max(n.get(1, 0), 1)
    odds = (np.log((by["bad"] + PRIOR * bad / (good + bad)) / bad)
            - np.log((by["good"] + PRIOR * good / (good + bad)) / good)).to_numpy()
    out = np.zeros(1 << BITS)
    out[by["f"].to_numpy(int)] = np.where(np.abs(odds) > LEAST_ODDS, odds, 0)
    return out


def weighed(rows: DataFrame, odds: np.ndarray) -> DataFrame:
    """Staged (grade int, at array<int>, x array<double>) with the features that have log odds.

    The labels say only toxic (1) or not (0). The grade of a toxic row is the last one whose
    count in GRADES its evidence reaches, and 1 at least; evidence is a word or beginning of a
    word of log odds EVIDENCE or more, and a word counts with its beginning. Features are
    numbered anew, without those that have no log odds.
    """
    used = np.flatnonzero(odds)
    kind = T.StructType([
        T.StructField("grade", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, count = b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy()
            owner = pc.list_parent_indices(b.column(1)).to_numpy()
            proof = np.bincount(owner, count * (odds[at] >= EVIDENCE), b.num_rows) / 2
            label = b.column(0).to_numpy(zero_copy_only=False)
            grade = np.where(label > 0, np.maximum(1, (proof[:, None] >= np.array(GRADES)).sum(1)), 0)
            keep = odds[at] != 0
            place = (np.searchsorted(used, at[keep])).astype(np.int32)
            ends = pa.array(np.searchsorted(owner[keep], np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grade.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(place)),
                 pa.ListArray.from_arrays(ends, pa.array(value(count[keep], odds[at[keep]])))],
                names=kind.names)

    return stage(rows.mapInArrow(run, kind))


def fit(rows: DataFrame, odds: np.ndarray, grades: int) -> Model:
    """Gradient descent with momentum on the mean loss of the cumulative links.

    Steps carry only the features that have log odds.
    """
    used = np.flatnonzero(odds)
    small = Model(odds[used], np.zeros(len(used)), np.linspace(2.0, 3.0, grades - 1))
    n, size = rows.agg(F.count("*"), F.avg(F.expr("aggregate(x, 0D, (s, v) -> s + v * v)"))).first()
    rate = 1 / ((grades - 1) * (0.25 * (size or 0) + 0.25))

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, cut = np.zeros(len(used)), np.zeros(grades - 1)
        for b in batches:
            at, x = b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy()
            owner = pc.list_parent_indices(b.column(1)).to_numpy()
            p = small.exceed(np.bincount(owner, small.weights[at] * x, b.num_rows))
            grade = b.column(0).to_numpy(zero_copy_only=False)
            miss = p - (grade[:, None] > np.arange(grades - 1))  # the loss's slope by w.x, minus that by the cut
            slope += np.bincount(at, miss.sum(1)[owner] * x, len(used))
            cut -= miss.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([slope.tobytes()]), pa.array([cut.tobytes()])], names=["slope", "cut"])

    move, turn = np.zeros(len(used)), np.zeros(grades - 1)
    for _ in range(STEPS if n else 0):
        slope, cut = SHRINK * small.weights, np.zeros(grades - 1)
        for s, c in rows.mapInArrow(slopes, "slope binary, cut binary").collect():
            slope += np.frombuffer(s) / n
            cut += np.frombuffer(c) / n
        move, turn = 0.9 * move - rate * slope, 0.9 * turn - rate * cut
        small = Model(small.odds, small.weights + move, np.sort(small.cuts + turn))
    weights = np.zeros(len(odds), np.float32)
    weights[used] = small.weights
    return Model(odds.astype(np.float32), weights, small.cuts)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
             id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, held_out, severity, grade, predicted, kept) of every row.

    ``severity`` is the expected grade from 0 to 3, ``grade`` the nearest one, ``predicted``
    1 from a severity of 0.5 on, ``kept`` is its opposite. Learns from labelled rows outside the
    held-out fold, at most about TRAIN_ROWS of them. Null and empty texts have no feature and
    the severity of the cuts alone; without labelled rows every severity is 0.
    """
    part = fold(F.col(id_col), folds)
    known = labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col), folds) != held_out)).select(
        id_col, F.col(label_col).alias("label"))
    share = min(1.0, TRAIN_ROWS / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = sparse(docs.select(id_col, text_col).join(chosen, id_col), text_col, "label")
    odds, grades = log_odds(rows), len(GRADES) + 1
    model = fit(weighed(rows, odds), odds, grades)
    if rows.isEmpty():
        model.cuts[:] = 40.0
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def severity(text: pa.Array) -> pa.Array:
        own = sent.value
        got = [own.expected(own.total(s.column(0))) for s in slices(pa.record_batch([text], names=["t"]), 0)]
        return pa.array(np.concatenate(got) if got else np.zeros(0))

    out = docs.select(id_col, (part == held_out).alias("held_out"), severity(text_col).alias("severity"))
    bad = F.col("severity") >= 0.5
    return out.select("*", F.round("severity").cast("int").alias("grade"), bad.cast("int").alias("predicted"),
                      (~bad).alias("kept"))
