"""Quality scores: ridge regression on random Fourier features of document statistics.

The features approximate a Gaussian kernel over standardised statistics of the text. Training
rows are dealt over a fixed number of tasks, each sums its normal equations, and the sums are
solved. Isotonic regression (pool adjacent violators) over counted score bins, on rows the ridge
has not seen, turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.texts import fold, slices, words
from newsloom.session import stage

FEATURES = 192      # random Fourier features
WIDTH = 3.0         # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3        # times the number of rows
SUMS = 32           # partial normal equations that reach the driver: 0.3 MB each
BINS = 512          # score bins of the calibration
SEED = 8
THRESHOLD = 0.7

# Classes of bytes: upper, lower, digit, space, line end, other ASCII, UTF-8 lead, UTF-8 tail.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10], _CLASS[0xC0:], _CLASS[0x80:0xC0] = 3, 4, 6, 7
STATISTICS = ("log words", "log letters a word", "upper case", "digits", "punctuation", "beyond ASCII",
              "line ends a word", "word as the one before", "distinct words", "commonest word",
              "words of punctuation", "words ending in punctuation")


def statistics_of(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; null and empty texts have zeros."""
    texts = pc.fill_null(texts, "")
    ids, begins, distinct = words(texts)
    data = np.frombuffer(pa.concat_arrays([texts]).buffers()[2] or b"", np.uint8)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    kinds = _CLASS[data[:int(ends[-1])]] if len(ends) else np.zeros(0, np.uint8)
    sums = np.zeros((len(texts), 8))
    for k in range(8):
        total = np.concatenate([[0], np.cumsum(kinds == k)])
        sums[:, k] = total[ends] - total[ends - sizes]
    chars = np.maximum(sums[:, :7].sum(1), 1)
    letters = np.maximum(sums[:, 0] + sums[:, 1], 1)
    own = [w.encode() for w in distinct.to_pylist()]
    last = _CLASS[np.array([w[-1] for w in own], np.uint8)] == 5 if own else np.zeros(0, bool)
    bare = np.array([all(_CLASS[b] == 5 for b in w) if e else False for w, e in zip(own, last)], bool)
    same = np.concatenate([[False], ids[1:] == ids[:-1]]) if len(ids) else np.zeros(0, bool)
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, (s, e) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
        n = e - s
        if not n:
            continue
        counts = np.unique(ids[s:e], return_counts=True)[1]
        part = ids[s:e]
        out[i] = (np.log1p(n), 0, 0, 0, 0, 0, sums[i, 4] / n, same[s + 1:e].sum() / n,
                  len(counts) / n ** 0.9, counts.max() / n, bare[part].sum() / n, last[part].sum() / n)
        out[i, 1] = np.log1p((letters[i] + sums[i, 6]) / n)
        out[i, 2:6] = sums[i, 0] / letters[i], sums[i, 2] / chars[i], sums[i, 5] / chars[i], sums[i, 6] / chars[i]
    return out


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(text: pa.Array) -> pa.Array:
    rows = [statistics_of(part.column(0)) for part in slices(pa.record_batch([text], names=["t"]), 0)]
    flat = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * len(STATISTICS)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.ravel()))


@dataclass
class Model:
    """Centre and scale of the statistics, weights, and the calibration's points."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    points: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(SEED)
        w = draw.normal(0, 1 / WIDTH, (x.shape[1], FEATURES))
        b = draw.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ w + b) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.weights is None else self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.points, self.values), 0, 1)

    def column(self, stats: Column) -> Column:
        """The calibrated score of a column of statistics."""
        model = self

        @F.arrow_udf("double")
        def scored(rows: pa.Array) -> pa.Array:
            return pa.array(model.score(rows.flatten().to_numpy().reshape(len(rows), -1)))

        return scored(stats)


def pooled(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Isotonic regression: the closest rising values."""
    blocks: list[list[float]] = []
    for w, m in zip(weight.tolist(), mean.tolist()):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, k2 = blocks.pop()
            w1, m1, k1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), k1 + k2])
    return np.repeat([b[1] for b in blocks], [int(b[2]) for b in blocks])


def fit(rows: DataFrame) -> Model:
    """From rows (stats array<double>, label 0/1, spare boolean): the ridge learns from rows
    that are not spare, the calibration from spare ones, or from all where a side is empty.

    Without labelled rows every score is 0.5.
    """
    rows = stage(rows.where("label is not null"))
    k = len(STATISTICS)
    spare = {s: n for s, n in rows.groupBy("spare").count().collect()}
    if not spare:
        return Model(np.zeros(k), np.ones(k), None, np.array([0.0]), np.array([0.5]))
    learn = rows.where("not spare") if spare.get(False) else rows
    check = rows.where("spare") if spare.get(True) else rows
    moments = learn.select([F.col("stats")[i].alias(f"s{i}") for i in range(k)]).agg(
        *(F.avg(f"s{i}") for i in range(k)), *(F.stddev_pop(f"s{i}") for i in range(k))).first()
    centre, scale = np.array(moments[:k], float), np.array(moments[k:], float)
    model = Model(centre, np.where(scale > 1e-9, scale, 1.0), None, np.array([0.0]), np.array([0.5]))

    def summed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, side, n = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), 0
        for t in parts:
            if len(t):
                z = model.features(np.stack(t["stats"].to_numpy()))
                gram += z.T @ z
                side += z.T @ t["label"].to_numpy(float)
                n += len(t)
        yield pd.DataFrame({"gram": [gram.tobytes()], "side": [side.tobytes()], "n": [n]})

    gram, side, n = 0, 0, 0
    parts = learn.select("stats", "label").repartition(SUMS)
    for g, s, m in parts.mapInPandas(summed, "gram binary, side binary, n long").collect():
        gram = gram + np.frombuffer(g).reshape(FEATURES + 1, -1)
        side, n = side + np.frombuffer(s), n + m
    penalty = np.eye(FEATURES + 1) * RIDGE * n / FEATURES
    penalty[-1, -1] = 0
    model.weights = np.linalg.lstsq(gram + penalty, side, rcond=None)[0]

    @F.arrow_udf("int")
    def binned(stats: pa.Array) -> pa.Array:
        raw = model.raw(stats.flatten().to_numpy().reshape(len(stats), -1))
        return pa.array(np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32))

    bins = check.groupBy(binned("stats").alias("bin")).agg(
        F.count("*").alias("n"), F.avg("label").alias("mean")).toPandas().sort_values("bin")
    model.points = (bins["bin"].to_numpy(float) + 0.5) / BINS * 2 - 0.5
    model.values = pooled(bins["n"].to_numpy(float), bins["mean"].to_numpy(float))
    return model


def trained(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
            folds: int = 4, held_out: int = 2) -> Model:
    """A model from (id, stats) and (id, label), without the held-out fold; the fold after it
    is kept for the calibration."""
    part = fold(F.col(id_col), folds)
    rows = stats.where(part != held_out).join(
        labels.where(F.col(label_col).isNotNull()).select(id_col, F.col(label_col).alias("label")), id_col)
    return fit(rows.select("stats", "label", (part == (held_out + 1) % folds).alias("spare")))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row. Texts are read once, into staged statistics."""
    stats = stage(docs.select(id_col, statistics(text_col).alias("stats")))
    model = trained(stats, labels, id_col)
    return stats.select(
        id_col, (fold(F.col(id_col), 4) == 2).alias("held_out"),
        model.column(F.col("stats")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents that the classifier accepts, with all their columns.

    Statistics are what moves to the labels; texts stay where they are read, and are read twice."""
    stats = stage(docs.select(id_col, statistics(text_col).alias("stats")))
    model = trained(stats, labels, id_col)
    return docs.where(model.column(statistics(F.col(text_col))) >= THRESHOLD)
