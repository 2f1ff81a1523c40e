"""Mixing sources to target weights: raking of token counts, then sampling by its probabilities.

Tokens are counted by (source, language, topic). Iterative proportional fitting rescales the
cells until every source, language and topic has its target share. A document's probability is
its cell's rate, fitted over original tokens, times one factor: without a chosen fraction the
largest at which no cell's probability exceeds 1, so that the sample has the raked shares. A
chosen fraction above that cuts rates at 1, and targets are then missed by as much as
``achieved`` reports.

Cells are a table and every sweep is a few grouped sums and joins on it, so neither the number
of sources nor that of topics meets a limit. The topic is the commonest long word's hash bucket,
unless a topic column is named.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.session import stage

TOPICS = 16
TOPIC_WORD = 5      # letters of a word that can name a topic
STALL = 0.99        # sweeps also end when the greatest deviation is twice not less than this part of the last
CLOSE = 1e-3        # greatest deviation from a target share at which the sweeps end
TEMPER = 0.5        # default targets: observed shares to this power
FRACTION = 0.75     # of all tokens, expected to be kept; None for as many as the targets allow
SEED = 1
KEYS = ("source", "lang", "topic")


@F.arrow_udf(T.StructType([T.StructField("tokens", T.LongType()), T.StructField("word", T.StringType())]))
def _counted(text: pa.Array) -> pa.Array:
    tokens, word = [], []
    for t in text:
        found = Counter((t.as_py() or "").lower().split())
        tokens.append(sum(found.values()))
        long = [(-n, w) for w, n in found.items() if len(w) >= TOPIC_WORD]
        word.append(min(long)[1] if long else "")
    return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(word, pa.string())],
                                      names=["tokens", "word"])


def _key(value: Column) -> Column:
    """A text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """(doc, mix): a row as a struct, and a struct of the three keys, the tokens and a number from 0
    to 1 that the id and the text fix. Null texts have no token; null sources and languages are
    values of their own."""
    doc = F.col("doc")
    got = docs.select(F.struct("*").alias("doc"), _counted(text_col).alias("got"))
    topic = doc[topic_col] if topic_col else F.pmod(F.xxhash64("got.word"), F.lit(TOPICS))
    draw = F.pmod(F.xxhash64(F.lit(SEED), doc[id_col].cast("string"), doc[text_col]), F.lit(1 << 52)) / float(1 << 52)
    return got.select("doc", F.struct(
        _key(doc[source_col]).alias("source"), _key(doc[lang_col]).alias("lang"), _key(topic).alias("topic"),
        F.col("got.tokens").alias("tokens"), draw.alias("draw")).alias("mix"))


def tempered(cells: DataFrame, key: str, power: float) -> DataFrame:
    """Target shares (key, share): observed token shares to a power, summing to one."""
    sums = stage(cells.groupBy(key).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("p")))
    total = sums.agg(F.sum("p")).first()[0] or 1.0
    return sums.select(key, (F.col("p") / F.lit(float(total))).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int | None = None, close: float = CLOSE) -> DataFrame:
    """Adds ``weight``: the share of each cell (keys, tokens) that fits the targets.

    A target is (key, share) for every value of that key; values without one have share 0.
    Each sweep is staged; sweeps end when all shares are within ``close``, when they get no
    closer, since targets that contradict empty cells cannot all be met, or after ``sweeps``.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    now = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for key, target in targets.items():  # a cell carries its own targets, so that sweeps need no join with them
        wanted = target.select(key, F.col("share").alias(f"{key}_wanted"))
        now = now.join(wanted, key, "left").fillna(0.0, [f"{key}_wanted"])
    now = stage(now)

    def sums(key: str) -> DataFrame:
        return now.groupBy(key).agg(F.sum("weight").alias("have"), F.first(f"{key}_wanted").alias("share"))

    last, stalled = float("inf"), 0
    for _ in count() if sweeps is None else range(sweeps):
        for key in targets:
            scale = F.when(F.col("have") > 0, F.col("share") / F.col("have")).otherwise(0.0)
            now = now.join(sums(key).select(key, scale.alias("scale")), key).withColumn(
                "weight", F.col("weight") * F.col("scale")).drop("scale")
        now = stage(now)
        gaps = [sums(key).select(F.abs(F.col("have") - F.col("share")).alias("gap"))
                for key in list(targets)[:-1]]  # the last one was just met
        gap = (reduce(DataFrame.union, gaps).agg(F.max("gap")).first()[0] or 0.0) if gaps else 0.0
        stalled = stalled + 1 if gap >= STALL * last else 0
        if gap <= close or stalled > 1:
            break
        last = gap
    return now.drop(*(f"{key}_wanted" for key in targets))


def probabilities(cells: DataFrame, fraction: float | None = FRACTION) -> DataFrame:
    """Adds ``probability`` to raked cells, so that the expected tokens are that fraction of all.

    Without a fraction, the most tokens at which every cell keeps its raked share. With one, rates
    over 1 are cut to 1, and the factor of the others is raised until the sum is right or every
    cell that is wanted is kept whole.
    """
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = stage(cells.withColumn("rate", rate))
    if fraction is None:
        most = cells.agg(F.max("rate")).first()[0] or 0.0
        factor = 1 / most if most else 0.0
        return cells.withColumn("probability", F.least(F.col("rate") * F.lit(factor), F.lit(1.0)))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    factor, whole = 0.0, -1.0
    while True:
        cut = F.col("rate") * factor >= 1
        full, free = cells.agg(F.sum(F.when(cut, F.col("tokens")).otherwise(0)),
                               F.sum(F.when(cut, 0.0).otherwise(F.col("rate") * F.col("tokens")))).first()
        full, free = full or 0, free or 0.0
        if full <= whole or free <= 0:
            break
        whole, factor = full, max(fraction * total - full, 0) / free
    return cells.withColumn("probability", F.least(F.col("rate") * F.lit(factor), F.lit(1.0)))


def achieved(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(key, value, target, share, gap): of the tokens expected to be kept, the share of every
    value of every key, and how far it is from its target."""
    kept = F.col("tokens") * F.col("probability")
    total = cells.agg(F.sum(kept)).first()[0] or 1.0

    def of(key: str, target: DataFrame) -> DataFrame:
        have = cells.groupBy(key).agg((F.sum(kept) / F.lit(float(total))).alias("have")).join(
            target.withColumnRenamed("share", "target"), key, "full")
        share, wanted = F.coalesce("have", F.lit(0.0)), F.coalesce("target", F.lit(0.0))
        return have.select(F.lit(key).alias("key"), F.col(key).alias("value"), wanted.alias("target"),
                           share.alias("share"), F.abs(share - wanted).alias("gap"))

    return reduce(DataFrame.union, [of(k, t) for k, t in targets.items()])


def calibrated(rows: DataFrame, targets: dict[str, DataFrame] | None = None, fraction: float | None = FRACTION,
               temper: float = TEMPER) -> tuple[DataFrame, DataFrame]:
    """Cells with their probabilities, from rows that ``keyed`` has marked, and what they achieve."""
    cells = stage(rows.select("_mix.source", "_mix.lang", "_mix.topic", "_mix.tokens")
                  .groupBy(*KEYS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    targets = targets or {k: tempered(cells, k, temper) for k in KEYS}
    cells = stage(probabilities(rake(cells, targets), fraction))
    return cells, achieved(cells, targets)


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, fraction: float | None = FRACTION,
          temper: float = TEMPER, **columns) -> DataFrame:
    """(id, source, lang, topic, n_tokens, weight, probability, kept) of every row, and for its
    source, language and topic the target share, that of the tokens expected to be kept, and the
    gap between them, as source_share, lang_share and topic_share.

    The text is read once; what is left of a row is staged. Documents without a token have the
    rate of an empty cell, or that of their cell.
    """
    id_col = columns.get("id_col", "doc_id")
    rows = stage(keyed(docs, **columns).select(F.col("doc")[id_col].alias("id"), F.col("mix").alias("_mix")))
    cells, reached = calibrated(rows, targets, fraction, temper)
    reached = stage(reached)
    cells = cells.select(*KEYS, "weight", "probability")
    for k in KEYS:
        own = F.struct("target", F.col("share").alias("achieved"), "gap").alias(f"{k}_share")
        cells = cells.join(reached.where(F.col("key") == k).select(F.col("value").alias(k), own), k, "left")
    flat = rows.select("id", "_mix.*")
    return flat.join(cells, list(KEYS)).select(
        F.col("id").alias(id_col), *(F.expr(f"if({k} = 'null', null, substring({k}, 2))").alias(k) for k in KEYS),
        F.col("tokens").alias("n_tokens"), "weight", "probability", (F.col("draw") < F.col("probability")).alias("kept"),
        *(f"{k}_share" for k in KEYS))


def keep_sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, fraction: float | None = FRACTION,
                temper: float = TEMPER, **columns) -> DataFrame:
    """The sampled rows with all their columns. The text is read twice and not moved where the
    cells are few enough for Spark to broadcast them."""
    rows = keyed(docs, **columns)
    cells, _ = calibrated(stage(rows.select(F.col("mix").alias("_mix"))), targets, fraction, temper)
    same = [F.col("mix")[k] == cells[k] for k in KEYS]
    return rows.join(cells, same).where(F.col("mix")["draw"] < cells["probability"]).select("doc.*")
