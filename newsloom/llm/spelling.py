"""Spelling variants: words at one edit from each other, found with bidirectional FM-indexes.

Two words at one edit have the first or the second half of each of them in common exactly. The
vocabulary is cut into blocks of neighbours in order, once by beginnings and once by ends. A word
looks for those with its first half in the blocks where words with that beginning are, and for those
with its second half in the blocks of that end. No block holds more than BLOCK words, no pairs leave a
task: a word's neighbours come as their number and the best of them.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from newsloom.llm.fm_index import BiIndex, near_words
from newsloom.llm.texts import slices, stretches
from newsloom.operators.numbering import with_position
from newsloom.session import stage

BLOCK = 16_384        # words of an index
QUERIES = 4_096       # words looked for at once
COUNTED = 200_000     # words counted in a task before their counts are handed on
EVERY = 31            # one run in so many loses a letter
SHORTEST = 7          # code points of a word, four at least
LEAST = 2             # occurrences of a word
TIMES = 10            # a form is so many times as frequent as its variant
BITS = 7
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)   # shorter runs give no word
_GAP = re.compile("[^A-Za-zÀ-ÿ]")
_CODES = {c: k for k, c in enumerate([*map(chr, range(ord("a"), ord("z") + 1)), *map(chr, range(0xC0, 0x100))], 1)}


def runs_of(text: str, key: str) -> Counter[str]:
    """The words of a text after the rule that takes a letter from some of them, with their counts.

    The rule depends on the key and the run alone, so equal runs of a text share its result.
    """
    start, out = zlib.crc32(f"{key}:".encode()), Counter()
    for part in stretches(text, _GAP):
        for run, n in Counter(_RUN.findall(part.encode().lower().decode())).items():
            h = zlib.crc32(run.encode(), start)
            if h % EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < SHORTEST:
                    continue
            out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that occur LEAST times or more in all texts together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def handed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for part in slices(batch):
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in runs_of(text or "", key or "").items():
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) >= COUNTED:
                        yield handed()
        yield handed()

    counted = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def block_bounds(vocabulary: DataFrame, key: str) -> list[str]:
    """The first key of every block but the first: one string for each BLOCK words."""
    placed = with_position(vocabulary.select(F.expr(key).alias("key")), "key")
    first = placed.where((F.col("position") % BLOCK == 0) & (F.col("position") > 0)).select("key")
    return sorted(r.key for r in first.collect())


def _halves(word: str, to_left: bool) -> tuple[str, str]:
    """What a word is ordered by, and the beginning of it that is to be had exactly."""
    half = len(word) // 2
    return (word[::-1], word[half:][::-1]) if to_left else (word, word[:half])


def dealt(vocabulary: DataFrame, bounds: list[str], to_left: bool) -> DataFrame:
    """(block, guest, word, n): every word in its block, and as a guest in the other blocks where words
    with its exact half are. Few words are guests, as few halves go over a block's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, guests, rows = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                key, half = _halves(word, to_left)
                home = bisect_right(bounds, key)
                past = half[:-1] + chr(ord(half[-1]) + 1)
                for block in range(bisect_right(bounds, half), bisect_left(bounds, past) + 1):
                    blocks.append(block)
                    guests.append(block != home)
                    rows.append(i)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(guests, pa.bool_()), *taken.columns],
                names=["block", "guest", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "block long, guest boolean, word string, n long")


def _letters(word: str) -> np.ndarray:
    return np.fromiter(map(_CODES.__getitem__, word), np.uint8, len(word))


class Block:
    """The words of a block in code-point order with their counts, and their index."""

    def __init__(self, words: list[str], counts: list[int], to_left: bool):
        self.words, self.counts, self.to_left = words, np.array(counts, np.int64), to_left
        self.index = BiIndex([_letters(w) for w in words], BITS)

    def neighbours(self, queries: list[str], own: bool) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, list[str]]]:
        """(words, number of near words here, count and word of the best of them), of those with any."""
        by_length: dict[int, list[str]] = {}
        for word in queries:
            by_length.setdefault(len(word), []).append(word)
        for length, same in by_length.items():
            # The letters looked at in a step are bounded by the queries taken at once.
            for k in range(0, len(same), QUERIES):
                some = same[k:k + QUERIES]
                matrix = np.stack([_letters(w) for w in some])
                of, found = near_words(self.index, matrix, np.full(len(some), int(own)), self.to_left)
                if self.to_left:  # those that have the first half too are found to the right
                    half = length // 2
                    new = [self.words[v][:half] != some[q][:half] for q, v in zip(of.tolist(), found.tolist())]
                    of, found = of[new], found[new]
                if not len(of):
                    continue
                best = np.lexsort((found, -self.counts[found], of))
                of, found = of[best], found[best]
                heads = np.flatnonzero(np.diff(of, prepend=-1))
                yield ([some[q] for q in of[heads].tolist()], np.diff(heads, append=len(of)),
                       self.counts[found[heads]], [self.words[v] for v in found[heads].tolist()])


def near_in_blocks(rows: DataFrame, blocks: int, to_left: bool) -> DataFrame:
    """(word, n_near, best_n, best) of ``dealt`` rows: a word has a row for each block with a near word.

    A block is much work for few bytes, so there are as many tasks as blocks, whatever their size.
    A task reads its blocks one after another, the block's words first, so that it holds one index and
    the guests of a batch, however many they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers(block: Block, queries: list[str], own: bool) -> Iterator[pa.RecordBatch]:
            for words, n, best_n, best in block.neighbours(queries, own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array(n, pa.int64()), pa.array(best_n, pa.int64()),
                     pa.array(best, pa.string())], names=["word", "n_near", "best_n", "best"])

        now, words, counts, made = None, [], [], None

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal made
            if words and made is None:
                made = Block(words, counts, to_left)
                yield from answers(made, words, True)

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            kinds = blocks * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if blocks[low] != now:
                    yield from closed()
                    now, words, counts, made = int(blocks[low]), [], [], None
                part = batch.slice(low, high - low)
                if part.column(1)[0].as_py():
                    yield from closed()
                    if made:
                        yield from answers(made, part.column(2).to_pylist(), False)
                else:
                    words += part.column(2).to_pylist()
                    counts += part.column(3).to_pylist()
        yield from closed()

    sent = rows.repartition(blocks, "block").sortWithinPartitions("block", "guest", "word")
    return sent.mapInArrow(run, "word string, n_near long, best_n long, best string")


def with_roots(forms: DataFrame, largest: int) -> DataFrame:
    """(word, root) of (word, form): the last word that the forms lead to, by doubling the distance.

    A form is TIMES as frequent as its variant, so a chain from LEAST to the largest count has at
    most the logarithm of their ratio of steps.
    """
    steps = 0
    while LEAST * TIMES ** (steps + 1) <= largest:
        steps += 1
    roots, reach = forms.select("word", F.col("form").alias("root")), 1
    while reach < steps:
        roots = stage(roots)
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("_further", "root").alias("root"))
        reach *= 2
    return roots


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    A word's form is the most frequent word at one edit, the lesser in code-point order if several are,
    given that it is TIMES as frequent; root is where forms lead to, the word itself without one. Null
    texts have no words; a null id counts as the empty string in the rule that takes letters from runs.
    Repeated rows count as often as they are there. Extra columns are not looked at.
    """
    vocabulary = stage(word_counts(docs, id_col, text_col))
    largest = vocabulary.agg(F.max("n")).first()[0] or 0
    near = None
    for to_left, key in ((False, "word"), (True, "reverse(word)")):
        bounds = block_bounds(vocabulary, key)
        part = near_in_blocks(dealt(vocabulary, bounds, to_left), len(bounds) + 1, to_left)
        near = part if near is None else near.unionByName(part)
    best = near.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    made = stage(vocabulary.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("best.best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    roots = with_roots(made.where(F.col("form").isNotNull()), largest)
    return made.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
