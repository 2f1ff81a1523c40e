"""Language identification by cross-parsing (Ziv and Merhav 1993).

A suffix automaton of labelled text per language finds, from any place of a text, the longest
stretch that the language's text has too. A text is parsed into such phrases, one after another;
the language that needs the fewest phrases for each symbol wins. All blocks of a slice of texts
are parsed in step, against all languages at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from newsloom.llm.texts import fold, slices

SAMPLE_ROWS = 48       # labelled rows a language learns from
SAMPLE_CHARS = 400     # taken of each, at a place that its hash chooses
BLOCK = 512            # symbols parsed in one run; a phrase ends at a block's end
SPACE, OTHER, END, LETTERS = 0, 1, 2, 3   # OTHER: letters of no language; LETTERS: the first of the others
_ODD = np.uint64(0x9E3779B97F4A7C15)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, list[str]]:
    """For each language SAMPLE_ROWS stretches of SAMPLE_CHARS, chosen by hash.

    Spark cuts each language to so many rows in every task before rows are moved.
    """
    mark = F.xxhash64(F.col(id_col).cast("string"), text_col)
    room = F.greatest(F.length(text_col) - SAMPLE_CHARS, F.lit(0)) + 1
    cut = docs.select(
        F.col(lang_col).alias("lang"), mark.alias("mark"),
        F.substring(F.col(text_col), (F.pmod(mark, room) + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
    first = Window.partitionBy("lang").orderBy("mark", "text")
    rows = cut.withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE_ROWS)
    out: dict[str, list[str]] = {}
    for lang, text in sorted(rows.select("lang", "text").collect()):
        out.setdefault(lang, []).append(text)
    return out


def symbol_table(texts: list[str]) -> np.ndarray:
    """Symbol of each code point: every letter of the texts has its own, case folded; letters
    that they lack share one; all else is space."""
    kept = sorted({c for t in texts for c in t.lower() if c.isalpha()})
    out = np.where(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool), OTHER, SPACE).astype(np.int32)
    for k, c in enumerate(kept):
        for form in (c, c.upper()):
            if len(form) == 1:
                out[ord(form)] = k + LETTERS
    return out


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """The text's symbols, with one space for a run of others than letters."""
    s = table[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != SPACE) | (s[:-1] != SPACE)
    return s[keep]


def suffix_automaton(s: list[int]) -> list[dict[int, int]]:
    """Steps of the automaton that reads every factor of s: for each state {symbol: state}."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in s:
        cur, p = len(step), last
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return step


class Steps:
    """A table of steps by key, open addressing; at most half of its places are taken."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        self.bits = max(int(2 * len(keys)).bit_length(), 4)
        self.keys, self.to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # of several keys one stays
            won = left[self.keys[at[left]] == keys[left]]
            self.to[at[won]] = to[won]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD) >> np.uint64(64 - self.bits)).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Where each key leads, -1 for keys without a step."""
        at = self._place(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.to[at], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            place = (at[left] + 1) & (len(self.keys) - 1)
            at[left], found = place, self.keys[place]
            hit = found == keys[left]
            out[left[hit]] = self.to[place[hit]]
            left = left[~hit & (found >= 0)]
        return out


class Parser:
    """Counts the phrases that each language needs. A language takes some 2 MB."""

    def __init__(self, learned: dict[str, list[str]]):
        self.langs = sorted(learned)
        self.table = symbol_table([t for lang in self.langs for t in learned[lang]])
        self.width = int(self.table.max()) + 1 if self.langs else LETTERS
        # From the root a symbol that the language lacks is a phrase alone, in state 0, which has no steps.
        self.first = np.zeros((self.width, len(self.langs)), np.int32)
        keys, to, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 1
        for k, lang in enumerate(self.langs):
            own = [symbols(t, self.table).tolist() for t in learned[lang]]
            # Between stretches stands END, which no text has, so that no phrase crosses.
            step = suffix_automaton([c for t in own for c in (*t, END)])
            edges = np.array([(s, c, q) for s, d in enumerate(step) for c, q in d.items() if c != END],
                             np.int64).reshape(-1, 3)
            root = edges[:, 0] == 0
            self.first[edges[root, 1], k] = edges[root, 2] + at
            keys.append((edges[~root, 0] + at) * self.width + edges[~root, 1])
            to.append((edges[~root, 2] + at).astype(np.int32))
            at += len(step)
        self.steps = Steps(np.concatenate(keys), np.concatenate(to))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases [text, language], and symbols of each text."""
        own = [symbols(t, self.table) for t in texts]
        sizes = np.array([len(s) for s in own], np.int64)
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        grid = np.full((int(first[-1]), BLOCK), END, np.int32)
        for k, s in enumerate(own):
            grid[first[k]:first[k + 1]].reshape(-1)[:len(s)] = s
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        fill = np.minimum(sizes.repeat(blocks) - (np.arange(first[-1]) - first[:-1].repeat(blocks)) * BLOCK, BLOCK)
        order = np.argsort(-fill, kind="stable")  # full blocks first, so that ended ones drop out
        grid, ending = np.ascontiguousarray(grid[order].T), -fill[order]
        state = self.first[grid[0]].astype(np.int64)
        count = np.zeros_like(state)
        for k in range(1, BLOCK):
            n = int(np.searchsorted(ending, -k))  # blocks with more than k symbols
            if not n:
                break
            got = self.steps((state[:n] * self.width + grid[k, :n, None]).ravel()).reshape(n, -1)
            over = got < 0  # a missing step ends the phrase: go where the root goes
            count[:n] += over
            state[:n] = np.where(over, self.first[grid[k, :n]], got)
        count += 1  # the phrase that the block's end cuts
        np.add.at(out, np.repeat(np.arange(len(texts)), blocks)[order], count)
        return out, sizes

    def best(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and how far it is ahead of the next, from 0 to 1."""
        need, sizes = self.phrases(texts)
        rate = need / np.maximum(sizes, 1)[:, None]
        order = np.argsort(rate, axis=1, kind="stable")
        least = np.take_along_axis(rate, order[:, :2], 1)
        ahead = 1 - least[:, 0] / np.maximum(least[:, -1], 1e-12) if len(self.langs) > 1 else np.ones(len(texts))
        return [self.langs[k] for k in order[:, 0]], np.clip(ahead, 0, 1)


_PARSER: dict[tuple, Parser] = {}  # of this worker


def parser(learned: dict[str, list[str]]) -> Parser:
    key = tuple((lang, *texts) for lang, texts in sorted(learned.items()))
    if key not in _PARSER:
        _PARSER.clear()
        _PARSER[key] = Parser(learned)
    return _PARSER[key]


def language_id(docs: DataFrame, folds: int = 3, held_out: int = 1, id_col: str = "doc_id",
                text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row.

    Learns from rows outside the held-out fold that have a language and a letter. ``und`` with
    score 0 for null texts, texts without a letter, and where nothing can be learned. A tie
    goes to the first language by name.
    """
    part = fold(F.col(id_col), folds)
    letter = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    known = docs.where((part != held_out) & F.col(lang_col).isNotNull() & letter)
    sent = docs.sparkSession.sparkContext.broadcast(sample(known, id_col, text_col, lang_col))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(sent.value)
        for batch in batches:
            for rows in slices(batch):
                texts, real = rows.column(1).to_pylist(), np.array(rows.column(3).to_pylist(), bool)
                real &= bool(own.langs)
                langs, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
                if real.any():
                    langs[real], scores[real] = own.best([t for t, r in zip(texts, real) if r])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array(langs, pa.string()), pa.array(scores)],
                    names=schema.names)

    return docs.select(id_col, text_col, (part == held_out).alias("held_out"), letter.alias("real")).mapInArrow(
        run, schema)
