"""Quality rules on repetition: how much of a text lies in repeated word n-grams and lines.

Rolling polynomial hashes over word hashes give the windows of any length from one running sum.
Windows of equal hash are compared word by word before they count as repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from newsloom.llm.texts import mix, slices, words

# The limits of MassiveText's repetition filter (Rae et al. 2021, "Gopher", table A1).
# Greatest share of the text's word characters in repeated windows of so many words.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_COVERAGE = 0.20   # greatest share of word characters in lines equal to an earlier one
LINE_SHARE = 0.30      # greatest share of such lines among the lines with a word
MEASURED = (*COVERAGE, 12)   # windows of 12 have no published limit and are only reported
MIN_WORDS = 10
REPEAT_PERCENT = 20    # greatest share of words in repeated windows of five
SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACES = " \t\n\x0b\x0c\r"
_LEAD = np.ones(256, np.int64)   # bytes that begin a character in a word
_LEAD[0x80:0xC0] = 0
_LEAD[[9, 10, 11, 12, 13, 32]] = 0
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def repeated_words(ids: np.ndarray, begins: np.ndarray, sums: np.ndarray, back: np.ndarray, n: int) -> np.ndarray:
    """Marks the words in windows of n words that their text has twice or more."""
    k = len(ids)
    mark = np.zeros(k, bool)
    if k < n:
        return mark
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    inside = text[:k - n + 1] == text[n - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return mark
    h = mix((sums[at + n] - sums[at]) * back[at] + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(h, kind="stable")
    at, h = at[order], h[order]
    pair = np.flatnonzero(h[1:] == h[:-1])
    equal = text[at[pair]] == text[at[pair + 1]]
    for j in range(n):
        equal &= ids[at[pair] + j] == ids[at[pair + 1] + j]
    if equal.all():
        hit = np.zeros(len(at), bool)
        hit[pair] = hit[pair + 1] = True
        starts = at[hit]
    else:  # different windows share a hash: sort by the words themselves
        rows = np.column_stack([text[at], *(ids[at + j] for j in range(n))])
        _, where, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        starts = at[count[where.ravel()] > 1]
    edge = np.zeros(k + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _total(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(values)])
    return run[begins[1:]] - run[begins[:-1]]


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text; characters are code points, null texts are empty."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    ids, begins, distinct = words(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:int(ends[-1])]
    length = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = length[ids] if len(ids) else np.zeros(0, np.int64)
    hashed = mix(ids.astype(np.uint64) + np.uint64(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * powers(_BASE, len(ids)), dtype=np.uint64)])
    back = powers(_INVERSE, len(ids))
    out = {"n_words": np.diff(begins), "word_chars": _total(_LEAD[data], ends),
           "n_symbols": _total(_SYMBOL[data], ends)}
    for n in MEASURED:
        mark = repeated_words(ids, begins, sums, back, n)
        if n == 5:
            out["n_repeat_words"] = _total(mark, begins)
        out[f"chars_{n}"] = _total(np.where(mark, chars, 0), begins)
    lines, inside, filled = [], [], []
    for t in texts.to_pylist():
        seen: set[str] = set()
        twice = cover = 0
        if "\n" in t:
            for line in t.split("\n"):
                if line in seen:
                    twice += 1
                    cover += sum(map(len, line.encode().split())) if line.isascii() else sum(
                        len(w.decode()) for w in line.encode().split())
                elif line.strip(_SPACES):
                    seen.add(line)
        lines.append(twice)
        inside.append(cover)
        filled.append(max(len(seen) + twice, 1))
    return out | {"n_dup_lines": np.array(lines, np.int64), "line_chars": np.array(inside, np.int64),
                  "n_lines": np.array(filled, np.int64)}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, coverages and verdicts of every row.

    ``base_failed``: fewer than MIN_WORDS words, or too many words in repeated windows of five.
    ``kept``: not that, and every coverage and the share of repeated lines within its limit.
    Null and empty texts fail.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
        + [T.StructField(f"coverage_{n}", T.DoubleType()) for n in MEASURED]
        + [T.StructField("coverage_lines", T.DoubleType()), T.StructField("share_dup_lines", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                m = measures(part.column(1))
                bad = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
                whole = np.maximum(m["word_chars"], 1)
                cover = {n: m[f"chars_{n}"] / whole for n in MEASURED}
                cover |= {"lines": m["line_chars"] / whole, "dup_lines": m["n_dup_lines"] / m["n_lines"]}
                kept = ~bad
                for n, most in (COVERAGE | {"lines": LINE_COVERAGE, "dup_lines": LINE_SHARE}).items():
                    kept &= cover[n] <= most
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(m[c]) for c in counts), pa.array(bad), pa.array(kept),
                     *map(pa.array, cover.values())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
