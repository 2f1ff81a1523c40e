"""A bidirectional FM-index of a delimited vocabulary, and a search scheme for one error.

The words stand one after another, a delimiter before each, in a text without beginning or end. The
index holds the ranks of the text's rotations (its suffixes, read on around the end), and those of
the text read backwards. The rotations that begin with a pattern are an interval of ranks in both; a
letter put before or after the pattern narrows both intervals at once. All patterns of a step are
worked on together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DELIMITER = 0


def rotation_order(text: np.ndarray) -> np.ndarray:
    """Where the text's rotations begin, in their order, by doubling the compared length."""
    n, width = len(text), 1
    rank = text.astype(np.int64)
    while True:
        order = np.argsort(rank, kind="stable")
        steps = np.diff(rank[order]) != 0
        if steps.all() or width >= 2 * n:
            return order
        rank[order] = np.concatenate([[0], np.cumsum(steps)])
        rank = rank * n + np.roll(rank, -width)
        width *= 2


class Ranks:
    """How often letters stand in a range of a sequence: a wavelet matrix, one level for each bit."""

    def __init__(self, letters: np.ndarray, bits: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        now = letters
        for bit in range(bits - 1, -1, -1):
            one = (now >> bit & 1).astype(bool)
            zeros = np.zeros(len(now) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            now = np.concatenate([now[~one], now[one]])
        every = np.arange(1 << bits)
        self.begins = np.zeros(1 << bits, np.int64)   # of a letter's places on the lowest level
        self.begins = self.within(np.zeros_like(every), np.zeros_like(every), every)[2]

    def within(self, low: np.ndarray, high: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the places from low to before high: how many hold lesser letters, how many this letter;
        and how many places before low hold this letter."""
        lesser = np.zeros(len(low), np.int64)
        for bit, zeros, of_all in self.levels:
            low0, high0 = zeros[low], zeros[high]
            one = (letter >> bit & 1).astype(bool)
            lesser += np.where(one, high0 - low0, 0)
            low = np.where(one, of_all + low - low0, low0)
            high = np.where(one, of_all + high - high0, high0)
        return lesser, high - low, low - self.begins[letter]


@dataclass
class Intervals:
    """Patterns by their ranks: the first in the text, the first in the text read backwards, and how
    many. ``of`` is the query that a pattern belongs to."""

    of: np.ndarray
    low: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def take(self, which: np.ndarray) -> Intervals:
        return Intervals(self.of[which], self.low[which], self.back[which], self.size[which])


def _together(parts: list[Intervals]) -> Intervals:
    return Intervals(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("of", "low", "back", "size")))


class BiIndex:
    """An index of distinct words, given as arrays of letters from 1 to below ``1 << bits``."""

    def __init__(self, words: list[np.ndarray], bits: int):
        ends = np.cumsum([len(w) + 1 for w in words])
        whose = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(ends, prepend=0))
        text = np.zeros(len(whose), np.uint8)
        text[np.flatnonzero(np.diff(whose, prepend=-1) == 0)] = np.concatenate(words)
        self.bits = bits
        self.lesser = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        order = rotation_order(text)
        self.word_at = whose[order]
        self.before = text[order - 1]            # the letter in front of each rotation
        self.before_ranks = Ranks(self.before, bits)
        text = text[::-1]
        self.after = text[rotation_order(text) - 1]   # the same of the text read backwards
        self.after_ranks = Ranks(self.after, bits)

    def empty(self, n: int) -> Intervals:
        """n empty patterns, one for each of n queries."""
        zero = np.zeros(n, np.int64)
        return Intervals(np.arange(n), zero, zero, np.full(n, len(self.before), np.int64))

    def extended(self, at: Intervals, letter: np.ndarray, to_left: bool) -> Intervals:
        """The patterns with a letter put before or after them, of those that then occur."""
        low, ranks = (at.low, self.before_ranks) if to_left else (at.back, self.after_ranks)
        lesser, count, ahead = ranks.within(low, low + at.size, letter)
        grown, other = self.lesser[letter] + ahead, (at.back if to_left else at.low) + lesser
        made = Intervals(at.of, grown, other, count) if to_left else Intervals(at.of, other, grown, count)
        return made.take(np.flatnonzero(count))

    def neighbours(self, at: Intervals, to_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, letter) for the letters that can follow: those that stand next to a pattern in the
        text where it has few places, otherwise all letters."""
        letters = 1 << self.bits
        low, beside = (at.low, self.before) if to_left else (at.back, self.after)
        few = at.size <= letters
        size = np.where(few, at.size, 0)
        which = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        codes = np.unique(which * letters + beside[place])
        wide = np.flatnonzero(~few)
        codes = np.concatenate([codes, (wide[:, None] * letters + np.arange(letters)).ravel()])
        which, letter = codes // letters, codes % letters
        real = letter != DELIMITER
        return which[real], letter[real]


def near_words(index: BiIndex, queries: np.ndarray, own: np.ndarray, to_left: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) for the words one inserted, deleted or replaced letter away that have one half of
    the query exactly: the first half, or the second if the error is to the left.

    ``queries`` is a matrix of words of one length, a row each; ``own`` is 1 where the query is
    itself a word of the index. The exact half with the delimiter at its outer end is matched first;
    the pattern then grows over the other half, with the error at any place, up to the other
    delimiter. A pattern that only the query itself has is not followed further.
    """
    n, length = queries.shape
    half = length // 2
    first, second = list(range(half)), list(range(half, length))
    exact, rest = (second, first[::-1]) if to_left else (first[::-1], second)

    def letters(column: int | None, at: Intervals) -> np.ndarray:
        return np.zeros(len(at.of), np.int64) if column is None else queries[at.of, column].astype(np.int64)

    def shared(at: Intervals) -> Intervals:
        return at.take(np.flatnonzero(at.size > own[at.of]))

    right = index.empty(n)          # patterns without an error
    for column in (*exact, None):
        right = shared(index.extended(right, letters(column, right), not to_left))
    wrong = right.take(np.zeros(0, np.int64))   # patterns with their error that go on with this column
    for column in (*rest, None):
        which, letter = index.neighbours(right, to_left)
        more = index.extended(right.take(which), letter, to_left)
        later = [index.extended(now, letters(column, now), to_left) for now in (wrong, more)]
        if column is not None:
            other = letter != letters(column, right)[which]
            later.append(index.extended(right.take(which[other]), letter[other], to_left))   # replaced
            later.append(right)                                                              # left out
            right = shared(index.extended(right, letters(column, right), to_left))
        wrong = _together(later)
    # From delimiter to delimiter a pattern is one word, and its place that word's.
    codes = np.unique(wrong.of * len(index.before) + index.word_at[wrong.low])
    return codes // len(index.before), codes % len(index.before)
