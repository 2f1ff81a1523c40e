"""Token counts by byte-pair merging with a heap and a linked list, without identifiers.

A piece starts as one symbol per byte. Its symbols are a doubly linked list in arrays; a heap
holds the adjacent pairs that have a merge, by rank and then by place. The lowest is popped again
and again: if it still stands there, the two symbols become one and the two new neighbouring pairs
join the heap. The count is the number of symbols at first less the merges made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, types as T

from newsloom.llm.texts import slices, stretches

LIMIT = 512
PIECES = 200_000      # counted pieces held in a task, some 30 MB
SHORT = 64            # characters of a piece that is held
BITS = 20             # of a symbol
_SPACE_BEGINS = regex.compile(r"(?<=\S)(?=\s)")   # a piece always ends there


@dataclass(frozen=True)
class Merges:
    """What of a tokenizer's file decides the count; its size is that of the vocabulary.

    ``pairs`` has rank and joined symbol by left << BITS | right, ``symbols`` the symbol of each
    byte, ``specials`` the strings that are one token each wherever they stand in a text.
    """

    pairs: dict[int, tuple[int, int]]
    symbols: tuple[int, ...]
    specials: tuple[str, ...]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself if it is
    printable and no space, otherwise the next of those from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_merges(data: bytes) -> Merges:
    """The merges of a tokenizer file (JSON) that holds a byte-level BPE.

    A file that asks for anything that this module does not do is refused with ValueError.
    """
    file = json.loads(data)
    model, splitter, added = file["model"], file.get("pre_tokenizer") or {}, file.get("added_tokens") or []
    plain = (
        model.get("type") == "BPE" and not any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
            "ignore_merges"))
        and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space") and not file.get("normalizer")
        and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip"))
    )
    letters, ids = byte_letters(), model.get("vocab", {})
    if not plain or any(c not in ids for c in letters) or len(ids) > 1 << BITS:
        raise ValueError("not a plain byte-level BPE")
    pairs = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        pairs[ids[left] << BITS | ids[right]] = (rank, ids[left + right])
    return Merges(pairs, tuple(ids[c] for c in letters), tuple(t["content"] for t in added))


def count_piece(piece: bytes, merges: Merges) -> int:
    """The number of tokens that the merges make of one piece."""
    symbols = [merges.symbols[b] for b in piece]
    n, pairs = len(symbols), merges.pairs
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for at in range(n - 1):
        found = pairs.get(symbols[at] << BITS | symbols[at + 1])
        if found:
            heap.append((found[0], at, found[1]))
    heapq.heapify(heap)
    merged = 0
    while heap:
        rank, at, joined = heapq.heappop(heap)
        right = after[at]
        # A pair that has changed since it was pushed has another rank, or none.
        if right >= n or symbols[at] < 0 or pairs.get(symbols[at] << BITS | symbols[right], (-1,))[0] != rank:
            continue
        symbols[at], symbols[right] = joined, -1
        after[at] = after[right]
        if after[at] < n:
            before[after[at]] = at
        merged += 1
        for left in (before[at], at):
            if left >= 0 and after[left] < n:
                found = pairs.get(symbols[left] << BITS | symbols[after[left]])
                if found:
                    heapq.heappush(heap, (found[0], left, found[1]))
    return n - merged


class Counter:
    """Counts whole texts; keeps the counts of pieces met lately and, of those before, common ones."""

    def __init__(self, merges: Merges, pattern: str = public_tokenizers.PATTERN):
        self.merges = merges
        self.pieces = regex.compile(pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.specials))) if merges.specials else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _counted(self, piece: str) -> int:
        made = self.older.get(piece) or count_piece(piece.encode(), self.merges)
        if len(piece) <= SHORT:
            self.known[piece] = made
        return made

    def _plain(self, text: str) -> int:
        total, counted = 0, self._counted
        for part in stretches(text, _SPACE_BEGINS):
            if len(self.known) >= PIECES // 2:
                self.known, self.older = {}, self.known
            known = self.known.get
            total += sum([known(p) or counted(p) for p in self.pieces(part)])
        return total

    def count(self, text: str) -> int:
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, pattern: str = public_tokenizers.PATTERN,
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without the text, with n_bytes, n_tokens and over_limit.

    ``path`` is a tokenizer's JSON file, read by the driver and sent to the tasks. Begin and end
    tokens are not added; the file's special strings are one token each where a text has them.
    A null or empty text has 0 bytes and tokens. Repeated rows are counted each. Columns of the new
    names are replaced. A text is worked on in stretches, so that of a very long one only its longest
    run without white space and a stretch are held as pieces.
    """
    with open(path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    made = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in docs.columns if c not in made and c != text_col]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Counter(read_merges(sent.value), pattern)
        for batch in batches:
            for part in slices(batch, len(kept)):
                texts = part.column(len(kept)).to_pylist()
                size = [len(t.encode()) if t else 0 for t in texts]
                count = [own.count(t) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(size, pa.int64()), pa.array(count, pa.int64()),
                     pa.array([n > limit for n in count], pa.bool_())], names=schema.names)

    return docs.select(*kept, text_col).mapInArrow(run, schema)
