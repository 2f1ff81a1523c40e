"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

Of any byte string exactly one segmentation is the one that the merges give: the one in which
each two neighbours are a *stable pair*, tokens that the merges would not have joined otherwise.
That makes encoding a nondeterministic transducer: an item is a token being spelled and the
token before it. A state of the determinised one is the set of items alive after some bytes; it
tells the last token of what was read so far. States and steps are made when first needed and
thrown away when there are too many. No item is longer than the longest token, so the
segmentations still possible differ only in the last bytes, and all tokens before the place
where they meet can be given out.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from newsloom.llm.texts import giving_back, slices

# Tables of a task: states (some 80 MB for 200,000) and encoded pieces (some 60 MB for 300,000). Small
# ones serve a pipeline whose workers have other tables too.
STATES, PIECES = 200_000, 300_000
ROUND_TRIP_STATES, ROUND_TRIP_PIECES = 400_000, 800_000
LONG_PIECE = 4096    # bytes; longer pieces give out tokens while they are read
CHUNK = 8192         # ids decoded at once
NONE = -1            # no token
BITS = 20            # of a token's id
LAST = (1 << BITS) - 1


def read_ranks(data: bytes) -> list[bytes]:
    """The tokens by id, from lines of base64 and rank."""
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, data.splitlines()))
    return [token for _, token in pairs]


class Transducer:
    """Encodes pieces of bytes; ``names`` are the tokens by rank."""

    def __init__(self, names: list[bytes], states: int = STATES):
        self.names, self.states = names, states
        self.ids = {name: k for k, name in enumerate(names)}
        # Beginnings of tokens, numbered from 0 for the empty one: the next one by a byte, the
        # token that is spelled out there, and the length.
        self.child: dict[int, int] = {}
        self.spelled, self.depth = [NONE], [0]
        for token, name in enumerate(names):
            at = 0
            for byte in name:
                key = at << 8 | byte
                at = self.child.get(key)
                if at is None:
                    at = self.child[key] = len(self.spelled)
                    self.spelled.append(NONE)
                    self.depth.append(self.depth[key >> 8] + 1)
            self.spelled[at] = token
        self.halves: dict[int, tuple[int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        # A state's items lie flat: beginning, token before, and so on. A step goes from
        # state << 8 | byte to state << BITS | last token. Plain numbers keep the tables small.
        self.items: list[tuple] = []
        self.steps: dict[int, int] = {}
        self.numbers: dict[tuple, int] = {}
        self.stable: dict[int, bool] = {}
        self.start = self._number((0, NONE))

    def _number(self, items: tuple) -> int:
        found = self.numbers.get(items)
        if found is None:
            found = self.numbers[items] = len(self.items)
            self.items.append(items)
        return found

    def _split(self, token: int) -> tuple[int, int]:
        """The two tokens that were joined last in making this one; itself twice for a byte."""
        if token not in self.halves:
            name = self.names[token]
            parts = [name[i:i + 1] for i in range(len(name))]
            while len(parts) > 2:
                ranks = [self.ids.get(a + b, len(self.names)) for a, b in zip(parts, parts[1:])]
                i = ranks.index(min(ranks))
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.halves[token] = (self.ids[parts[0]], self.ids[parts[-1]])
        return self.halves[token]

    def is_stable(self, left: int, right: int) -> bool:
        """The merges leave the two tokens side by side.

        Undo the younger token's last merge, again and again: if at some stage the facing
        parts have a merge that comes before the one just undone, it would have been made.
        """
        key = left << BITS | right
        found = self.stable.get(key)
        if found is None:
            x, y, bound, found = left, right, len(self.names), True
            while True:
                joined = self.ids.get(self.names[x] + self.names[y])
                if joined is not None and joined < bound:
                    found = False
                    break
                # Equal ranks merge from the left, so the left token's merge is undone last.
                a, b = self._split(x), self._split(y)
                can_x, can_y = len(self.names[x]) > 1, len(self.names[y]) > 1
                if can_x and (x > y or not can_y):
                    bound, x = x, a[1]
                elif can_y:
                    bound, y = y + 1, b[0]
                else:
                    break
            self.stable[key] = found
        return found

    def _step(self, state: int, byte: int) -> int:
        last, alive, own = NONE, [], self.items[state]
        for at, before in zip(own[::2], own[1::2]):
            at = self.child.get(at << 8 | byte)
            if at is None:
                continue
            alive += (at, before)
            token = self.spelled[at]
            if last == NONE and token != NONE and (before == NONE or self.is_stable(before, token)):
                last = token
        made = self.steps[state << 8 | byte] = self._number((*alive, 0, last)) << BITS | last
        return made

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece. A piece that is itself a token is that token."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) >= LONG_PIECE:
            return [k for part in self.stream([piece]) for k in part]
        if len(self.items) > self.states:
            self._reset()
        state, lasts, step = self.start, [], self.steps.get
        for byte in piece:
            made = step(state << 8 | byte)
            if made is None:
                made = self._step(state, byte)
            state = made >> BITS
            lasts.append(made & LAST)
        return self._back(lasts, len(lasts))

    def _back(self, lasts: list[int], at: int) -> list[int]:
        out, names = [], self.names
        while at:
            out.append(lasts[at - 1])
            at -= len(names[out[-1]])
        return out[::-1]

    def stream(self, chunks: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of one piece that arrives in chunks, each as soon as it is certain."""
        state, lasts, names = self.start, [], self.names
        for chunk in chunks:
            for at in range(0, len(chunk), LONG_PIECE):
                for byte in chunk[at:at + LONG_PIECE]:
                    made = self.steps.get(state << 8 | byte)
                    if made is None:
                        made = self._step(state, byte)
                    state = made >> BITS
                    lasts.append(made & LAST)
                if len(lasts) >= LONG_PIECE:  # where do all segmentations still alive meet?
                    ends = {len(lasts) - self.depth[at] for at in self.items[state][::2]}
                    while len(ends) > 1:
                        most = max(ends)
                        ends.remove(most)
                        ends.add(most - len(names[lasts[most - 1]]))
                    meet = ends.pop()
                    if meet:  # the items know the token before what is left
                        yield self._back(lasts, meet)
                        del lasts[:meet]
                if len(self.items) > self.states:
                    items = self.items[state]
                    self._reset()
                    state = self._number(items)
        yield self._back(lasts, len(lasts))


class Utf8Stream:
    """Turns chunks of bytes into text; a character cut by a chunk's end waits for the rest.

    The machine's state is the lead byte's unfinished sequence: how many tail bytes it still
    needs. Only the last three bytes of a chunk can change it. Broken bytes become U+FFFD.
    """

    def __init__(self):
        self.rest = b""

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
                if need > back:
                    cut -= back
                break
        data, self.rest = data[:cut], data[cut:]
        return data.decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Texts to packed ids (little-endian, 32 bits each) and back."""

    def __init__(self, names: list[bytes], pattern: str, states: int = STATES, pieces: int = PIECES):
        self.transducer, self.pieces = Transducer(names, states), pieces
        self.split = regex.compile(pattern).findall
        # Encoded pieces, those met lately and those before them: common ones stay.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encoded(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.transducer.encode(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            self.known[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if len(self.known) >= self.pieces // 2:
            self.known, self.older = {}, self.known
        known, encoded = self.known.get, self._encoded
        return b"".join([known(p) or encoded(p) for p in self.split(text)])

    def decoded(self, packed: bytes) -> Iterator[str]:
        """The text of the ids in parts, decoded in chunks that need not end between characters."""
        names, stream = self.transducer.names, Utf8Stream()
        ids = np.frombuffer(packed, "<u4")
        for k in range(0, len(ids), CHUNK):
            yield stream.feed(b"".join(map(names.__getitem__, ids[k:k + CHUNK].tolist())))
        yield stream.end()

    def decode(self, packed: bytes) -> str:
        return "".join(self.decoded(packed))


_CODEC: dict[tuple, Codec] = {}  # of this worker, with the states it has made


def codec(data: bytes, pattern: str, states: int = STATES, pieces: int = PIECES) -> Codec:
    key = (hashlib.sha256(data + pattern.encode()).digest(), states, pieces)
    if key not in _CODEC:
        _CODEC.clear()
        _CODEC[key] = Codec(read_ranks(data), pattern, states, pieces)
    return _CODEC[key]


def forget() -> None:
    """Drops the worker's codec: workers live on, and later steps of the session need their memory.

    ``round_trip`` keeps its larger tables from task to task, since making them anew takes longest."""
    _CODEC.clear()


def vocabulary(path: str) -> bytes:
    """The rank file, read by the driver and sent to the tasks; its size is that of a vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def tokenize(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN,
             text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """Adds the ids of the whole text as array<int> and, if named, their decoded text.

    A null or empty text has no ids and decodes to the empty text. Special tokens do not exist.
    The result's other columns are the input's; a column of the new name is replaced.
    """
    added = [ids_col] + [decoded_col] * bool(decoded_col)
    docs = docs.select([c for c in docs.columns if c not in added])
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))
    names = [*docs.columns, *added]
    at = names.index(text_col)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value, pattern)
        try:
            for batch in batches:
                for part in slices(batch, at):
                    packed = [own.encode(t or "") for t in part.column(at).to_pylist()]
                    flat = np.frombuffer(b"".join(packed), "<i4")
                    offsets = np.cumsum([0] + [len(p) // 4 for p in packed]).astype(np.int32)
                    made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                    if decoded_col:
                        made.append(pa.array([own.decode(p) for p in packed], pa.string()))
                    yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)
        finally:
            forget()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN,
               id_col: str = "doc_id", text_col: str = "text", states: int = ROUND_TRIP_STATES,
               pieces: int = ROUND_TRIP_PIECES) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: digests of the packed ids and of
    the bytes decoded from them. Ids and texts stay in the task that makes them. ``states`` and
    ``pieces`` bound a task's tables and change no result."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value, pattern, states, pieces)
        for batch in batches:
            for part in slices(batch):
                count, ids, texts = [], [], []
                for t in part.column(1).to_pylist():
                    packed = own.encode(t or "")
                    count.append(len(packed) // 4)
                    ids.append(hashlib.sha256(packed).hexdigest())
                    digest = hashlib.sha256()
                    for text in own.decoded(packed):
                        digest.update(text.encode())
                    texts.append(digest.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(texts, pa.string())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
