"""Jaccard join on word shingles by adaptive multi-match prefixes (after Wang, Li, Feng 2012).

Texts of equal shingle sets are one class, named by 64 bits of a 128-bit hash of the set; if two
classes had the same 64 bits, all names would be drawn anew. A class orders
its shingles by estimated document frequency, rarest first, and posts a prefix of them: for
similarity t two classes of sizes n and m share at least ``need`` = ceil(t (n + m) / (1 + t))
shingles, so their prefixes of n - need + l share at least l. Each class picks its own l: a
longer prefix costs more postings but asks for more matches before a pair is verified; a pair
must match as often as the smaller l of its two ends. The order is only a hint (frequencies are
lower bounds, and only the most frequent are sent along), so results do not depend on it.

Classes that share a posted shingle are first compared with the shingle's leaders: with the
nearest one, then, where that has not joined them, with more. Verified links make components;
only pairs between different components are then compared in full. So a group of m near copies
costs some m comparisons and not m squared, and no link that could join two components is left
out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from newsloom.llm.texts import giving_back, may_be_in, mix, shingle_sets, slices
from newsloom.operators.components import connected_components
from newsloom.session import stage

HOT_SHINGLES = 1 << 18   # at most so many frequencies are sent to every task: 4 MB
WINDOW = 1 << 21         # shingles in which a task looks for repeated ones
BUCKET_ROWS = 1 << 18    # postings that a task holds at once, on average
SALT_ROWS = 50_000       # postings of one frequent shingle that stay together
ORDERS = 64              # orders of the classes, of which a shingle takes LEADS
LEADS = 2
NEAREST = (1, 32)        # leaders that a class is compared with, round by round
LADDER = np.array([1, 2, 3, 4, 6, 8])
VERIFY_COST = 20.0       # of a candidate, in units of one posting read
BITMAP = 8               # words of 64 bits in a class's parity bitmap
WIDEST = 1 << 18         # and at most in the one that grows with the set
FEW = 8                  # classes of a shingle that are compared pair by pair before they move

POSTING = np.dtype([("token", "<u8"), ("sig", "<u8"), ("n", "<i4"), ("pos", "<i4"), ("ell", "u1"), ("salts", "<u2")])


def salt_of(rows: np.ndarray) -> np.ndarray:
    return rows["sig"] % rows["salts"].astype(np.uint64)


def name_of(shingles: np.ndarray, draw: int = 0) -> tuple[int, int] | None:
    """The name of a set, and 64 bits more that tell whether two sets have the same name."""
    if not len(shingles):
        return None
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16, salt=draw.to_bytes(8, "little")).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def to_planes(rows: np.ndarray) -> bytes:
    """Postings column by column, and of each column the first bytes, then the second ones: most of
    the upper bytes are zero, and Spark's compression takes them away."""
    return b"".join(np.ascontiguousarray(rows[c]).view(np.uint8).reshape(len(rows), POSTING[c].itemsize).T.tobytes()
                    for c in POSTING.names)


def from_planes(raw: pa.Buffer) -> np.ndarray:
    rows, at = np.empty(raw.size // POSTING.itemsize, POSTING), 0
    for c in POSTING.names:
        width = POSTING[c].itemsize
        planes = np.frombuffer(raw, np.uint8, len(rows) * width, at).reshape(width, len(rows))
        rows[c] = np.ascontiguousarray(planes.T).view(POSTING[c])[:, 0]
        at += planes.size
    return rows


def parity(shingles: np.ndarray, size: int = BITMAP) -> np.ndarray:
    """For each bit of the bitmap whether an odd number of shingles falls on it.

    Bitmaps of two sets differ in no more bits than the sets in shingles, so a pair whose
    bitmaps differ in too many cannot be similar (bitmap filter, Sandes et al. 2020).
    """
    bit = (shingles >> np.uint64(40)).astype(np.int64) % (64 * size)
    odd = np.bincount(bit, minlength=64 * size) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def wide_parity(shingles: np.ndarray) -> bytes:
    """A parity bitmap of BITMAP words or of at least two bits for each shingle, a power of two words long.

    However long the texts, unlike sets differ in more bits than similar ones may; a bitmap
    takes a thirtieth of its set.
    """
    size = BITMAP
    while size < WIDEST and 32 * size < len(shingles):
        size *= 2
    return parity(shingles, size).tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    """The number of bits in which two wide bitmaps differ; the longer one is folded first."""
    p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    if len(p) < len(q):
        p, q = q, p
    return int(np.bitwise_count(np.bitwise_xor.reduce(p.reshape(-1, len(q)), axis=0) ^ q).sum())


BITS = [f"b{k}" for k in range(BITMAP)]


def outline(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", draw: int = 0) -> DataFrame:
    """Rows (id, sig, more, n, bitmap) of documents and, with a null id and sig, (token, seen) of shingles that
    repeat in a task. One pass over the texts; nothing is moved."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("sig", T.LongType()), T.StructField("more", T.LongType()),
        T.StructField("n", T.IntegerType()), *(T.StructField(b, T.LongType()) for b in BITS),
        T.StructField("wide", T.BinaryType()), T.StructField("token", T.LongType()), T.StructField("seen", T.IntegerType())])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        names: set[tuple[int, int]] = set()

        def repeated(ids: pa.Array) -> pa.RecordBatch:
            own = np.concatenate(held)
            held.clear()
            names.clear()
            own.sort()  # in place: np.unique would hold several copies, and workers keep what they once took
            same = np.concatenate([[False], own[1:] == own[:-1], [False]])
            first, last = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
            tokens, seen = own[first].view(np.int64), last - first + 1
            k = len(tokens)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, ids.type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()),
                 *(pa.nulls(k, pa.int64()) for _ in BITS), pa.nulls(k, pa.binary()), pa.array(tokens), pa.array(seen.astype(np.int32))], names=schema.names)

        ids = None
        for batch in batches:
            for part in slices(batch):
                ids, sigs, sizes, maps, wide = part.column(0), [], [], [], []
                for s in shingle_sets(part.column(1)):
                    sig = name_of(s, draw)
                    sigs.append(sig or (0, 0))
                    sizes.append(len(s))
                    maps.append(parity(s))
                    wide.append(wide_parity(s))
                    if sig and sig not in names:
                        names.add(sig)
                        held.append(s)
                k = len(sigs)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(x, pa.int64()) for x in zip(*sigs)), pa.array(sizes, pa.int32()),
                     *(pa.array(np.ascontiguousarray(b)) for b in np.array(maps).T),
                     pa.array(wide, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32())], names=schema.names)
                if sum(map(len, held)) > WINDOW:
                    yield repeated(ids)
        if held:
            yield repeated(ids)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def hot_shingles(repeats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, about HOT_SHINGLES at most, sorted, and their counts.

    Whole powers of two of frequency go along, the highest first. Of the first that has no room,
    those of the least hashes go: hashes spread evenly, so a bound on them takes the share that fits.
    """
    level = F.floor(F.log2("df"))
    counts = stage(repeats.groupBy("token").agg(F.sum("seen").alias("df")))
    levels = counts.groupBy(level.alias("level")).count().collect()
    left, taken = HOT_SHINGLES, F.lit(False)
    for at, rows in sorted(map(tuple, levels), reverse=True):
        if rows > left:
            taken = taken | ((level == at) & (F.col("token") < -(1 << 63) + (left << 64) // rows))
            break
        taken, left = taken | (level == at), left - rows
    got = counts.where(taken).toArrow()  # as Arrow: a row object for each shingle would take the driver far more
    tokens, df = got["token"].to_numpy().astype(np.int64).view(np.uint64), got["df"].to_numpy().astype(np.int64)
    order = np.argsort(tokens)
    return tokens[order], df[order]


def prefix(tokens: np.ndarray, df: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The posted shingles in order, their frequencies and the chosen number of matches.

    For l matches the prefix has n - ceil(t n) + l shingles. Its cost is one unit for each
    posting met and VERIFY_COST for each candidate, of which there are at most postings / l.
    """
    n = len(tokens)
    need = -(-percent * n // 100)
    if df.any():
        order = np.lexsort((tokens, df))
        tokens, df = tokens[order], df[order]
    ladder = LADDER[LADDER <= max(need, 1)]
    met = np.cumsum(np.maximum(df - 1, 0))
    ends = n - need + ladder
    cost = met[ends - 1] * (1 + VERIFY_COST / ladder) + ladder
    best = int(np.argmin(cost))
    return tokens[:ends[best]], df[:ends[best]], int(ladder[best])


def has_fitting(number: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """For each row whether another of its group has a set size that allows the similarity:
    if any has, one next to it by size has."""
    order = np.lexsort((n, number))
    size, group = n[order], number[order]
    fits = (group[1:] == group[:-1]) & (100 * size[:-1] >= percent * size[1:])
    out = np.zeros(len(n), bool)
    out[order[1:]] = fits
    out[order[:-1]] |= fits
    return out


def has_match(number: np.ndarray, n: np.ndarray, pos: np.ndarray, ell: np.ndarray, percent: int) -> np.ndarray:
    """For each row, in order of groups, whether another of its group may be similar by size and place.

    A match counts only if the shingles before it leave room for the overlap needed. Groups of up to
    FEW rows are told exactly, pair by pair. In larger ones a row stays if a size is there that its own place
    allows.
    """
    low, room = -(-percent * n // 100), n - pos + ell - 1
    high = np.minimum(100 * n // percent, room * (100 + percent) // percent - n)
    own = (number << 32) | n
    held = np.sort(own)
    there = np.searchsorted(held, (number << 32) | np.maximum(high, 0), "right") - np.searchsorted(held, (number << 32) | low)
    out = there - ((low <= n) & (n <= high)) > 0
    start = np.flatnonzero(np.diff(number, prepend=-1))
    size = np.diff(np.append(start, len(n)))
    few = np.repeat(size <= FEW, size)
    out[few] = False
    for step in range(1, min(FEW, len(n))):
        a = np.flatnonzero(few[:-step] & (number[:-step] == number[step:]))
        b = a + step
        both = n[a] + n[b]
        need = (percent * both + 99 + percent) // (100 + percent)
        least = np.minimum(ell[a], ell[b]) - need
        ok = (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])) & (
            n[a] - pos[a] + least > 0) & (n[b] - pos[b] + least > 0)
        out[a[ok]] = out[b[ok]] = True
    return out


def postings(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int, percent: int,
             id_col: str = "doc_id", text_col: str = "text", draw: int = 0) -> DataFrame:
    """Rows (token, salts, sig, n, pos, ell, leads) of posted shingles that two classes of fitting
    sizes share at fitting places.

    Postings travel packed, one value for each task and bucket, with 48 bits of the shingle: two that
    agree in them only make more pairs to be verified. Frequent shingles are salted;
    ``leads`` are the first classes of the shingle and salt in LEADS of ORDERS pseudo-random
    orders, which the shingle chooses: shingles of one group of near copies agree on few leaders. A class
    keeps those whose sizes allow the similarity.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    @giving_back
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value
        held: list[np.ndarray] = []
        names: set[tuple[int, int]] = set()

        def packed() -> pa.RecordBatch:
            rows = np.concatenate(held)
            held.clear()
            bucket = mix(rows["token"] + salt_of(rows) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            own, first = np.unique(bucket, return_index=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)),
                 pa.array([to_planes(x) for x in np.split(rows, first[1:])], pa.binary())],
                names=["bucket", "rows"])

        for batch in batches:
            for part in slices(batch):
                for s in shingle_sets(part.column(1)):
                    sig = name_of(s, draw)
                    if not sig or sig in names:
                        continue
                    names.add(sig)
                    df = np.zeros(len(s), np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        df = np.where(known[at] == s, counts[at], 0)
                    tokens, df, ell = prefix(s, df, percent)
                    rows = np.empty(len(tokens), POSTING)
                    rows["token"], rows["pos"] = tokens >> np.uint64(16), np.arange(len(tokens))
                    rows["sig"] = np.int64(sig[0]).view(np.uint64)
                    rows["n"], rows["ell"] = len(s), ell
                    rows["salts"] = np.minimum(1 + df // SALT_ROWS, 65535)
                    held.append(rows)
                if sum(map(len, held)) > WINDOW // 8:
                    yield packed()
                    names.clear()
        if held:
            yield packed()

    def shared(group: pa.Table) -> pa.Table:
        rows = np.concatenate([from_planes(x.as_buffer()) for x in group.column("rows")])
        rows = rows[np.lexsort((rows["pos"], rows["sig"], salt_of(rows), rows["token"]))]
        salt, fresh = salt_of(rows), np.ones(len(rows), bool)  # the first of a shingle and salt
        fresh[1:] = (rows["token"][1:] != rows["token"][:-1]) | (salt[1:] != salt[:-1])
        again = np.zeros(len(rows), bool)  # a class that several tasks have posted
        again[1:] = ~fresh[1:] & (rows["sig"][1:] == rows["sig"][:-1]) & (rows["pos"][1:] == rows["pos"][:-1])
        rows, number = rows[~again], np.cumsum(fresh[~again])
        keep = (rows["salts"] > 1) | has_fitting(number, rows["n"].astype(np.int64), percent)
        rows, number = rows[keep], number[keep]
        n, pos, ell = (rows[c].astype(np.int64) for c in ("n", "pos", "ell"))
        keep = (rows["salts"] > 1) | has_match(number, n, pos, ell, percent)
        out, number = rows[keep], number[keep]
        start = np.flatnonzero(np.diff(number, prepend=0))
        size = np.diff(np.append(start, len(out)))

        def sig(x: np.ndarray) -> pa.Array:
            return pa.array(x["sig"].astype(np.int64))

        leads = []
        for j in range(LEADS):
            order = (out["token"] + np.uint64(j)) % np.uint64(ORDERS)
            rank = mix(out["sig"] ^ order * np.uint64(0x9E3779B97F4A7C15))
            leads.append(np.repeat(np.lexsort((rank, number))[start], size))
        leads, own, n = np.column_stack(leads), np.arange(len(out))[:, None], out["n"].astype(np.int64)
        fits = (100 * n[leads] >= percent * n[own]) & (100 * n[own] >= percent * n[leads])
        fits &= (leads != own) | (out["salts"] > 1)[:, None]  # of a salted shingle the leaders are looked for by name
        ends = pa.array(np.concatenate([[0], np.cumsum(fits.sum(axis=1))]).astype(np.int32))
        leads = leads[fits]
        return pa.table({
            "token": out["token"].astype(np.int64), "salts": out["salts"].astype(np.int32), "sig": sig(out),
            "n": out["n"], "pos": out["pos"], "ell": out["ell"].astype(np.int32),
            "leads": pa.ListArray.from_arrays(ends, sig(out[leads]))})

    return (
        docs.select(id_col, text_col).mapInArrow(post, "bucket int, rows binary")
        .groupBy("bucket").applyInArrow(
            shared, "token long, salts int, sig long, n int, pos int, ell int, leads array<long>")
    )


def _fits(a: str, b: str, percent: int):
    """The sizes allow the similarity."""
    return ((100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a)))


def _need(a: str, b: str, percent: int):
    """Shingles that sets of these sizes must share."""
    return F.expr(f"({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent}")


def _near(a: str, b: str, percent: int):
    """The bitmaps of classes with prefixes a and b allow the similarity."""
    apart = F.expr(" + ".join(f"bit_count({a}_{k} ^ {b}_{k})" for k in BITS))
    return apart <= F.col(f"{a}_n") + F.col(f"{b}_n") - 2 * _need(f"{a}_n", f"{b}_n", percent)


def _told_apart(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and wide bitmaps allow; those of 512 bits say little of long texts."""

    @F.pandas_udf("int")
    def apart(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([bits_apart(p, q) for p, q in zip(x, y)], dtype="int32")

    for end in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("sig").alias(end), F.col("n").alias(f"{end}_n"),
                                          F.col("wide").alias(f"{end}_wide")), end)
    return pairs.where(_fits("a_n", "b_n", percent)).where(
        apart("a_wide", "b_wide") <= F.col("a_n") + F.col("b_n") - 2 * _need("a_n", "b_n", percent)).drop(
        "a_n", "b_n", "a_wide", "b_wide")


def leader_pairs(posts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, count) of each class b and the leaders of its shingles that the bitmaps allow."""
    led = posts.where((F.col("salts") > 1) & F.array_contains("leads", F.col("sig")))
    top = led.groupBy("token").agg(F.min("sig").alias("a"))
    pairs = (
        posts.select(F.explode("leads").alias("a"), F.col("sig").alias("b"))
        .union(led.join(top, "token").select("a", F.col("sig").alias("b")))
        .where("a != b").groupBy("a", "b").count()
    )
    return _told_apart(pairs, classes, percent)


def star_pairs(pairs: DataFrame, roots: DataFrame | None, nearest: int) -> DataFrame:
    """Pairs (a, b) of each class with those leaders that lead most of its shingles.

    Only leaders in another component count. What is left out is for ``cross_pairs``, which misses none.
    """
    if roots is not None:
        for end in ("a", "b"):
            pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
        pairs = pairs.where("coalesce(a_root, a) != coalesce(b_root, b)").select("a", "b", "count")
    most = Window.partitionBy("b").orderBy(F.desc("count"), "a")
    return (
        pairs.withColumn("k", F.row_number().over(most)).where(F.col("k") <= nearest)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def cross_pairs(posts: DataFrame, classes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) whose ends are in different components.

    In each shingle the classes of its largest component meet only those of the others. A
    match counts if the shingles before it leave room for the overlap needed and the bitmaps
    do not exclude it.
    """
    own = (
        posts.select("token", "sig", "n", "pos", "ell")
        .join(roots.select(F.col("node").alias("sig"), "root"), "sig", "left")
        .withColumn("root", F.coalesce("root", "sig"))
    )
    mixed = (
        own.groupBy("token", "root").count()
        .groupBy("token").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("roots"))
        .where("roots > 1").select("token", "main")
    )
    own = stage(own.join(mixed, "token").join(classes.select("sig", *BITS), "sig"))
    parts = ("sig", "n", "pos", "ell", "root", *BITS)
    a = own.where("root != main").select("token", "main", *(F.col(c).alias(f"a_{c}") for c in parts))
    b = own.select("token", *(F.col(c).alias(f"b_{c}") for c in parts))
    ell, need = F.least("a_ell", "b_ell"), _need("a_n", "b_n", percent)
    met = a.join(b, "token").where(
        (F.col("a_root") != F.col("b_root"))
        & ((F.col("b_root") == F.col("main")) | (F.col("a_sig") < F.col("b_sig")))
        & _fits("a_n", "b_n", percent) & _near("a", "b", percent)
        & (F.col("a_n") - F.col("a_pos") + ell > need) & (F.col("b_n") - F.col("b_pos") + ell > need))
    pairs = (
        met.groupBy(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b"))
        .agg(F.count("*").alias("matches"), F.min(ell).alias("ell"))
        .where("matches >= ell").select("a", "b")
    )
    return _told_apart(stage(pairs), classes, percent)


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int,
             id_col: str = "doc_id", text_col: str = "text", draw: int = 0) -> DataFrame:
    """Those pairs whose shingle sets are as similar as asked.

    Only texts of classes in a pair are read into sets; a class takes the text of its least id
    (classes of rows without id are always read). The ids are staged, so that Spark plans by their size.
    """
    pairs = stage(pairs)
    ends = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    wanted = stage(classes.join(ends, "sig").select("sig", F.col("least").alias(id_col)))
    ids = stage(wanted.select(id_col).where(F.col(id_col).isNotNull()).distinct())
    texts = docs.select(id_col, text_col)

    @giving_back
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own = [s for s in shingle_sets(part.column(1)) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name_of(s, draw)[0] for s in own], pa.int64()),
                     pa.array([s.tobytes() for s in own], pa.binary())], names=["sig", "shingles"])

    read = texts.where(F.col(id_col).isNotNull()).join(ids, id_col, "left_semi").select(id_col, text_col)
    found = read.mapInArrow(sets, "sig long, shingles binary")
    if wanted.where(F.col(id_col).isNull()).limit(1).count():
        nameless = texts.where(F.col(id_col).isNull()).mapInArrow(sets, "sig long, shingles binary")
        found = found.union(nameless.join(wanted.select("sig"), "sig", "left_semi"))
    # Rows that repeat an id or have none may bring a set twice, or one that no pair has; the links are made distinct.
    found = stage(found)

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out, dtype=bool)

    return (
        pairs.join(found.select(F.col("sig").alias("a"), F.col("shingles").alias("x")), "a")
        .join(found.select(F.col("sig").alias("b"), F.col("shingles").alias("y")), "b")
        .where(similar("x", "y")).select("a", "b").distinct()
    )


def jaccard_components(docs: DataFrame, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row: the least id reachable by links.

    Two rows link when 100 * common >= percent * union of their shingle sets. Null and empty
    texts have no shingle and are linked with nothing. Rows that repeat an id are separate
    nodes: each gets the least id of what its own text reaches. A row without id takes part
    but gives its component no id; a component of such rows has a null one.
    """
    for draw in count():
        marks = stage(outline(docs, id_col, text_col, draw))
        classes = stage(marks.where("sig is not null and n > 0").groupBy("sig").agg(
            F.min("id").alias("least"), (F.min("more") != F.max("more")).alias("shared"),
            *(F.first(c).alias(c) for c in ("n", *BITS, "wide"))))
        if not classes.where("shared").limit(1).count():
            break
    rows = marks.where("sig is not null").select("id", "sig", "n")
    hot = hot_shingles(marks.where("token is not null").select("token", "seen"))
    total = rows.where("n > 0").agg(F.sum("n")).first()[0] or 0
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism * 4,
                  int(total * (100 - percent) / 100 / BUCKET_ROWS) + 1)
    posts = stage(postings(docs, hot, buckets, percent, id_col, text_col, draw))
    links, roots = None, None

    def grow(pairs: DataFrame) -> None:
        nonlocal links, roots
        more = stage(verified(docs, classes, pairs, percent, id_col, text_col, draw))
        if roots is None or not more.isEmpty():
            links = more if links is None else links.union(more)
            roots = connected_components(links)

    led = stage(leader_pairs(posts, classes, percent))
    for nearest in NEAREST:
        grow(star_pairs(led, roots, nearest))
    grow(cross_pairs(posts, classes, roots, percent))
    classes = (
        classes.select("sig", "least")
        .join(roots.select(F.col("node").alias("sig"), "root"), "sig", "left")
        .withColumn("root", F.coalesce("root", "sig"))
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    found = classes.join(least, "root").select("sig", "component_id")
    return (
        rows.where("n > 0").join(found, "sig")
        .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id")
        .union(rows.where("n = 0").select("id", F.lit(0).cast("long"), "id"))
    )


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row of the least id, with all its columns.

    Rows without id and rows without words stay. Rows that share the least id stay together. Of
    rows that share an id, only those whose own text is linked with a lesser id go. These are
    staged first, and only the text of rows that may be among them by a filter of ids can be moved.
    """
    mark = F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark")))
    marked = jaccard_components(docs.select(mark.alias("_own"), text_col), percent, "_own", text_col)
    gone = stage(marked.where(F.col("_own.id") != F.col("component_id.id")).select(
        F.col("_own.id").alias("_id"), F.col("_own.mark").alias("_mark")).distinct())
    may = may_be_in(gone, "_id")(F.col(id_col))
    held = docs.where(may)
    same = (held[id_col] == gone["_id"]) & (F.xxhash64(held[text_col]) == gone["_mark"])
    return docs.where(~may).union(held.join(gone, same, "left_anti"))
