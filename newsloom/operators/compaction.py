"""Merging the small commits of a table, so that a day has few files however many loads it came in.

Commits of a part are sorted into tiers by size, each FANOUT times the one before. A tier that has
FANOUT commits is merged, with all that is smaller, into one; rows of loads that were replaced go. So
a part has at most FANOUT - 1 commits in each tier, and tiers grow with the logarithm of its size. A
merged commit keeps the name of the load of every row, and the manifest its list of loads, so that a
load can still be done again.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from newsloom.operators import commits as C
from newsloom.operators.bucketed import write_bucketed
from newsloom.operators.key_index import cut
from newsloom.operators.store import laid_out
from newsloom.operators.summary import URLS, write_by_day
from newsloom.session import file_system
from newsloom.sources.page_store import STORED_PAGE
from newsloom.sources.tables import STORED

# Of the other parts the files say it.
SCHEMAS = {C.ARTICLES: STORED, C.PAGES: T.StructType([*STORED_PAGE.fields, T.StructField("load_id", T.StringType())])}
FANOUT = 8
LEAST_BYTES = 16 << 20  # the first tier ends here


def tier(size: int, fanout: int) -> int:
    number, end = 0, LEAST_BYTES
    while size >= end:
        number, end = number + 1, end * fanout
    return number


def to_merge(sizes: dict[C.Part, int], fanout: int) -> list[C.Part]:
    """The parts of the highest full tier and below it; a part with replaced rows is merged in any case."""
    tiers: dict[int, list[C.Part]] = {}
    for part, size in sizes.items():
        tiers.setdefault(tier(size, fanout), []).append(part)
    full = max((t for t, parts in tiers.items() if len(parts) >= fanout), default=-1)
    return [p for p in sizes if p.masked or tier(sizes[p], fanout) <= full]


def _rewritten(rows: DataFrame, name: str, folder: str, buckets: int) -> tuple[str, ...]:
    """Write merged rows the way their part is laid out, and return its cells."""
    if name == C.ARTICLES:
        laid_out(rows).write.partitionBy("pub_date").parquet(folder)
    elif name == C.KEYS:
        return cut(rows, folder, buckets)
    elif name == C.PAGES:
        return write_bucketed(rows, folder, "crawl_day", "url", buckets)
    elif name == URLS:
        return write_by_day(rows, folder)
    else:
        rows.hint("rebalance").write.parquet(folder)
    return ()


def _onto(now: C.Manifest, name: str, old: list[C.Part], made: C.Part) -> C.Manifest:
    """A manifest with ``made`` in place of ``old``.

    Of the merged loads those count that still come from the merged commits: one that was done again
    meanwhile, or merged by somebody else, is not in them any more.
    """
    merged = {p.commit for p in old}
    still = {load for p in now.of(name) if p.commit in merged for load in p.live()}
    made = made.without(set(made.loads) - still)
    kept = tuple(p for p in now.of(name) if p.commit not in merged)
    return replace(now, version=now.version + 1,
                   parts={**now.parts, name: (*kept, made) if made.live() else kept})


def compact(spark: SparkSession, path: str, fanout: int = FANOUT) -> list[str]:
    """Merge what is to be merged in every part of the table at ``path``; returns those parts.

    Readers keep seeing the same rows. Loads may be written meanwhile: they do not rely on how the
    rows before them are cut, and a merge does not rely on what comes after what it read.
    """
    done = []
    for name in C.manifest(spark, path).parts:
        seen = C.manifest(spark, path)
        base = C.part_folder(path, name)
        sizes = {}
        for p in seen.of(name):
            fs, at = file_system(spark, f"{base}/commit={p.commit}")
            sizes[p] = fs.getContentSummary(at).getLength()
        old = to_merge(sizes, fanout)
        if not old or (len(old) == 1 and not old[0].masked):
            continue
        only = replace(seen, parts={name: tuple(old)})
        rows = C.read_part(spark, path, name, SCHEMAS.get(name), only)
        loads = tuple(sorted({load for p in old for load in p.live()}))
        new = C.new_commit("merged")
        made = C.Part(new, loads, cells=_rewritten(rows, name, f"{base}/commit={new}", seen.buckets))
        while not C.publish(spark, path, _onto(C.manifest(spark, path), name, old, made)):
            pass
        done.append(name)
    return done


def maintain(spark: SparkSession, path: str, fanout: int = FANOUT) -> list[str]:
    """Merge small commits and delete the folders that no reader follows any more; while no load runs."""
    compact(spark, path, fanout)
    seen = C.manifest(spark, path)
    return C.vacuum(spark, path, [*seen.parts, *([C.COUNTRIES] if seen.days else [])])
