"""URL filters by host and path prefix, as a sort-merge range join.

Hosts are keyed by their labels in reverse, each followed by a dot, so a host and all its
subdomains are one interval of keys that begin alike; paths are intervals already. Points and
interval starts are sorted together over ranges of the key. The sweep keeps the stack of nested
intervals begun so far; at a point those are active that the point's key begins with, the others
have ended. It is made twice: for hosts, then for paths within each host that was active.

Only DataFrame functions. Ranges are cut by key and row, so a host of a third of all rows is
spread; what a range needs from those before it is one start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from newsloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_key(host):
    """Labels in reverse order, each followed by a dot: a.example.net to net.example.a."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table; hosts are written without a leading dot."""
    rows = [F.struct(*(F.lit(v).alias(c) for c, v in zip(("verdict", "host", "path"), r))) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def nested(starts: DataFrame) -> DataFrame:
    """(key, stack): for each distinct start the starts that its key begins with, itself
    included, shortest first. As many as keys that are beginnings of one another."""
    own = starts.select("key").distinct()
    heads = own.select("key", F.explode(F.expr("sequence(0, length(key))")).alias("n")).select(
        "key", F.expr("substring(key, 1, n)").alias("head"))
    return heads.join(own.select(F.col("key").alias("head")), "head").groupBy("key").agg(
        F.expr("array_sort(collect_list(head), (a, b) -> length(a) - length(b))").alias("stack"))


def sweep(points: DataFrame, starts: DataFrame) -> DataFrame:
    """Points (key, row, ...) with ``active``: the starts whose interval they lie in, shortest first.

    The last start at or before a point is the point's innermost interval or lies in one that
    ended with it; either way its stack has every interval that is still open at the point.
    """
    names = [c for c in points.columns if c not in ("key", "row")]
    both = points.select("key", "row", F.lit(None).cast("array<string>").alias("stack"),
                         F.struct(*names).alias("kept")).unionByName(
        nested(starts).select("key", F.lit(None).cast("long").alias("row"), "stack"), allowMissingColumns=True)
    # Nulls sort first: a start comes before the points at its key.
    ranged = stage(both.repartitionByRange("key", "row").withColumn("range", F.spark_partition_id()))
    last = F.last("stack", ignorenulls=True)
    before = (
        ranged.where("stack is not null").groupBy("range").agg(F.max_by("stack", "key").alias("top"))
    )
    ranges = ranged.select("range").distinct().join(before, "range", "left")
    carried = ranges.select("range", F.last("top", ignorenulls=True).over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    inside = Window.partitionBy("range").orderBy("key", F.col("row").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("top", last.over(inside)).where("stack is null").join(carried, "range")
        .withColumn("top", F.coalesce("top", "carried", F.array().cast("array<string>")))
        .select("key", "row", "kept.*", F.expr("filter(top, s -> startswith(key, s))").alias("active"))
    )


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
           url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    The host stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    the path goes on to ``?``, ``#`` or the end; both are empty for a null url or one without
    ``://``. A rule fits its host and the subdomains if the path begins with its path. Of rules
    that fit the one with the longest host and path together wins, then the longer host, then
    ``block``. Without a rule the verdict is ``default``.
    """
    parts = "(?s)://([^/?#]*)([^?#]*)"
    rows = stage(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.coalesce(F.translate(F.regexp_extract(url_col, parts, 1), UPPER, LOWER), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(url_col, parts, 2), F.lit("")).alias("path")))
    rules = rules.select("verdict", "host", "path").distinct().withColumn("host_key", host_key(F.col("host")))
    hosts = sweep(rows.select(host_key(F.col("host")).alias("key"), "row", "path"),
                  rules.select(F.col("host_key").alias("key")))
    points = hosts.select(F.explode("active").alias("host_key"), "row", "path")
    # A tab ends the host: no host or path of a rule that fits has one before it.
    found = sweep(points.select(F.concat("host_key", F.lit("\t"), "path").alias("key"), "row", "host_key"),
                  rules.select(F.concat("host_key", F.lit("\t"), "path").alias("key")))
    inner = found.where(F.size("active") > 0).select("row", F.try_element_at("active", F.lit(-1)).alias("key"))
    order = F.struct(F.length("rule"), F.length("host"), F.col("verdict") == "block")
    named = rules.select(
        F.concat("host_key", F.lit("\t"), "path").alias("key"), F.concat("host", "path").alias("rule"), "host", "verdict")
    best = inner.join(named, "key").groupBy("row").agg(
        F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    return rows.join(best, "row", "left").select(
        F.col("id").alias(id_col), "host", "path", "best.rule",
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
