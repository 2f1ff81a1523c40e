"""Small scalar rules: defaults, timestamps, market codes, percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.split() and str.strip() treat as white space.
WS = r"[\s\x1c-\x1f]"
WS_CHARS = "".join(filter(str.isspace, map(chr, range(0x3001))))

# ISO-8601 in extended form: a date, then optionally a time and an offset.
_ISO = (r"^\d{4}-\d{2}-\d{2}"
        r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([Zz]|[+-]\d{2}(:?\d{2})?)?)?$")


def market_language(mkt: Column) -> Column:
    return F.split_part(mkt, F.lit("-"), F.lit(1))


def market_country(mkt: Column) -> Column:
    return F.split_part(mkt, F.lit("-"), F.lit(2))


def default_string(c: Column, value: str = "") -> Column:
    return F.coalesce(c, F.lit(value))


def provider_name(providers: Column) -> Column:
    """Name of the first provider; ``MSN`` where there is none."""
    return F.coalesce(F.get(providers, F.lit(0))["name"], F.lit("MSN"))


def parse_iso_ts(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, null where it is not one.

    Fractions beyond microseconds are cut; texts without an offset are UTC.
    """
    rest = F.translate(F.substring(text, F.lit(11), F.length(text)), ",z", ".Z")
    time = F.regexp_extract(rest, r"^[T ]([\d:.]+)", 1)
    zone = F.regexp_extract(rest, r"(Z|[+-][\d:]+)$", 1)
    # Spark wants all three parts of the time, and a colon and minutes in the offset.
    full_time = (
        F.when(F.length(time) == 0, "00:00:00")
        .when(F.length(time) == 2, F.concat(time, F.lit(":00:00")))
        .when(F.length(time) == 5, F.concat(time, F.lit(":00")))
        .otherwise(time)
    )
    full_zone = (
        F.when(F.length(zone) == 0, "Z")
        .when(F.length(zone) == 3, F.concat(zone, F.lit(":00")))
        .when(F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"),
                                            F.substring(zone, 4, 2)))
        .otherwise(zone)
    )
    whole = F.concat(F.substring(text, 1, 10), F.lit("T"), full_time, full_zone)
    return F.when(text.rlike(_ISO), F.try_to_timestamp(whole))


def falsy_coalesce(a: Column, b: Column) -> Column:
    """``a`` unless it is null or empty, else ``b``."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def utc_day(ts: Column) -> Column:
    """``yyyy-MM-dd`` in UTC, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days).cast("string")


def utc_date(ts: Column) -> Column:
    days = F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days)


def collapse_ws(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"(?U){WS}+", " "))


def split_keywords(c: Column) -> Column:
    """Split at white space; an empty array for null or blank text."""
    flat = collapse_ws(F.coalesce(c, F.lit("")))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def is_code(c: Column, codes: list[str] | tuple[str, ...]) -> Column:
    """Whether ``c`` is one of the (comma-free) codes; the list is one literal."""
    return F.find_in_set(c, F.lit(",".join(codes))) > 0


def lang_code(c: Column, known: list[str] | tuple[str, ...]) -> Column:
    """Lower-cased two-letter language code, null where it is not a known one."""
    low = F.lower(c)
    return F.when(is_code(low, known), low)


def percent_text(rate: Column, none: str | None = None) -> Column:
    """``0.3333`` as ``33.33%``; null (or ``none``) where there is no rate, where it is
    negative, and from 1,300 on, which no share or ratio here can be.

    Rounds the exact binary value half to even, as C's printf does. The value is
    scaled by a power of two large enough to make it whole, so that the rounding is
    integer arithmetic.
    """
    sane = F.when((rate >= 0) & (rate < 1300), rate.cast("double"))
    pct = sane * F.lit(100.0)
    bits = F.when(pct < 0.125, F.lit(60)).when(pct < 100.5, F.lit(56)).otherwise(F.lit(46))
    one = F.pow(F.lit(2.0), bits).cast("bigint").cast("decimal(20,0)")
    whole = (pct * F.pow(F.lit(2.0), bits)).cast("bigint").cast("decimal(20,0)")
    top = whole * F.lit(200).cast("decimal(3,0)") + one
    low = one * F.lit(2).cast("decimal(1,0)")
    left = top % low
    near = ((top - left) / low).cast("bigint")
    cents = F.when((left == 0) & (near % 2 == 1), near - 1).otherwise(near)
    text = F.concat(
        F.floor(cents / F.lit(100)).cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"), F.lit("%"),
    )
    return text if none is None else F.coalesce(text, F.lit(none))
