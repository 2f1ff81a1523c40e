"""The article contract: each rule is a Boolean column, true where the row is good."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.scalars import is_code
from newsloom.functions.text import BLOCKED, TRIGGER, occurs
from newsloom.schemas import ARTICLE, REQUIRED

_HTTP = r"^https?://\S+$"
_ALPHA2_LOWER = "^[a-z]{2}$"
_ALPHA2_UPPER = "^[A-Z]{2}$"


def strings_where(*rules: tuple[Column, Column]) -> Column:
    """Array of the texts whose condition holds, in the order given."""
    none = F.array().cast("array<string>")
    return F.concat(*(F.when(cond, F.array(text)).otherwise(none) for cond, text in rules))


def missing_fields(names: tuple[str, ...] = REQUIRED) -> Column:
    """Names of the required fields that are null."""
    return strings_where(*((F.col(n).isNull(), F.lit(n)) for n in names))


def required_ok(names: tuple[str, ...] = REQUIRED) -> Column:
    return reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in names))


def url_ok(url: Column) -> Column:
    return F.coalesce(url.rlike(_HTTP), F.lit(False))


def language_ok(language: Column) -> Column:
    return F.coalesce(language.rlike(_ALPHA2_LOWER), F.lit(True))


def country_ok(country: Column) -> Column:
    return F.coalesce(country.rlike(_ALPHA2_UPPER), F.lit(False))


def related_ok(countries: Column) -> Column:
    """Null, or every item is a two-letter code."""
    return F.coalesce(
        F.forall(countries, lambda x: F.coalesce(x.rlike(_ALPHA2_UPPER), F.lit(False))),
        F.lit(True),
    )


def image_ok(image_url: Column) -> Column:
    return F.coalesce(image_url.rlike(_HTTP), F.lit(True))


def member_of(code: Column, codes: tuple[str, ...]) -> Column:
    """True where ``code`` is one of the (fixed) codes; false for null."""
    return F.coalesce(is_code(code, codes), F.lit(False))


def with_contract_issues(df: DataFrame, names: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Add ``contract_issues``: one text per broken rule, empty for a good row."""
    return df.withColumn("contract_issues", F.concat(
        F.transform(missing_fields(names), lambda n: F.concat(F.lit("missing "), n)),
        strings_where(
            (F.col("url").isNotNull() & ~url_ok(F.col("url")), F.lit("bad url")),
            (~language_ok(F.col("language")), F.lit("bad language")),
            (F.col("origin_country").isNotNull() & ~country_ok(F.col("origin_country")),
             F.lit("bad origin_country")),
            (~related_ok(F.col("related_countries")), F.lit("bad related_countries")),
            (~image_ok(F.col("image_url")), F.lit("bad image_url")),
        ),
    ))


def conform(raw: Column, schema: T.StructType = ARTICLE) -> Column:
    """Parse a JSON document under the fixed types.

    The result has a ``_corrupt_record`` field, null unless a value has a wrong type.
    """
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return F.from_json(raw, loose.add("_corrupt_record", T.StringType(), True),
                       {"mode": "PERMISSIVE"})


# The texts of the issues below are part of the stored and reported contract.

def length_issue(content: Column, low: int, high: int) -> Column:
    """The one length issue of a content, or null. Both bounds are allowed lengths."""
    size = F.length(content)
    return (
        F.when(size > high,
               F.lit(f"Content exceeds maximum length of {high} characters"))
        .when(size < low,
              F.lit(f"Content does not meet minimum length of {low} characters"))
    )


def unsafe_issues(content: Column) -> Column:
    """One text per blocked pattern that still occurs."""
    return strings_where(*(
        (content.contains(TRIGGER[p]) & occurs(content, p),
         F.lit(f"Content contains potentially unsafe pattern: {p}"))
        for p in BLOCKED
    ))


def content_issues(content: Column, low: int, high: int) -> Column:
    """Every issue of a content; it is valid if there is none."""
    length = length_issue(content, low, high)
    return F.concat(strings_where((length.isNotNull(), length)), unsafe_issues(content))
