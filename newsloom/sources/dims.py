"""Code lists, taken from the JVM's own ISO tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.config import MARKETS
from newsloom.functions.scalars import is_code, market_country, market_language

# Withdrawn language codes the JVM still lists.
_WITHDRAWN = ("bh", "in", "iw", "ji", "mo")


def iso_countries(spark: SparkSession) -> tuple[str, ...]:
    """ISO 3166-1 alpha-2 codes (about 250)."""
    return tuple(sorted(spark._jvm.java.util.Locale.getISOCountries()))


def iso_languages(spark: SparkSession) -> tuple[str, ...]:
    """ISO 639-1 codes (about 180)."""
    codes = spark._jvm.java.util.Locale.getISOLanguages()
    return tuple(sorted(c for c in codes if len(c) == 2 and c not in _WITHDRAWN))


def market_dim(spark: SparkSession, markets: tuple[str, ...] = MARKETS) -> DataFrame:
    """Markets as (ord, mkt, lang, country), in run order; unknown codes are left out."""
    listed = spark.range(1).select(F.posexplode(F.array(*map(F.lit, markets))).alias("ord", "mkt"))
    lang, country = market_language(F.col("mkt")), market_country(F.col("mkt"))
    return (
        listed.select("ord", "mkt", lang.alias("lang"), country.alias("country"))
        .where(is_code(F.col("lang"), iso_languages(spark))
               & is_code(F.col("country"), iso_countries(spark)))
    )
