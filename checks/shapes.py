"""Given tables in the shapes the operators take.

Each text is plain SQL that Spark and DuckDB both run, so that an operator and its SQL
twin start from the same rows. Nothing here belongs to the product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.config import MARKETS
from newsloom.sources.news_json import item_is_bad, with_judgement

ZWSP = "​"

# The market of a page, by its number.
MARKET = f"split_part('{','.join(MARKETS)}', ',', cast(page_id % {len(MARKETS)} as int) + 1)"

_DAY0 = "timestamp '2024-01-01 00:00:00+00:00'"

# A stored article per page; lists are added per engine (see `articles`).
ARTICLES = f"""
select page_id, page_id as arrival, mkt, url, title,
       concat('EN ', title) as title_translated,
       concat('About ', title) as description,
       concat('EN About ', title) as description_translated,
       {_DAY0} + (page_id % 90) * interval '7' hour as date_published,
       provider,
       case when page_id % 2 = 0 then split_part(mkt, '-', 1) end as language,
       concat('Text of ', url) as content,
       split_part(mkt, '-', 2) as origin_country,
       'TestSource' as source_api, '1.1' as schema_version,
       {_DAY0} + (page_id % 90) * interval '7' hour + interval '24' hour as date_scraped,
       split_part('politics,sports,science,culture', ',', cast(page_id % 4 as int) + 1)
           as category,
       case when page_id % 3 = 1 then concat('https://img.example.com/', cast(page_id as string))
            when page_id % 3 = 2 then '' end as image_url,
       page_id % 3 = 0 as post_processed, page_id % 10 = 0 as is_stored
from (select page_id, url, {MARKET} as mkt,
             regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
             regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) as provider
      from pages)
"""

# One news-API article object per page, its fields side by side; a response holds twenty.
# Every 50th lacks its description, and every 53rd has an empty provider list; both are bad
# items.
RAW_ITEMS = f"""
select page_id, mkt,
       concat(mkt, '/', cast(cast(floor(page_id / {20 * len(MARKETS)}) as int) as string))
           as response,
       cast(floor(page_id / {len(MARKETS)}) as int) as pos,
       case when page_id % 19 <> 0 then title end as name,
       url,
       case when page_id % 50 <> 7 then concat('About ', title) end as description,
       concat('2024-01-', lpad(cast(1 + page_id % 28 as string), 2, '0'),
              case page_id % 3 when 0 then 'T10:00:00.1234567Z' when 1 then 'T10:00:00+02:00'
                   else 'T23:30:00' end) as date_text,
       case when page_id % 53 = 11 then 'empty' when page_id % 11 = 0 then 'none'
            when page_id % 11 = 1 then 'unnamed' else 'named' end as provider_kind,
       provider as provider_name,
       case page_id % 3 when 0 then concat('https://img.example.com/th?id=',
                                           cast(page_id as string), '&pid=News&w=100')
            when 1 then '&x' end as image_text
from ({ARTICLES})
"""

REQUEST_LOG = """
select event_id,
       case event_type when 'click' then 'basic_request' when 'view' then 'postman_request'
            when 'purchase' then 'playwright_request'
            when 'signup' then 'custom_www.msn.com_request'
            else 'all_methods_failed' end as method,
       cast(case when event_type = 'error'
                 then (case event_id % 3 when 0 then 403 when 1 then 408 else 500 end)
                 when event_type = 'signup' and event_id % 4 = 0 then 408
                 else 200 end as int) as status
from events
"""

# Up to four attempts per URL; one host in twenty has a fetcher of its own.
ATTEMPTS = """
select concat('https://', case when user_id % 20 = 7 then 'www.msn.com'
                               else concat('h', cast(user_id % 20 as string), '.example.com') end,
              '/a/', cast(event_id % 1500 as string)) as url,
       case event_id % 3 when 0 then 'basic' when 1 then 'postman' else 'playwright' end as method,
       cast(event_id % 3 as int) as step,
       cast(case when event_id % 5 = 0 then 200 when event_id % 7 = 0 then 403
                 else 500 end as int) as status
from events
"""

BUILD_LOG = f"""
select page_id, url, {MARKET} as mkt,
       case when page_id % 10 = 0 then 'already_exists' when page_id % 10 = 1 then 'no_content'
            when page_id % 10 = 2 then 'extract_failed' when page_id % 10 = 3 then 'invalid_content'
            when page_id % 10 = 4 then 'lang_unknown' else 'built' end as outcome
from pages
"""

# Documents with markup, quotes and invisible characters put in.
DIRTY = f"""
select doc_id,
       case doc_id % 8
         when 0 then concat(text, ' <script>track("x")</script> $where tail')
         when 1 then concat('It''s ', text, ' don''t')
         when 2 then concat('"q" ', text, chr(13), chr(10), chr(10), 'end')
         when 3 then concat('<iframe src=x>y</iframe><b>', text, '</b> & more')
         when 4 then concat('$<b>foo ', text)
         when 5 then concat(substr(text, 1, 10), '{ZWSP}', 'zero', substr(text, 11))
         else text end as text
from documents
"""

# Pages that carry the metadata the given ones lack, and some without a language.
META_PAGES = """
select page_id, url,
       case page_id % 6
         when 0 then replace(html, '<head>', '<head><meta name="keywords" content="alpha, beta  gamma">')
         when 1 then replace(html, '<head>', '<head><meta content="Ann Lee" name="author"><meta name="author" content="Bo Ek">')
         when 2 then replace(html, '<head>', '<head><meta property="og:image" content="https://img.example.com/top.jpg">')
         when 3 then replace(html, '<html lang="', '<html data-lang="')
         when 4 then replace(html, '<html lang="', '<html lang="QQ-')
         else html end as html
from pages
"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make the named tables visible to the texts above."""
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def shaped(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    tables(spark, sf_dir, "pages", "documents", "events")
    return spark.sql(text)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`ARTICLES` with the three lists of an article."""
    return shaped(spark, sf_dir, ARTICLES).withColumns({
        "keywords": F.array(F.lit("news"), F.col("category")),
        "authors": F.array(F.col("provider")),
        "related_countries": F.array(F.col("origin_country"), F.lit("GB")),
    })


def raw_items(spark: SparkSession, sf_dir: str, text: str = RAW_ITEMS) -> DataFrame:
    """`RAW_ITEMS` as the article objects a response holds."""
    named = F.array(F.struct(F.col("provider_name").alias("name")))
    unnamed = F.array(F.struct(F.lit(None).cast("string").alias("name")))
    item = F.struct(
        "name", "url", "description", F.col("date_text").alias("datePublished"),
        F.when(F.col("provider_kind") == "named", named)
        .when(F.col("provider_kind") == "unnamed", unnamed)
        .when(F.col("provider_kind") == "empty", F.slice(named, 1, 0)).alias("provider"),
        F.struct(F.struct(F.col("image_text").alias("contentUrl")).alias("thumbnail"))
        .alias("image"),
    )
    raw = shaped(spark, sf_dir, text).select("mkt", "response", "pos", item.alias("item"))
    failed = F.max(item_is_bad(F.col("item"))).over(Window.partitionBy("response"))
    return raw.select("mkt", "response", failed.alias("failed"), "pos", "item")


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as responses, of at most 20 items each."""
    raw = raw_items(spark, sf_dir)
    rows = raw.groupBy("mkt", "response").agg(
        F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("rows"))
    return with_judgement(rows.select(
        "mkt", "response", F.col("rows.item").alias("value"), F.lit(False).alias("corrupt")))
