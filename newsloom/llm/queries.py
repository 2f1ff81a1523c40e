"""The operators as registered queries on the given tables, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from newsloom.llm.byte_bpe import round_trip
from newsloom.llm.exact_dedup import exact_dedup
from newsloom.llm.filter_audit import filter_audit
from newsloom.llm.jaccard_join import jaccard_components
from newsloom.llm.language_id import language_id
from newsloom.llm.mixing import mixed
from newsloom.llm.quality_classifier import quality_scores
from newsloom.llm.quality_rules import quality_rules
from newsloom.llm.spelling import spelling_variants
from newsloom.llm.texts import table
from newsloom.llm.token_counts import token_counts
from newsloom.llm.tool_calls import linked
from newsloom.llm.toxicity import toxicity
from newsloom.llm.url_filter import judged, rule_table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]
TOOLS = {
    "lookup": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1},
                              "after": {"type": "object", "required": ["$ref"]}}},
    "note": {"type": "object", "required": ["text"], "properties": {
        "text": {"type": "string"}, "level": {"type": "string", "enum": ["low", "high"]},
        "after": {"type": "object", "required": ["$ref"]}}},
}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), fraction=None)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as tool use: an assistant's turn is a call whose arguments hold its whole
    text, the user's turn after it is the call's result. From the third turn on a call mentions
    the one two turns before. Turns divisible by three are notes, the others lookups."""
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    turn, is_note = F.col("turn"), F.col("turn") % 3 == 0
    after = F.when(turn >= 3, F.struct(name(turn - 2).alias("$ref")))
    size = F.length("text")
    arguments = F.when(is_note, F.to_json(F.struct(
        F.col("text"), F.when(size > 900, "high").when(size > 300, "low").otherwise("none").alias("level"), after.alias("after"),
    ))).otherwise(F.to_json(F.struct(F.col("text").alias("query"), (size - 200).alias("limit"), after.alias("after"))))
    call = F.struct(name(turn).alias("id"), F.when(is_note, "note").otherwise("lookup").alias("name"),
                    arguments.alias("arguments"))
    return conversations.select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", F.array(call)).alias("calls"),
        F.when((F.col("role") == "user") & (turn > 0), name(turn - 1)).alias("result_of"), "text")


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(tool_messages(table(spark, sf_dir, "conversations")), TOOLS, plain=True)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_mixing, op2_toxicity, op3_exact_dedup, op4_url_filter, op5_tool_calls, op6_byte_bpe, op7_language_id,
    op8_quality_classifier, op9_quality_rules, op10_jaccard_join, op11_spelling_variants, op12_filter_audit, op13_token_counts)} | {"pipeline": corpus_pipeline.run}

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
ORACLES: dict[str, str] = {
    "op3_exact_dedup": r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h
  from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by h) as group_size,
       doc_id = first_value(doc_id) over w as kept, h as text_sha256
from d window w as (partition by h order by n desc, doc_id)
""",
    "op4_url_filter": rf"""
with r(verdict, h, p) as (values {_RULES}),
u as (
  select page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
m as (
  select u.page_id, r.h || r.p as rule, r.verdict,
         row_number() over (partition by u.page_id order by length(r.h || r.p) desc) as k
  from u join r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p))
select u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') as verdict
from u left join m on m.page_id = u.page_id and m.k = 1
""",
    "op10_jaccard_join": r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g
  from w where len(ws) > 0),
n as (select doc_id, count(*) as n from s group by all),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
  group by all),
edges as (
  select x, y from common join n p on p.doc_id = x join n q on q.doc_id = y
  where 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) as (
  select doc_id, doc_id from documents union select reach.x, edges.y from reach join edges on edges.x = reach.y)
select d.doc_id, coalesce(n.n, 0) as n_shingles, (select min(y) from reach where reach.x = d.doc_id) as component_id
from documents d left join n on n.doc_id = d.doc_id
""",
    # The checksum goes over the bytes by half bytes, the low one first, with a table for 16 values.
    "op11_spelling_variants": r"""
with recursive runs as (
  select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as r
  from documents),
c as (select id, r, hex(encode(id || ':' || r)) as x, count(*) as n from runs where length(r) >= 7 group by all),
t(t) as (values ([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384,
  4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::bigint[])),
h as (
  select r, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(x)),
           lambda i: strpos('0123456789ABCDEF', substr(x, case when i % 2 = 0 then i + 2 else i end, 1)) - 1)),
           lambda a, b: xor(a >> 4, t.t[(xor(a, b) & 15) + 1]))) as h
  from c cross join t),
w as (
  select case when h % 31 = 0 then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) else r end as word, n
  from h),
v as (select word, cast(sum(n) as bigint) as n from w where length(word) >= 7 group by word having sum(n) >= 2),
x as (select word, n, unnest(range(1, length(word) + 1)) as i from v),
z as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as part from x),
pairs as (
  select a.word, b.word as other, b.n from z a join z b on a.part = b.part and a.i = b.i where a.word <> b.word
  union select z.word, v.word, v.n from z join v on v.word = z.part
  union select v.word, z.word, z.n from z join v on v.word = z.part),
best as (
  select word, other, n, count(*) over (partition by word) as n_near,
         row_number() over (partition by word order by n desc, other) as k
  from pairs),
f as (
  select v.word, v.n, coalesce(b.n_near, 0) as n_near, case when b.n >= 10 * v.n then b.other end as form,
         case when b.n >= 10 * v.n then b.n end as form_n
  from v left join best b on b.word = v.word and b.k = 1),
up(word, root, steps) as (
  select word, word, 0 from f union all select up.word, f.form, up.steps + 1 from up join f on f.word = up.root where f.form is not null),
last as (select word, root, row_number() over (partition by word order by steps desc) as k from up)
select f.word, f.form, last.root, f.n, f.n_near, f.form_n from f join last on last.word = f.word and last.k = 1
""",
    "op12_filter_audit": r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
         min(doc_id) over (partition by coalesce(text, '')) as least
  from documents),
m as (
  select doc_id, part,
         case when len(ws) < 50 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end
         || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
         || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end || case when least < doc_id then 'E' else '' end as fails
  from d),
c as (
  select part, fails, coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic, count(*) as n
  from m left join labels l on l.doc_id = m.doc_id group by all),
f(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from f a join f b on b.x <> a.x join f c on c.x not in (a.x, b.x) join f d on d.x not in (a.x, b.x, c.x)
  join f e on e.x not in (a.x, b.x, c.x, d.x)),
s as (select filter_order, unnest(range(1, 6)) as step from o),
r as (
  select c.part, s.filter_order, s.step, substr(s.filter_order, s.step, 1) as own, c.n, c.good, c.toxic,
         length(c.fails) as n_fails, contains(c.fails, substr(s.filter_order, s.step, 1)) as here,
         length(translate(substr(s.filter_order, 1, s.step - 1), c.fails, '')) < s.step - 1 as before
  from c cross join s),
g as (
  select part, filter_order, step, own,
         sum(case when not here and not before then n else 0 end) as kept,
         sum(case when here and not before then n else 0 end) as removed,
         sum(case when here and before then n else 0 end) as redundant,
         sum(case when here and n_fails = 1 then n else 0 end) as unique_fails,
         sum(case when here and not before and good then n else 0 end) as good_lost,
         sum(case when here and not before and toxic then n else 0 end) as toxic_lost
  from r group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) over (partition by part, own) as shapley
from g
""",
}
