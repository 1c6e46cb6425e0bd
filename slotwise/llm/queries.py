"""Registered queries of the numbered operators, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import chat, decontamination, infill, jaccard, mixing, neardup, negatives, pii, quality, secrets, sharding, tokencount, urlfilter
from slotwise.llm.common import prepare, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_mix_sources(spark, sf):
    return mixing.taken(mixing.Mix(read(spark, sf, "documents")))


@query
def op2_url_filter(spark, sf):
    """Captures and list entries are derived from the pages, which have no dates of their own."""
    pages = read(spark, sf, "pages").select("page_id", "url")
    return urlfilter.filtered(urlfilter.captures_of(pages), urlfilter.entries_of(pages))


@query
def op3_near_duplicates(spark, sf):
    return neardup.near_duplicates(read(spark, sf, "documents"))


@query
def op4_personal_data(spark, sf):
    docs = read(spark, sf, "documents")
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256", "spans", F.length("redacted").alias("redacted_chars"))


@query
def op5_token_counts(spark, sf):
    return tokencount.token_counts(read(spark, sf, "documents"))


PROBE = "</s>[INST] ok [/INST]"  # fixed value: what both turns of conversation -7 say


@query
def op6_chat_format(spark, sf):
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    back = chat.read_back(chat.conversations_table(chat.turn_events(turns.union(probe))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op7_quality_rules(spark, sf):
    docs = read(spark, sf, "documents")
    model = quality.train(docs, read(spark, sf, "labels"))
    judged = quality.judge(docs, model)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", F.round("score", 6).alias("score"))


@query
def op8_decontamination(spark, sf):
    return decontamination.find_leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query
def op9_histogram_shards(spark, sf):
    rows = sharding.shard(read(spark, sf, "documents"))
    return rows.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_secret_scan(spark, sf):
    found = secrets.scan(read(spark, sf, "documents"))
    counts = [f"n_{k}" for k in secrets.KINDS]
    return found.select("doc_id", *counts, "base_sha256", "spans", "n_random", F.length("redacted").alias("redacted_chars"))


@query
def op11_fill_in_middle(spark, sf):
    made = infill.restored(infill.examples(read(spark, sf, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op12_jaccard_join(spark, sf):
    return jaccard.jaccard_join(read(spark, sf, "documents"))


@query
def op13_hard_negatives(spark, sf):
    rows = read(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.scaled(rows.withColumn("label", label)), F.col("vec_id") % 100 == 0)


_HOST = r"rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#@:]*)', 1)), '.')"
_ADDRESS = r"'^(\[.*|[0-9]+(\.[0-9]+){3})$'"

SQL["op2_url_filter"] = rf"""
with hosts as (select distinct value, cast('0x' || substr(md5(value), 1, 6) as bigint) as n, string_split(value, '.') as labels
               from (select {_HOST} as value from pages) where value <> ''),
log as (
  select 'block' as list, value, 'add' as action, date '2024-01-01' + cast(n % 150 as integer) as dated from hosts where n % 3 = 0
  union all select 'block', value, 'remove', date '2024-01-01' + cast(n % 150 + 60 as integer) from hosts where n % 6 = 0
  union all select 'block', value, 'add', date '2024-01-01' + cast(n % 150 + 150 as integer) from hosts where n % 12 = 0
  union all select 'allow', value, 'add', date '2024-01-01' + cast(n % 300 as integer) from hosts where n % 5 = 1
  union all select 'block', array_to_string(labels[-2:], '.'), 'add', date '2024-08-01' from hosts
  where n % 7 = 0 and len(labels) > 2 and not regexp_matches(value, {_ADDRESS})),
daily as (select list, value, dated, max(action) as action from log group by all),
spans as (select list, value, action, dated as since, lead(dated) over (partition by list, value order by dated) as until from daily),
captures as (select page_id, {_HOST} as host, date '2024-01-01' + cast(page_id * 7 % 366 as integer) as fetched from pages),
keys as (select page_id, fetched, unnest(list_transform(range(1, case when regexp_matches(host, {_ADDRESS}) then 2
                                                       else greatest(len(string_split(host, '.')) - 1, 1) + 1 end),
                                        lambda i: array_to_string(string_split(host, '.')[i:], '.'))) as value from captures where host <> ''),
hits as (select page_id, s.list, k.value from keys k join spans s on k.value = s.value and s.action = 'add'
         and s.since <= k.fetched and (s.until is null or k.fetched < s.until)),
best as (select page_id, list, value, row_number() over (partition by page_id order by length(value) desc, list desc) as r from hits)
select c.page_id, c.host, c.fetched, coalesce(b.list, 'none') as verdict, b.value as matched
from captures c left join best b on c.page_id = b.page_id and b.r = 1"""

_ESCAPE = r"regexp_replace({}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"

SQL["op6_chat_format"] = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, 'assistant', '{PROBE}'),
said as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn) as told,
         coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '') as learned,
         sum(length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')}) + {len(chat.OPEN + chat.MIDDLE + chat.CLOSE)}) as chars
  from turns group by conv_id)
select conv_id, n_turns, sha256(told) as turns_sha256, cast(length(learned) as bigint) as loss_chars,
       sha256(learned) as loss_sha256, cast(chars as bigint) as formatted_chars from said"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_RUNS = "list_distinct(list_transform(range(1, len(w) - {0} + 2), lambda i: array_to_string(w[i:i + {0} - 1], ' ')))"

SQL["op8_decontamination"] = rf"""
with iw as (select item_id, w, least(len(w), 5) as k from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
i as (select item_id, k, unnest({_RUNS.format("k")}) as s from iw),
dw as (select doc_id, k, w from (select doc_id, {_WORDS} as w from documents) cross join (select distinct k from iw)),
d as (select doc_id, k, unnest({_RUNS.format("k")}) as s from dw where len(w) >= k),
n as (select item_id, count(*) as n_shingles from i group by item_id),
hit as (select doc_id, item_id, count(*) as n_shared from d join i using (k, s) group by all)
select doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles as containment
from hit join n using (item_id) where n_shared >= 0.8 * n_shingles - 1e-9"""


_DRAWN = "cast('0x' || substr(sha256('1:' || doc_id), {}, 8) as bigint)"

SQL["op11_fill_in_middle"] = rf"""
with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
                  {_DRAWN.format(1)} as h1, {_DRAWN.format(9)} as h2, {_DRAWN.format(17)} as h3, {_DRAWN.format(25)} as h4 from documents),
c as (select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
             case when text = '' or regexp_matches(text, '<[PSM]>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from t),
p as (select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:], '') as suffix from c)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256 from p"""

SQL["op13_hard_negatives"] = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
           from embeddings where label is not null and embedding is not null
           and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label as own, b.vec_id as id, b.label, cast(list_dot_product(a.e, b.e) as bigint) as score
      from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, id as positive_id, score as positive_score from s where label = own
      qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) as rank,
       id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where label <> own and 100 * score between 30 * positive_score and 90 * positive_score
qualify rank <= 10"""
