"""The queries of the training-data operators and, where SQL says the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, divergence, exact_dedup, infill, jaccard_join, licenses, pii, quality, suffix_dedup, token_store, warc_zip
from .common import table


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on every machine; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), num=90, den=100, width=3)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("spans")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    return chat.digests(chat.conversations(chat.thread(rows.unionByName(extra))))


OP7_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized as (
  select *, len(role) + len(text)
    + len(text) - len(replace(text, '\', '')) + len(text) - len(replace(text, '|', '')) + len(role) - len(replace(role, '\', '')) + len(role) - len(replace(role, '|', ''))
    - 4 * (len(text) - len(replace(text, '[INST]', ''))) // 6 - 5 * (len(text) - len(replace(text, '[/INST]', ''))) // 7 - 6 * (len(text) - len(replace(text, '<</SYS>>', ''))) // 8
    - 5 * (len(text) - len(replace(text, '<<SYS>>', ''))) // 7 - 2 * (len(text) - len(replace(text, '</s>', ''))) // 4 - (len(text) - len(replace(text, '<s>', ''))) // 3
    + 11 as chars
  from rows
), loss as (select conv_id, string_agg(text, '' order by turn, role, text) as t from rows where role = 'assistant' group by conv_id)
select r.conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       len(coalesce(any_value(l.t), '')) as loss_chars, sha256(coalesce(any_value(l.t), '')) as loss_sha256, cast(sum(chars) as bigint) as formatted_chars
from sized r left join loss l using (conv_id) group by r.conv_id
"""


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from t
"""


def op11_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archived(table(spark, sf_dir, "pages"))


OP11_SQL = r"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
k as (select *, max(page_id) over (partition by html) as keep from p),
d as (
  select *, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda c:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * g, 5))::bigint >> (15 - 5 * c)::bigint) & 31)::bigint, 1)), 'string_agg', '')), 'string_agg', '') as digest
  from k
)
select page_id, strlen(html)::bigint as payload_bytes, digest as payload_digest, case when page_id = keep then 'response' else 'revisit' end as record_type,
       case when page_id <> keep then keep end as refers_to
from d
"""


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.infilled(table(spark, sf_dir, "documents")))


OP12_SQL = r"""
with t as (select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id::varchar) as h from documents),
d as (
  select doc_id, t, length(t)::bigint as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
         ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from t
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from d
), o as (select *, substring(t, 1, a) as prefix, substring(t, a + 1, b - a) as middle, substring(t, b + 1) as suffix from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from o
"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with docs as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), terms as (select lang, term, count(*) as n from words group by all having count(distinct r) >= 3),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from words join terms using (lang, term) group by all),
vocab as (select lang, count(*) as v, sum(n)::bigint as total from terms group by lang),
sums as (select lang, source, sum(n)::bigint as total from counts group by all),
full_p as (
  select g.lang, g.source, t.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + v.v))::bigint as p
  from groups g join terms t using (lang) join vocab v using (lang) left join sums s using (lang, source) left join counts c using (lang, source, term)
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value
  from full_p a join full_p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), every_pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
), term_values as (
  select f.lang, f.source, 'term' as part, f.term as item, f.p, 1 + (1000000000::hugeint * (t.n + 1) // (v.total + v.v))::bigint as q
  from full_p f join terms t using (lang, term) join vocab v using (lang) where f.n > 0
), every_term as (select lang, source, part, item, (p - q) * (p - q) // q as value from term_values where p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (from every_pair union all from every_term))
select * from ranked where part = 'pair' or rank <= 200
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_jaccard_join, op2_pii, op3_decontam, op4_token_store, op5_suffix_dedup, op6_bpe, op7_chat, op8_licenses, op9_quality, op10_exact_dedup, op11_warc_zip, op12_infill, op13_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op7_chat": OP7_SQL, "op10_exact_dedup": OP10_SQL, "op11_warc_zip": OP11_SQL, "op12_infill": OP12_SQL, "op13_divergence": OP13_SQL}
