"""Queries over this folder's operators, as the driver runs them, and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm.common import table
from sitelens.llm.cross_align import alignment
from sitelens.llm.decontaminate import leaks
from sitelens.llm.licenses import license_notices
from sitelens.llm.near_dedup import near_duplicates
from sitelens.llm.neighbours import nearest
from sitelens.llm.packing import pack_documents
from sitelens.llm.prefix_trie import prefix_tree
from sitelens.llm.private_data import personal_data
from sitelens.llm.quality import quality_scores
from sitelens.llm.rollups import maintained
from sitelens.llm.sharding import sampled_splitters
from sitelens.llm.simple8b import token_files
from sitelens.llm.toxicity import toxicity_scores
from sitelens.session import scratch_path


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_splitters(table(spark, sf_dir, "documents"))


def op2_certified_repacking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("label")


def op4_hilbert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op6_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_unbiased_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op9_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(table(spark, sf_dir, "documents"))


def op10_delta_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return maintained(docs, labels, scratch_path(spark, "token-ledger"))


def op11_contextual_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op12_z_fast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree(table(spark, sf_dir, "conversations"))


def op13_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def queries() -> dict:
    registered = (
        op1_sampled_splitters,
        op2_certified_repacking,
        op3_bayesian_minhash,
        op4_hilbert_windows,
        op5_template_leaks,
        op6_noisy_channel,
        op7_unbiased_risk,
        op8_simple8b_files,
        op9_license_paragraphs,
        op10_delta_rollups,
        op11_contextual_identifiers,
        op12_z_fast_trie,
        op13_shared_cuts,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {"op3_bayesian_minhash": NEAR_DUPLICATES, "op12_z_fast_trie": PREFIX_TREE}


#: All pairs of shingle sets, and components by recursion; for small tables.
NEAR_DUPLICATES = r"""with recursive texts as (
  select row_number() over () as r, doc_id,
         string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), E' \t\n\v\f\r'), '[\x20\x09-\x0D]+') as parts
  from documents),
words as (select r, doc_id, case when parts = [''] then [] else parts end as w from texts),
sets as (
  select r, doc_id, case
    when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
  end as s
  from words),
classes as (
  select list_sort(s) as s, len(any_value(s)) as n, min(doc_id) as c
  from sets where len(s) > 0 group by list_sort(s)),
members as (select c, n, unnest(s) as shingle from classes),
shared as (
  select a.c as a, b.c as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as k
  from members a join members b on a.shingle = b.shingle and a.c < b.c group by 1, 2),
links as (select a, b from shared where 100 * k >= 75 * (na + nb - k)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select c as node, c as seen from classes where c in (select a from both_ways)
  union
  select r.node, l.b from reach r join both_ways l on l.a = r.seen),
named as (select node, min(seen) as component from reach group by node)
select x.doc_id, len(x.s)::bigint as n_shingles,
       coalesce(n.component, k.c, x.doc_id) as component_id,
       coalesce(n.component, k.c, x.doc_id) = x.doc_id as kept
from sets x left join classes k on k.s = list_sort(x.s) left join named n on n.node = k.c
"""

#: Every prefix of every conversation as a list of its turns; crc32 by its eight steps a byte.
PREFIX_TREE = r"""with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id
             order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
ids as (
  select conv_id, conv_id - conv_id % 5 as base,
         list_reduce(
           list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::bigint)),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda s, i: case when s % 2 = 1 then xor(s // 2, 3988292384) else s // 2 end)) as crc
  from own group by conv_id),
heads as (select conv_id, base, xor(crc, 4294967295) % 9 as h from ids),
turns as (
  select h.conv_id, 0 as part, o.pos, o.role, o.text
  from heads h join own o on o.conv_id = h.base and o.pos <= h.h
  union all
  select h.conv_id, 1, o.pos, o.role, o.text
  from heads h join own o on o.conv_id = h.conv_id and o.pos > h.h),
whole as (
  select conv_id, list({'role': role, 'text': text} order by part, pos) as t from turns group by conv_id),
seqs as (
  select conv_id, case when t is null then [] else t end as t from heads left join whole using (conv_id)),
prefixes as (select conv_id, t, d, t[1:d] as p from (select *, unnest(range(0, len(t) + 1)) as d from seqs)),
nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(t) = d), '')) as ends
  from prefixes group by p, d),
kids as (select p[1:d - 1] as p, count(*) as k from nodes where d > 0 group by 1),
weighed as (
  select x.*, coalesce(k, 0) as k, case when d = 0 then 0 else (n - 1) * strlen(x.p[d].text) end as w
  from nodes x left join kids using (p)),
below as (
  select p[1:up] as p, sum((k = 0)::int) as leaves, sum(w) as saved
  from (select *, unnest(range(0, d + 1)) as up from weighed) group by 1)
select w.conv_id, w.d::bigint as depth, u.conv_id as parent_conv_id, w.n::bigint as n_convs,
       w.k::bigint as n_children, b.leaves::bigint as n_leaves, b.saved::bigint as saved_tokens,
       w.ends as ends_sha256
from weighed w join below b using (p) left join nodes u on w.d > 0 and u.p = w.p[1:w.d - 1]
"""
