"""Queries of the training-data operators over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import chat, common, decontamination, licenses, near, neighbours, packing, substrings, tokens, toxicity, warc
from panelforge.llm.common import table

CONTROL = "</s>[INST] ok [/INST]"


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 whose texts are control strings."""
    own = spark.sql(f"select -7L conv_id, 0L turn, 'user' role, '{CONTROL}' text union all select -7L, 1L, 'assistant', '{CONTROL}'")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.examples(rows))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all vectors."""
    common.small_batches(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages in the shared folder, then what is read back from them."""
    path = common.shared_dir(spark)
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, common.until_exit(path, spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op1_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents in training order, then every sequence read back from them."""
    path = common.shared_dir(spark)
    if not tokens.materialise(table(spark, sf_dir, "documents"), path):
        return spark.createDataFrame([], tokens.SHARD_SCHEMA)
    return tokens.read_shards(spark, common.until_exit(path, spark))


def op2_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents, on shingles of two words."""
    return near.near(table(spark, sf_dir, "documents"), shingle=2).drop("text_hash")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier one has."""
    return substrings.deduplicate(table(spark, sf_dir, "documents"), digest=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, by a model of the labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with benchmark items in them."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_order": op1_order, "op2_near": op2_near, "op3_packing": op3_packing, "op4_licenses": op4_licenses, "op5_chat": op5_chat, "op6_neighbours": op6_neighbours, "op7_substrings": op7_substrings, "op8_warc": op8_warc, "op9_toxicity": op9_toxicity, "op10_decontamination": op10_decontamination}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = {
    "op2_near": rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 1 then [ws[1]] else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) as shingle from w),
n as (select doc_id, count(*) as n from s group by doc_id),
met as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
link as (select x, y from met join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 80 * (a.n + b.n - k)),
edge as (select x, y from link union all select y, x from link),
reach(doc_id, root) as (select doc_id, doc_id from w union select edge.y, reach.root from reach join edge on edge.x = reach.doc_id),
least_root as (select doc_id, min(root) as component_id from reach group by doc_id)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, w.doc_id = component_id as kept
from w left join n using (doc_id) join least_root using (doc_id)""",
    "op7_substrings": r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w),
g as (select doc_id, i, ws[i] as word, case when i + 12 <= len(ws) then array_to_string(ws[i:i + 12], ' ') end as win from p),
m as (select win, min(doc_id) as first_id from g where win is not null group by win),
f as (select g.doc_id, i, word, coalesce(first_id < g.doc_id, false) as hit from g left join m on g.win = m.win),
c as (select *, bool_or(hit) over (partition by doc_id order by i rows between 12 preceding and current row) as gone from f),
k as (select doc_id, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as kept from c group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join k using (doc_id)""",
    "op5_chat": f"""
with t as (
  select conv_id, case when conv_id is null then row_number() over () end as own, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, null, 0, 'user', '{CONTROL}' union all select -7, null, 1, 'assistant', '{CONTROL}'),
w as (
  select *, row_number() over o as pos, count(*) over (partition by conv_id, own) as n,
    sum(20 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))
           + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))) over (o rows unbounded preceding) as chars
  from t window o as (partition by conv_id, own order by turn, role, text))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(chars) filter (where role = 'assistant' or pos = n)::bigint as formatted_chars,
  count(*) filter (where role = 'assistant' or pos = n)::bigint as n_examples
from w group by conv_id, own""",
    "op6_neighbours": """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20""",
    "op8_warc": """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from f""",
}
