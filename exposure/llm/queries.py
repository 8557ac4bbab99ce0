"""The registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposure.llm import (
    bpe, chat, exact_dedup, fingerprint, language, negatives, packing, quality, simhash, spelling,
    toxicity, vectors, warc,
)
from exposure.llm.frames import table

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ESCAPED = "\\### Assistant: </turn> ok"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)
    return bpe.digests(bpe.decode(encoded, BYTE_VOCABULARY))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ESCAPED).alias("text"))
    return chat.read_back(chat.examples(given.unionByName(more)))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.without_ids(packing.pack(docs, WORD_VOCABULARY, keep_ids=False))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), warc.new_folder(spark))
    return warc.page_records(warc.read_archives(archives))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    aside = language.held_out("doc_id")
    return language.identify_documents(docs, docs.where(~aside)).withColumn("held_out", aside)


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.learn_texts(language.known_texts(table(spark, sf_dir, "documents")))
    found = language.identify(language.page_rows(table(spark, sf_dir, "pages")), model)
    return found.withColumnRenamed("id", "page_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), drop_every=97)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_exact_dedup, op2_bpe, op3_simhash, op4_chat, op5_packing, op6_vectors, op7_quality,
        op8_warc, op9_language, op10_toxicity, op11_fingerprint, op12_negatives, op13_spelling,
        pages_language)
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
with t as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents where doc_id is not null),
g as (
  select doc_id, norm,
         first_value(doc_id) over (partition by norm order by chars desc, doc_id
           rows between unbounded preceding and unbounded following) as keep_id,
         count(*) over (partition by norm) as group_size,
         row_number() over (partition by norm order by chars desc, doc_id) as turn
  from t)
select doc_id, keep_id, group_size, turn = 1 as kept, sha256(norm) as text_sha256 from g""",
    "op4_chat": r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         count(*) over (partition by conv_id) as n_turns,
         length('<turn ' || replace(replace(replace(replace(replace(role, '\', '\b'),
           '<turn', '\lturn'), '</turn', '\l/turn'), '>', '\g'), chr(10), '\n') || '>' || chr(10)
           || replace(replace(replace(text, '\', '\b'), '<turn', '\lturn'), '</turn', '\l/turn')
           || '</turn>' || chr(10)) as chars
  from given),
s as (select *, sum(chars) over (partition by conv_id order by pos) as so_far from t)
select conv_id, any_value(n_turns) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), ''))
         as loss_sha256,
       cast(sum(so_far) filter (role = 'assistant' or pos = n_turns) as bigint) as formatted_chars
from s group by conv_id""",
    "op8_warc": """
with p as (
  select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as payload_digest,
         strlen(coalesce(html, '')) as payload_bytes from pages where page_id is not null),
g as (
  select *, min(page_id) over (partition by payload_digest) as first_id from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end
         as record_type,
       case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from g""",
    "op12_negatives": """
with t as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, x.vec_id, a.label = x.label as same,
         cast(list_inner_product(a.v, x.v) as bigint) as score
  from t a join t x on a.vec_id % 50 = 0 and a.vec_id <> x.vec_id),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
         cast(row_number() over (
           partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
  from p join s using (anchor_id)
  where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select * from n where rank <= 3""",
    "op13_spelling": """
with recursive crc as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k:
           case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as t
  from range(256) r(i)),
runs as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) as run
  from documents where doc_id is not null),
counted as (
  select doc_id, run, count(*) as times, cast(doc_id as varchar) || ':' || run as raw
  from runs group by all),
hashed as (
  select run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      range(strlen(raw)),
      lambda i: cast(('0x' || substr(hex(raw), cast(2 * i + 1 as integer), 2)) as bigint))),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) as h
  from counted, crc),
cut as (
  select times, case when h % 97 = 0
    then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
  from hashed),
words as (
  select word, cast(sum(times) as bigint) as n from cut where length(word) >= 5
  group by word having sum(times) >= 3),
skipped as (
  select word, i, substr(word, 1, i) as before, substr(word, i + 2) as behind
  from (select word, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word as a, b.word as b from skipped a join skipped b using (i, before, behind)
  where a.word <> b.word
  union select s.word, w.word from skipped s join words w on s.before || s.behind = w.word
  union select w.word, s.word from skipped s join words w on s.before || s.behind = w.word),
near as (
  select a as word, count(*) as n_near, max(w.n) as form_n,
         first(b order by w.n desc, b) as form
  from pairs join words w on w.word = b group by a),
named as (
  select word, case when form_n >= 2 * n then form end as form, n,
         coalesce(n_near, 0) as n_near, case when form_n >= 2 * n then form_n end as form_n
  from words left join near using (word)),
ways as (
  select word, form as up from named where form is not null
  union all select ways.word, named.form from ways join named on named.word = ways.up
  where named.form is not null),
ends as (select ways.word, up from ways join named on named.word = up where named.form is null)
select named.word, form, coalesce(up, named.word) as root, n, n_near, form_n
from named left join ends using (word)""",
}
