"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillcast.llm import (
    centroids, chat, decontaminate, html, mixing, negatives, repeats, rules, secrets, shards, simhash, sketches, toxicity)
from refillcast.llm.common import read, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op3_prefix_examples", r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), f as (
  -- A turn's marks take 9 + 7 + 7 characters, every escaped one takes one more.
  select *, 23 + 2 * length(role || text) - length(regexp_replace(role || text, '[<\x5B\x5C]', '', 'g')) as chars,
         lead(turn) over (partition by conv_id order by turn, role, text) is null as last
  from t
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
       sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars,
       cast(sum(case when role = 'assistant' or last then 1 else 0 end) as bigint) as n_examples
from f group by conv_id""")
def op3_prefix_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    # The contract's extra conversation.
    extra = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)], turns.schema)
    return chat.conversation_digest(chat.conversation_examples(turns.unionByName(extra)))


@query("op5_vector_packing")
def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(read(spark, sf_dir, "documents"))


@query("op7_decision_list")
def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = staged(rules.text_statistics(read(spark, sf_dir, "documents")), "rule-stats")
    labels = read(spark, sf_dir, "labels").where("quality is not null").select("doc_id", (F.col("quality") == 0).alias("bad"))
    labelled = staged(stats.where(~F.col("base_failed")).join(labels, "doc_id"), "rule-labels")
    return rules.quality_verdicts(stats, rules.learn_rules(labelled))


@query("op4_pivot_simhash")
def op4_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query("op6_classifier_chain")
def op6_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_suffix_repeats")
def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(read(spark, sf_dir, "documents")).drop("kept")


@query("op9_host_paths")
def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages")).drop("path")


@query("op8_inferred_grammars")
def op8_inferred_grammars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(read(spark, sf_dir, "documents")))


@query("op2_seeded_alignment")
def op2_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op1_soft_mixing")
def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.label_domains(read(spark, sf_dir, "labels"))
    return mixing.mix(read(spark, sf_dir, "documents"), labels, mixing.WEIGHTS)


@query("op11_fast_sketches", r"""
with recursive w as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as t
  from documents
), s as materialized (
  select doc_id, unnest(case when len(t) = 0 then [] when len(t) < 3 then [array_to_string(t, ' ')]
                else list_distinct([t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] for i in range(1, len(t) - 1)]) end) as g
  from w
), n as materialized (
  select doc_id, count(*) as n from s group by doc_id
), links as materialized (
  select a.doc_id as u, b.doc_id as v from s a join s b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 85 * ((select n from n where n.doc_id = a.doc_id) + (select n from n where n.doc_id = b.doc_id) - count(*))
), edges as materialized (
  select u, v from links union all select v, u from links
), reach as (
  select doc_id, doc_id as other from n
  union select r.doc_id, e.v from reach r join edges e on e.u = r.other
), c as (
  select doc_id, min(other) as least from reach group by doc_id
)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.least, w.doc_id) as component_id,
       coalesce(c.least, w.doc_id) = w.doc_id as kept
from w left join n using (doc_id) left join c using (doc_id)""")
def op11_fast_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(read(spark, sf_dir, "documents"))


@query("op12_native_centroids", centroids.oracle())
def op12_native_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


@query("op13_threshold_negatives", """
with r as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), s as materialized (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) as score
  from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as int) as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
 and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
qualify rank <= 5""")
def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some labels are moved to the next one, as if they had been noted wrongly.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.usable(read(spark, sf_dir, "embeddings"), label)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)
