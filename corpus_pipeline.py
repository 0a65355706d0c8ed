"""The corpus pipeline: five stages over ``documents``, each one of the operators of refillcast.llm.

Each stage reads what its predecessor kept, written as Parquet in between. All stages but the last return
the columns they were given, whatever else these are called.

Rows without a document id cannot be named by a decision on documents: they pass the stages that
decide by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillcast.llm import decontaminate, mixing, shards, simhash, toxicity
from refillcast.llm.common import read, staged

#: Not expressible in SQL: trained models, alignment and packing.
ORACLE_SQL = None

#: Target shares of tokens. Toxic documents are gone by then, so they have no share.
WEIGHTS = {"clean": 0.93, "low": 0.07}


def without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The documents whose id is not among the ids. The ids are written first, so that their size is known."""
    return docs.join(staged(ids.select("doc_id").distinct(), name), "doc_id", "left_anti")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold go."""
    # Other columns travel under names of their own: theirs may clash with the scores'.
    names = docs.columns
    aliased = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"column {k}") for k, c in enumerate(names)])
    scored = toxicity.toxicity(aliased, read(spark, sf_dir, "labels"), keep=tuple(aliased.columns[2:]))
    return scored.where(~F.col("rejected")).select(*[F.col(f"`column {k}`").alias(c) for k, c in enumerate(names)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8) the document with the least id stays.

    Documents without words stay. Of rows with one id and text one stays; rows with one id and different texts stay
    where one of them does.
    """
    found = simhash.near_copies(docs)
    first = staged(found.where("kept and doc_id is not null").select("doc_id").distinct(), "first-ids")
    same = F.xxhash64("text").alias("hash of text")
    kept = docs.join(first, "doc_id", "left_semi").select("*", same).dropDuplicates(["doc_id", "hash of text"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go."""
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"))
    return without(docs, found, "contaminated-ids").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture gives it copies.

    The total is set so that the clean domain stays whole: documents that the classifier calls clean
    have a copy at least. Low quality is thinned or repeated to its share.
    """
    labels = mixing.label_domains(read(spark, sf_dir, "labels"))
    rated = mixing.mix(docs, labels, WEIGHTS, whole="clean")
    # One copy is the rule; rows without an id have no decision.
    other = rated.where("copies != 1").groupBy("doc_id").agg(F.max("copies").alias("mix copies"))
    joined = docs.join(staged(other, "mix-copies"), "doc_id", "left")
    times = F.array_repeat(F.lit(0), F.coalesce(F.col("mix copies"), F.lit(1)))
    return joined.select(*docs.columns, F.explode(times).alias("mix copy")).select(docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and its place in it."""
    return shards.shard_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
