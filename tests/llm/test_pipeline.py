"""The pipeline on a small corpus with planted cases, stage by stage and as a whole."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from .brute import brute_score
from .test_mixing import skewed
from .test_sketches import brute

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    prose = lambda n: " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(n))
    items = [(k, " ".join(f"item{k}x{j}" if j % 2 else f"w{j}" for j in range(20))) for k in range(3)]
    rows, labels, kind = [], [], {}
    for i in range(420):
        text, kind[i] = prose(rng.randint(40, 90)), "clean"
        if i % 10 == 0:
            text, kind[i] = f"{text} vile{i % 7} words foul", "toxic"
        elif i % 10 == 1:
            text, kind[i] = " ".join(w + "###" for w in text.split()), "low"
        elif i % 30 == 2:
            text, kind[i] = f"{text} {items[i % 3][1]} {prose(5)}", "leak"
        elif i % 30 == 3 and i > 30:
            text, kind[i] = rows[i - 19][1], "copy"
        rows.append((i, text, "en", "s", len(text), "extra", 1.0))
        if i % 5 < 4 or kind[i] == "toxic":
            labels.append((i, int(kind[i] != "low"), int(kind[i] == "toxic")))
    rows += [(None, "no id at all", "en", "s", 12, "extra", 1.0), (900, None, None, None, None, None, None), (5, *rows[5][1:])]
    folder = str(tmp_path_factory.mktemp("corpus"))
    # Columns whose names the operators use themselves.
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, p_toxic double").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {r[0]: r[1] for r in rows}, dict(items), kind


def test_stages_decide_and_keep_columns(spark, corpus):
    folder, text, items, kind = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "p_toxic"]
        kept[name] = [r["doc_id"] for r in docs.collect()]
        assert None in kept[name]
    gone = set(text) - set(kept["toxicity"])
    assert {i for i in gone if i is not None} <= {i for i in kind if kind[i] == "toxic"}
    assert len(gone) >= 38
    ids = [i for i in kept["toxicity"] if i is not None]
    # Five-word shingles, similarity of 0.8, every pair compared; documents without words stay.
    least = {i: c for i, _, c in brute([(i, text[i]) for i in ids], percent=80, size=5)}
    assert sorted(i for i in kept["near_duplicates"] if i is not None) == sorted(set(least.values()))
    leaks = {i for i in kept["near_duplicates"] if i is not None
             and any(brute_score((text[i] or "").split(), t.split()) >= 0.5 for t in items.values())}
    assert leaks and set(kept["decontamination"]) == set(kept["near_duplicates"]) - leaks
    lost = set(kept["decontamination"]) - set(kept["mixing"])
    assert lost and sum(kind.get(i) == "clean" for i in lost) <= 2
    shards = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted(str(r["doc_id"]) for r in shards) == sorted(map(str, kept["mixing"]))
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in whole) == sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in shards)


def test_mixing_carries_copies_and_keeps_clean_documents(spark, documents, tmp_path):
    rows = skewed(600)
    labels = [(i, int(kind != "low"), 0) for i, _, kind in rows]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = [r["doc_id"] for r in corpus_pipeline.mixed(spark, documents([(i, t) for i, t, _ in rows] + [(None, "x")]), str(tmp_path)).collect()]
    assert {i for i, _, kind in rows if kind == "clean"} <= set(got) and None in got
    low = [i for i, _, kind in rows if kind == "low"]
    assert sum(got.count(i) for i in low) > 1.5 * len(low)


def test_empty_corpus(spark, corpus, tmp_path):
    folder = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").where(F.lit(False)).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
