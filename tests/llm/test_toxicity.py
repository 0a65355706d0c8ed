import random

from pyspark.sql import functions as F

from refillcast.llm.toxicity import ChainSpec, toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, 400)}" for _ in range(40)]
        toxic, low = i % 4 == 0, i % 5 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["vile", f"foul{rng.randint(0, 99)}"])
        if low:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), int(not low), int(toxic)))
    return rows


def test_held_out_accuracy(spark, documents):
    rows = corpus(900)
    docs = documents([(i, t) for i, t, _, _ in rows]).withColumn("p_toxic", F.lit("clash")).withColumn("slots", F.lit(1))
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows if i < 500], LABELS)
    got = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    held = [(got[i]["rejected"], bool(x), got[i]["p_low_quality"] > 0.5, not q) for i, _, q, x in rows if i >= 500]
    assert sum(a == b for a, b, _, _ in held) >= 0.98 * len(held)
    assert sum(c == d for _, _, c, d in held) >= 0.98 * len(held)
    # What is not toxic is left alone.
    assert not any(a and not b for a, b, _, _ in held)


def test_odd_rows(spark, documents):
    rows = corpus(60)
    pairs = [(i, t) for i, t, _, _ in rows] + [(None, "x"), (None, None), (70, None), (71, ""), (72, "vile " * 50_000), (1, rows[1][1])]
    labels = [(i, q, x) for i, _, q, x in rows] + [(70, None, None), (None, 1, 1), (1, 1, 0), (999, 0, 1)]
    got = toxicity(documents(pairs), spark.createDataFrame(labels, LABELS), ChainSpec(evidence=5.0)).collect()
    assert len(got) == len(pairs)
    assert all(0 <= r["p_toxic"] <= 1 and r["rejected"] is not None for r in got)


def test_without_labels_nothing_is_rejected(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    got = toxicity(docs, spark.createDataFrame([], LABELS)).collect()
    assert [r["rejected"] for r in got] == [False, False]
    one = spark.createDataFrame([(1, 1, 0), (2, None, None)], LABELS)
    assert not any(r["rejected"] for r in toxicity(docs, one).collect())
    assert toxicity(documents([]), one).collect() == []
