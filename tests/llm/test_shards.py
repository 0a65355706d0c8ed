import zlib

import numpy as np
from pyspark.sql import functions as F

from refillcast.llm.shards import PackSpec, even_out, pack, shard_documents


def test_shards_are_even_gapless_and_keep_groups(spark, documents):
    texts = [None, "", "x" * 5000] + [f"text {i} " * (i % 40) for i in range(900)] + ["same text"] * 60
    docs = documents(list(enumerate(texts)) + [(None, "no id"), (5, "again"), (5, "again")])
    docs = docs.withColumn("size", F.lit("clash")).withColumn("shard", F.lit(-1))
    rows = shard_documents(docs, PackSpec(n_shards=4, parcels_per_shard=32)).collect()
    assert len(rows) == len(texts) + 3
    loads = {s: sum(r["size"] for r in rows if r["shard"] == s) for s in range(4)}
    assert max(loads.values()) - min(loads.values()) < 0.01 * sum(loads.values())
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    by_id = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(texts):
        if i != 5:
            assert by_id[i]["size"] == len((t or "").encode()) + 8
            assert by_id[i]["text_crc32"] == zlib.crc32((t or "").encode())
    same = {r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"same text")}
    assert len(same) == 1


def test_a_hot_group_is_cut(spark, documents):
    docs = documents([(i, "hot") for i in range(600)] + [(1000 + i, f"cold {i}") for i in range(600)])
    rows = shard_documents(docs, PackSpec(n_shards=8, parcels_per_shard=16)).collect()
    counts = [sum(r["shard"] == s for r in rows) for s in range(8)]
    assert max(counts) - min(counts) <= 30


def test_empty_table(spark, documents):
    assert shard_documents(documents([])).collect() == []


def test_pack_prefers_the_best_dot_product():
    vectors = np.array([[8.0, 1, 1], [1, 8, 1], [1, 1, 8], [1, 1, 1]])
    shards = pack(vectors, 2, (1.0, 1.0, 1.0))
    assert set(shards.tolist()) == {0, 1}
    assert np.array_equal(even_out(vectors, shards, 2, rounds=0), shards)
