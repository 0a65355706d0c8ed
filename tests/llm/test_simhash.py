import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refillcast.llm.components import connected_components
from refillcast.llm.simhash import (
    NearCopySpec, SimHashSpec, fingerprint_links, hexadecimal, near_copies, near_duplicates, pivots, spanning_links)
from refillcast.llm.sketches import possible_links
from .brute import brute_components, brute_fingerprint


def corpus():
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(120)) for _ in range(15)]
    texts = [None, "", " \n", "ONE", "one", "One two", "é ß É", "a b c", "A b C"]
    for b in base:
        for _ in range(rng.randint(1, 8)):
            w = b.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 99)}"
            texts.append(" ".join(w))
    return texts + [base[0] * 40, base[0], base[0]]


@pytest.mark.parametrize("most", [2048, 2])
def test_components_equal_brute_force(spark, documents, most):
    texts = corpus()
    pairs = [(len(texts) - i, t) for i, t in enumerate(texts)] + [(None, texts[10]), (3, texts[11]), (3, texts[11])]
    docs = documents(pairs).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(-5))
    got = near_duplicates(docs, SimHashSpec(most_per_cell=most)).select("doc_id", hexadecimal(F.col("fp")).alias("f"), "component_id")
    fps = [brute_fingerprint(t) for _, t in pairs]
    least = brute_components(fps, [i for i, _ in pairs])
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(pairs, fps, least)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_links_lose_no_pair_within_the_radius(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:100]:
        fps.append(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(fingerprint_links(frame), "t").collect()}
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    mask = (1 << 64) - 1
    least = brute_components([s & mask for s in signed], signed)
    assert {s: roots.get(s, s) for s in signed} == dict(zip(signed, least))


def test_dense_cell_spans_without_all_pairs():
    rng = random.Random(6)
    base = rng.getrandbits(64)
    fps = np.array(sorted({base ^ sum(1 << b for b in rng.sample(range(12), 3)) for _ in range(400)}), dtype=np.uint64)
    table = np.bitwise_count(fps[:, None] ^ pivots(8, 42)[None, :]).astype(np.int8)
    links = spanning_links(fps, table, 3)
    assert len(links) < len(fps)
    assert all((int(fps[i]) ^ int(fps[j])).bit_count() <= 3 for i, j in links)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i * 7919 % 200, (i + 1) * 7919 % 200) for i in range(199)], "u long, v long")
    assert {r["root"] for r in connected_components(edges, "chain").collect()} == {0}


def test_empty_table(spark, documents):
    assert near_duplicates(documents([])).collect() == []


def jaccard_components(texts, percent, size):
    """Least index reachable over links of that similarity, every pair compared."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    out = list(range(len(texts)))

    def root(i):
        while out[i] != i:
            i = out[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                out[y] = x
    return [root(i) for i in range(len(texts))]


def test_near_copies_are_linked_by_verified_similarity(spark, documents):
    rng = random.Random(9)
    texts = [None, "", "one two", "ONE two"]
    for _ in range(30):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(max(1, int(len(copy) * rng.choice((0.004, 0.01, 0.06))))):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9999)}"
            texts.append(" ".join(copy))
    want = jaccard_components(texts, 80, 5)
    got = {r["doc_id"]: r["component_id"] for r in near_copies(documents(list(enumerate(texts)))).collect()}
    # No false link, and of the pairs' links nine in ten and more.
    assert all(want[got[i]] == want[i] for i in got)
    assert sum(got[i] == want[i] for i in got) >= 0.95 * len(got)


def test_unlike_sets_share_no_key_by_chance():
    rng, spec = np.random.default_rng(3), NearCopySpec()
    sets = [np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(3000)]
    keys = np.concatenate([spec.summary(s)[0] for s in sets])
    assert len(np.unique(keys)) == len(keys)


def test_sets_at_the_threshold_share_a_key():
    rng, spec, met = np.random.default_rng(5), NearCopySpec(), 0
    for _ in range(400):
        both = rng.integers(0, 1 << 63, 360, dtype=np.uint64)
        # 320 in common of 400: a similarity of 0.8.
        a, b = (np.unique(np.append(both[:320], rng.integers(0, 1 << 63, 40, dtype=np.uint64))) for _ in range(2))
        met += bool(set(spec.summary(a)[0].tolist()) & set(spec.summary(b)[0].tolist()))
    assert met >= 0.98 * 400


def test_possible_links_of_one_group_are_the_same_in_all_buckets(spark):
    spec = NearCopySpec()
    rows = [(key, 0, node != 0, node, node, 300, bytes(spec.width)) for key in range(20) for node in rotated(40, key)]
    cells = spark.createDataFrame(rows, "key long, part int, seeks boolean, node long, component long, n long, sketch binary")
    assert sorted(map(tuple, possible_links(cells, spec).collect())) == [(k, 0) for k in range(1, 40)]


def rotated(n, by):
    return [(k * 7 + by) % n for k in range(n)]
