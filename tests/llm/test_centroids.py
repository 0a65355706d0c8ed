import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from refillcast.llm.centroids import CentroidSpec, cluster

SCHEMA = "vec_id long, embedding array<float>, label int"
SPEC = CentroidSpec(size=6, clusters=3, rounds=4)


def brute(vectors, spec):
    kept = [
        (i, [math.floor(spec.scale * x) for x in v]) for i, v in vectors
        if v is not None and len(v) == spec.size and all(x is not None and math.isfinite(x) and abs(x) * spec.scale < spec.largest for x in v)]
    first = sorted(kept, key=lambda p: (hashlib.sha256(f"{spec.seed}:{'null' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))
    centroids = [v for _, v in first[: spec.clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v: min((far(v, c), k) for k, c in enumerate(centroids))
    for _ in range(spec.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centroids)]
    rows = [(i, *best(v)[::-1]) for i, v in kept]
    inertia = sum(d for _, _, d in rows)
    own = {k: sum(d for _, c, d in rows if c == k) for _, k, _ in rows}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), k, d, own[k], inertia, digest[k]) for i, k, d in rows)


def found(df, spec=SPEC):
    return sorted((str(r[0]), *r[1:]) for r in cluster(df, spec).collect())


def vectors(n, seed=1):
    rng = random.Random(seed)
    # Halves and quarters: ties between centroids, negative numbers, repeated vectors.
    return [(i, [rng.randint(-4, 4) / 2 ** rng.randint(0, 2) for _ in range(6)]) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_equals_brute_force(spark, n):
    rows = vectors(n)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    assert found(df) == brute(rows, SPEC)


def test_a_hot_vector_and_repeated_rows(spark):
    rows = vectors(60) + [(i, [0.5] * 6) for i in range(100, 160)] + vectors(5)
    assert found(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)) == brute(rows, SPEC)


def test_odd_vectors_are_left_out(spark):
    rows = vectors(30) + [
        (40, None), (41, []), (42, [1.0] * 5), (43, [1.0] * 7), (44, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (45, [float("nan")] * 6),
        (46, [float("inf")] + [0.0] * 5), (47, [1e30] + [0.0] * 5), (None, [0.25] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("cluster", F.lit("clash")).withColumn("v", F.lit(0))
    got = found(df)
    assert got == brute(rows, SPEC) and len(got) == 31


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = cluster(empty)
    assert got.collect() == [] and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert cluster(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)).collect() == []
