import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refillcast.llm.negatives import NegativeSpec, hard_negatives, threshold_search, usable

SCHEMA = "vec_id long, embedding array<float>, label int"
END = 1 << 61


def brute(rows, anchor, spec=NegativeSpec()):
    kept = {
        (i, tuple(math.floor(spec.scale * x) for x in v), label) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, v, label in kept:
        if not anchor(i):
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))
        others = sorted((-score(w), j, other) for j, w, other in kept if j != i)
        positives = [(-s, j) for s, j, other in others if other == label][: spec.positives]
        for p, j in dict.fromkeys(positives):
            inside = [(-s, k) for s, k, other in others if other != label and 80 * p <= 100 * -s <= 100 * p]
            out += [(i, j, rank, k, p, s) for rank, (s, k) in enumerate(inside[: spec.negatives], 1)]
    return sorted(out)


def found(spark, rows, spec=NegativeSpec(), every=5):
    df = spark.createDataFrame([(i, v, x) for i, v, x in rows], SCHEMA).withColumn("row", F.lit("clash")).withColumn("v", F.lit(1))
    got = hard_negatives(usable(df, F.col("label"), spec), F.col("vec_id") % every == 0, spec)
    return sorted(tuple(r) for r in got.collect())


def vectors(n, size=8, labels=3, seed=1, step=4):
    rng = random.Random(seed)
    return [(i, [rng.randint(-8, 8) / step for _ in range(size)], rng.randrange(labels)) for i in range(n)]


def test_search_finds_the_best_of_every_window_and_stops_early():
    rng = np.random.default_rng(4)
    values = rng.integers(-50, 50, (600, 5))
    # A few rows that are best by far, so that reading ends long before the lists do.
    values[:8] = 400 + np.arange(8)[:, None]
    ascending = np.argsort(values, axis=0, kind="stable").T
    for anchor in (np.array([3, 1, 2, 5, 4]), np.array([-3, 0, 2, -5, 1]), np.zeros(5, dtype=int)):
        scores = values @ anchor
        for low, high in ((-END, END), (0, 100 * int(scores.max())), (100 * int(scores.max()) + 1, END), (-5000, 5000)):
            at, got = threshold_search(values, ascending, anchor, [(low, high)], 4, 16)
            assert (got == scores[at]).all() and len(set(at.tolist())) == len(at)
            inside = np.sort(scores[(100 * scores >= low) & (100 * scores <= high)])[::-1][:4]
            held = np.sort(got[(100 * got >= low) & (100 * got <= high)])[::-1][:4]
            assert held.tolist() == inside.tolist()
            # All rows that tie with the last one are among those seen.
            if len(inside) == 4:
                assert set(np.flatnonzero(scores == inside[-1])) <= set(at.tolist())
    at, _ = threshold_search(values, ascending, np.array([3, 1, 2, 5, 4]), [(-END, END)], 4, 16)
    assert len(at) < 200


@pytest.mark.parametrize("rows_per_block, anchors_per_block", [(4096, 4096), (17, 5)])
def test_equals_brute_force(spark, rows_per_block, anchors_per_block):
    rows = vectors(150)
    spec = NegativeSpec(rows_per_block=rows_per_block, anchors_per_block=anchors_per_block, first_depth=2)
    got = found(spark, rows, spec)
    assert got == brute(rows, lambda i: i % 5 == 0, spec) and len(got) > 100


def test_ties_and_a_hot_vector(spark):
    """Coarse vectors with many equal scores; a third of all rows is one vector."""
    rows = vectors(80, size=3, step=8) + [(i, [1.0, 0.5, 0.25], i % 2) for i in range(200, 240)]
    assert found(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rows = vectors(40)
    rows += [(50, None, 1), (55, [1.0] * 8, None), (None, [1.0] * 8, 1), (60, [1.0, None] + [0.0] * 6, 1), (65, [float("nan")] * 8, 1),
             (70, [float("inf")] * 8, 1), (75, [], 1), (80, [2.0, 1.0], 1), (85, [0.0] * 8, 2), (90, [-1.0] * 8, 77),
             rows[5], rows[10], (5, [0.25] * 8, 2)]
    assert found(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0)]) == []
    assert found(spark, [(5, [1.0], 0)]) == []
