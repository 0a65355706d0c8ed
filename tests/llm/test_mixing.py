import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refillcast.llm.mixing import MixSpec, fit_rates, label_domains, mix


def test_rates_match_brute_force(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet((0.5, 0.3, 0.2), size=200)
    n = rng.integers(1, 500, size=200)
    share = np.array([0.2, 0.2, 0.6])
    targets = share * n.sum()
    rows = [(int(i), int(n[i]), *map(float, p[i])) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    rated, reached = fit_rates(frame, targets.tolist(), MixSpec())
    assert reached == pytest.approx(targets.tolist(), rel=1e-4)
    # The same descent in numpy.
    rate, held = np.ones(200), (n[:, None] * p).sum(0)
    for _ in range(200):
        off = (n * rate) @ p - targets
        if np.abs(off).max() <= 1e-6 * targets.sum():
            break
        rate = np.maximum(0, rate - p @ (off / held))
    got = {r["doc_id"]: r["rate"] for r in rated.collect()}
    assert [got[i] for i in range(200)] == pytest.approx(rate.tolist(), rel=1e-6, abs=1e-9)
    assert min(got.values()) >= 0


def corpus(n):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 60))]
        kind = ("clean", "clean", "clean", "low", "toxic")[i % 5]
        if kind == "low":
            words = [w + "###" for w in words]
        if kind == "toxic":
            words += ["vile", "foul"]
        rows.append((i, " ".join(words), kind))
    return rows


def test_targets_are_met_and_posteriors_hold_out(spark, documents):
    rows = corpus(800)
    docs = documents([(i, t) for i, t, _ in rows]).withColumn("rate", F.lit("clash")).withColumn("p0", F.lit("clash"))
    labels = spark.createDataFrame([(i, k) for i, _, k in rows if i < 400], "doc_id long, domain string")
    weights = {"clean": 0.8, "low": 0.15, "toxic": 0.05}
    got = {r["doc_id"]: r for r in mix(docs, labels, weights).collect()}
    assert len(got) == 800
    total = sum(r["n_tokens"] for r in got.values())
    for d, w in weights.items():
        assert sum(r["n_tokens"] * r["rate"] * r[f"p_{d}"] for r in got.values()) == pytest.approx(w * total, rel=1e-3)
    held = [max(weights, key=lambda d: got[i][f"p_{d}"]) == k for i, _, k in rows if i >= 400]
    assert sum(held) >= 0.97 * len(held)
    assert all(abs(r["copies"] - r["rate"]) <= 1 for r in got.values())


def test_a_whole_domain_is_kept(spark, documents):
    rows = corpus(500)
    labels = spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, domain string")
    got = {r["doc_id"]: r for r in mix(documents([(i, t) for i, t, _ in rows]), labels, {"clean": 0.9, "low": 0.1, "toxic": 0.0}, whole="clean").collect()}
    assert all(got[i]["copies"] >= 1 for i, _, k in rows if k == "clean" and got[i]["p_clean"] > 0.999)


def skewed(n):
    """Low quality at 3 % of the rows; some clean documents look a little like it."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(20, 60))]
        kind = "low" if i % 33 == 0 else "clean"
        words = [w + "###" if rng.random() < (0.6 if kind == "low" else 0.04 * (i % 5 == 1)) else w for w in words]
        rows.append((i, " ".join(words), kind))
    return rows


def test_soft_posteriors_do_not_thin_documents_with_a_least_rate(spark):
    rng = np.random.default_rng(2)
    low = np.where(rng.random(400) < 0.1, rng.uniform(0.6, 1.0, 400), rng.uniform(0.0, 0.2, 400))
    rows = [(i, int(rng.integers(1, 500)), float(1 - q), float(q)) for i, q in enumerate(low)]
    frame = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double")
    clean = sum(n * p for _, n, p, _ in rows)
    targets = [clean, clean * 0.07 / 0.93]
    least = F.when(F.col("p0") >= 0.5, 1.0).otherwise(0.0)
    thinned, _ = fit_rates(frame, targets, MixSpec(most_steps=10))
    assert thinned.where("p0 >= 0.5 and rate < 1").count()
    rated, _ = fit_rates(frame, targets, MixSpec(most_steps=10), least)
    assert all(r["rate"] >= (r["p0"] >= 0.5) for r in rated.collect())


def test_odd_rows(spark, documents):
    pairs = [(i, t) for i, t, _ in corpus(40)] + [(None, "x"), (None, None), (50, None), (51, ""), (52, "a " * 50_000), (1, "again")]
    labels = spark.createDataFrame([(i, q, x) for i in range(40) for q, x in [(i % 2, int(i % 5 == 4))]] + [(50, None, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    got = mix(documents(pairs), label_domains(labels), {"clean": 0.9, "low": 0.07, "toxic": 0.03}).collect()
    assert len(got) == len(pairs) and all(r["rate"] >= 0 for r in got)


def test_without_labels_or_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, domain string")
    got = mix(documents([(1, "a b"), (2, None)]), none, {"clean": 1.0}).collect()
    assert [(r["rate"], r["copies"]) for r in got] == [(1.0, 1), (1.0, 1)]
    assert mix(documents([]), none, {"clean": 1.0}).collect() == []


def test_the_descent_starts_no_job_a_step(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        share = rng.choice((0.02, 0.1, 0.3, 0.5, 0.8))
        rows.append((rng.randint(5, 90), share, 1 - share))
    scored = spark.createDataFrame(rows, "n_tokens long, p0 double, p1 double")
    total = float(sum(n for n, _, _ in rows))
    jobs, first = [], type(scored).first
    monkeypatch.setattr(type(scored), "first", lambda self: jobs.append(1) or first(self))
    found = {}
    for most in (MixSpec.most_cells, 0):
        before = len(jobs)
        rated, reached = fit_rates(scored, [0.9 * total, 0.1 * total], MixSpec(most_cells=most))
        rates = sorted((r["n_tokens"], r["p0"], r["rate"]) for r in rated.collect())
        found[most] = [x[2] for x in rates], reached, len(jobs) - before
    (rates, reached, few), (same, also, many) = found.values()
    assert rates == pytest.approx(same, abs=1e-9) and reached == pytest.approx(also)
    assert few == 0 and many > 10
