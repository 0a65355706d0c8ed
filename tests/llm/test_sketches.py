import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refillcast.llm.sketches import SketchSpec, WordHashes, band_keys, fill_sketch, near_duplicates, shingle_set, similar


def sets_of(texts, size=3):
    out = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        out.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    return out


def brute(pairs, percent=85, size=3):
    """(id, set size, least id reachable) with every pair of sets compared."""
    sets = sets_of([t for _, t in pairs], size)
    left, out = set(range(len(pairs))), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = [j for j in left if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
            left -= set(near)
            todo += near
        least = min((pairs[i][0] for i in group if pairs[i][0] is not None), default=None)
        out.update({i: least for i in group})
    return [(pairs[i][0], len(sets[i]), out[i]) for i in range(len(pairs))]


def test_every_coordinate_is_filled_and_estimates_the_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 1000, 20_000):
        assert (fill_sketch(rng.integers(0, 1 << 63, n).astype(np.uint64), 192, 7) < np.iinfo(np.uint64).max).all()
    for shared in (0.5, 0.85):
        got = []
        for _ in range(60):
            both, a, b = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (int(120 * shared), *[int(60 * (1 - shared))] * 2))
            x, y = np.unique(np.concatenate((both, a))), np.unique(np.concatenate((both, b)))
            true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            got.append((fill_sketch(x, 192, 7) == fill_sketch(y, 192, 7)).mean() - true)
        assert abs(np.mean(got)) < 0.02 and np.std(got) < 0.06


def test_the_rounds_are_those_of_one_at_a_time():
    """Hashing several rounds at once gives what round after round gives."""
    rng = np.random.default_rng(2)
    for n in (1, 3, 50):
        own = rng.integers(0, 1 << 63, n).astype(np.uint64)
        sketch = fill_sketch(own, 24, 7)
        rounds = (sketch >> np.uint64(32)).astype(int)
        assert rounds.max() < 48
        # No coordinate has a value of a later round than the one in which it could be filled last.
        assert all(r <= 24 + j for j, r in enumerate(rounds.tolist()))
        assert (fill_sketch(own[::-1], 24, 7) == sketch).all()


def test_similar_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (set(rng.sample(range(30), rng.randint(1, 30))) for _ in range(2))
        x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
        assert similar(x, y, 85) == (100 * len(a & b) >= 85 * len(a | b))


def test_shingles_equal_brute_force():
    known = WordHashes()
    for t in ("", " \t", "one", "One two", "a b c", "a b c a b c", "é É ß x\x0by\x0cz", "A b C " * 50):
        assert len(shingle_set(t.encode(), known, 3)) == len(sets_of([t])[0])
    assert (shingle_set(b"A B", known, 3) == shingle_set(b"a b", known, 3)).all()
    assert len({int(x) for t in (b"a", b"a a", b"a a a") for x in shingle_set(t, known, 3)}) == 3


def test_bands_of_different_places_differ():
    spec = SketchSpec()
    assert len(set(band_keys(np.zeros(spec.coordinates, dtype=np.uint64), spec).tolist())) == spec.bands


def corpus():
    rng = random.Random(2)
    pairs = [(100, None), (101, ""), (102, " \n"), (103, "ONE"), (104, "one"), (105, "One two"), (106, "a b c"), (107, "A b C")]
    k = 0
    for _ in range(25):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice((8, 30, 120, 400)))]
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice((0, 0.01, 0.03, 0.05, 0.1)))):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9999)}"
            pairs.append((k, " ".join(copy)))
            k += 1
    return pairs


@pytest.mark.parametrize("most", [1024, 2])
def test_components_equal_brute_force(spark, documents, most):
    pairs = corpus()
    pairs += [(None, pairs[10][1]), (None, "only without an id"), (3, pairs[11][1]), (3, pairs[11][1]), (108, pairs[9][1] + " " + "z " * 30_000)]
    rng = random.Random(5)
    rng.shuffle(pairs)
    docs = documents(pairs).withColumn("n", F.lit("clash")).withColumn("component_id", F.lit(-5)).withColumn("bands", F.lit(1))
    got = [tuple(r) for r in near_duplicates(docs, SketchSpec(most_per_cell=most)).collect()]
    want = [(i, n, c, i == c) for i, n, c in brute(pairs)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_one_large_family(spark, documents):
    """Hundreds of edited copies of one text: linked to the text or to each other, or only nearly similar."""
    rng = random.Random(8)
    base, pairs = [f"w{k}" for k in range(150)], []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(150)] = f"x{i}"
        pairs.append((i, " ".join(copy)))
    got = [tuple(r) for r in near_duplicates(documents(pairs), SketchSpec(most_per_cell=64)).collect()]
    assert sorted(got) == sorted((i, n, c, i == c) for i, n, c in brute(pairs))


def test_empty_table(spark, documents):
    assert near_duplicates(documents([])).collect() == []
