import random

import numpy as np
from pyspark.sql import functions as F

from refillcast.llm.decontaminate import DecontaminationSpec, align, contaminated, may_reach
from .brute import brute_score


def test_alignment_equals_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        a = rng.choices("abcdef", k=rng.randint(1, 30))
        b = rng.choices("abcdef", k=rng.randint(1, 12))
        score, first, stop = align(a, b)
        assert score == brute_score(a, b)
        assert brute_score(a[first:stop], b) == score


def test_pairs_that_are_not_aligned_stay_below_the_threshold():
    rng = random.Random(3)
    refused = 0
    for _ in range(2000):
        a = rng.choices("abcdefghijklmnop", k=rng.randint(1, 60))
        b = rng.choices("abcdefgh", k=rng.randint(1, 20))
        if not may_reach(a, b, 0.5):
            refused += 1
            assert brute_score(a, b) < 0.5
    assert refused > 100


def test_mass_edited_copies_beside_one_exact_copy(spark, documents):
    item = [f"t{k}" for k in range(12)]
    edited, short = [*item[:4], "edited", *item[5:]], item[5:]
    docs = [(i, " ".join([f"x{i}", *(edited if i % 2 else short), f"y{i}"])) for i in range(1000)] + [(1000, " ".join(item))]
    # A gram of the item that occurs elsewhere by chance.
    docs.append((1001, "a " + " ".join(item[9:]) + " b"))
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"] for r in contaminated(documents(docs), benchmark).collect()}
    assert got == set(range(1001))


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(600)]
    # Frequent words, so that n-grams also meet by chance.
    weights = [1 / (k + 1) for k in range(600)]
    prose = lambda n: rng.choices(vocabulary, weights, k=n)
    items = [[f"t{rng.randint(0, 400)}" if rng.random() < 0.6 else w for w in prose(rng.randint(12, 40))] for _ in range(12)]
    docs, want = [], set()
    for i in range(160):
        words = prose(rng.randint(20, 200))
        if i % 4 == 0:
            k = rng.randrange(len(items))
            copy = list(items[k])
            if i % 8 == 0:
                for _ in range(len(copy) // 7):
                    copy[rng.randrange(len(copy))] = "edited"
            at = rng.randint(0, len(words))
            words[at:at] = copy
            want.add((i, k))
        docs.append((i, " ".join(words)))
    # A passage in very many documents keeps its seeds.
    for i in range(200, 400):
        docs.append((i, " ".join(prose(10) + items[0] + prose(10)).upper()))
        want.add((i, 0))
    return docs, [(k, " ".join(w).title() + ".") for k, w in enumerate(items)], want


def test_planted_copies_are_found_and_nothing_else(spark, documents):
    docs, items, want = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("clash"))
    got = contaminated(documents(docs).withColumn("start", F.lit("clash")), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= want
    # Every pair of all documents and items, scored by brute force.
    plain = [(k, t.lower().replace(".", "").split()) for k, t in items]
    whole = {(i, k) for i, t in docs for k, item in plain if may_reach(t.lower().split(), item, 0.5) and align(t.lower().split(), item)[0] >= 0.5}
    assert {(r["doc_id"], r["item_id"]) for r in got} == whole and len(got) == len(whole)
    text = dict(docs)
    for r in got:
        words = text[r["doc_id"]].lower().split()
        item = dict(items)[r["item_id"]].lower().replace(".", "").split()
        assert brute_score(words, item) >= 0.5
        assert brute_score(words[r["first_word"] : r["end_word"]], item) >= 0.5


def test_odd_rows(spark, documents):
    item = "one two three four five six seven"
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one"), (None, "alpha beta gamma delta"), (1, item)], "item_id long, text string")
    docs = documents([(1, item), (1, item), (None, f"x {item} y"), (3, None), (4, ""), (5, "one " * 50_000), (6, "z " * 30_000 + item), (7, "one"), (8, "so alpha beta gamma delta it goes")])
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, benchmark).collect()}
    assert got == {(1, 1), (None, 1), (6, 1), (8, None)}


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert contaminated(documents([]), benchmark).collect() == []
    assert contaminated(documents([(1, "a b c d")]), benchmark.where("false")).collect() == []
    assert DecontaminationSpec().n == 3 and np.isclose(align(["a"], ["a"])[0], 1.0)
