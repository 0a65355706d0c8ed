import random
import re
from collections import Counter

from pyspark.sql import functions as F

from refillcast.llm.rules import CoverSpec, Condition, decision_list, learn_rules, quality_verdicts, text_statistics


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_statistics_equal_brute_force(spark, documents):
    rng = random.Random(5)
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e", "a a a a a a", "é ü x\n\nx\n x\nx\n \n \n", "*** |<>|\n&&\n&&"]
    texts += [" ".join(rng.choices("ab cd ef\n #x".split(" "), k=rng.randint(1, 60))) for _ in range(60)]
    texts += [" ".join(f"w{i % 700}" for i in range(3000)), "x " * 5000]
    docs = documents(list(enumerate(texts)) + [(1, "again")]).withColumn("n_words", F.lit("clash"))
    got = text_statistics(docs).where("doc_id != 1").collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(
            texts[r["doc_id"]]), texts[r["doc_id"]]
    assert len(got) == len(texts) - 1


def statistics(spark, rows):
    columns = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_distinct long, n_lines long, n_exclaim long, n_upper long, base_failed boolean, bad boolean"
    return spark.createDataFrame(rows, columns)


def test_planted_rules_are_found(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        marks, calls = rng.randint(0, 20), rng.randint(0, 3)
        bad = i % 5 == 0
        if bad and i % 10:
            marks = rng.randint(120, 200)
        elif bad:
            calls = rng.randint(60, 90)
        rows.append((i, 100, 500, marks, 0, 0, 90, 10, calls, rng.randint(0, 40), False, bad))
    frame = statistics(spark, rows)
    rules = learn_rules(frame)
    assert 1 <= len(rules) <= 3
    got = quality_verdicts(frame, rules).collect()
    assert all(r["kept"] == (not r["bad"]) for r in got)


def test_one_outlier_does_not_hide_a_threshold(spark):
    """A labelled row with very many marks, and one very long word, leave the other rows told apart."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        calls = rng.randint(60, 90) if bad else rng.randint(0, 30)
        rows.append((i, 100, 500, 0, 0, 0, 90, 10, calls, 0, False, bad))
    rows += [(i, 10, 5_000_000, 0, 0, 0, 10, 1, 1_000_000, 0, False, True) for i in range(600, 603)]
    frame = statistics(spark, rows)
    got = quality_verdicts(frame, learn_rules(frame)).collect()
    assert all(r["kept"] == (not r["bad"]) for r in got)


def test_without_labels_only_base_rules_decide(spark):
    frame = statistics(spark, [])
    assert learn_rules(frame, CoverSpec()) == []
    assert quality_verdicts(frame, []).collect() == []


def test_first_matching_rule_rejects(spark):
    frame = statistics(spark, [(1, 10, 50, 5, 0, 0, 10, 1, 0, 0, False, True), (2, 10, 50, 0, 0, 0, 10, 1, 0, 0, True, None)])
    rules = [[Condition("symbol_share", True, 0.05), Condition("word_length", True, 4.0)]]
    assert [r["k"] for r in frame.orderBy("doc_id").select(decision_list(rules).alias("k")).collect()] == [False, True]
    assert [r["kept"] for r in quality_verdicts(frame, rules).orderBy("doc_id").collect()] == [False, False]
