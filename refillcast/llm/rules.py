"""Quality rules: an ordered decision list learned by sequential covering.

``text_statistics`` counts, per document, what the rules look at. ``learn_rules`` grows conjunctions
of thresholds on labelled statistics, one at a time: the condition with the highest information gain
over the rows still covered is added until no bad example would be lost, then conditions are pruned
from the end on rows kept back from growing, and the rows the rule covers are put aside. Candidate
thresholds are counted in Spark (one aggregate per condition); only the counts reach the driver.
``decision_list`` is the list as one conditional expression. Only built-in functions are used.

Defined results: null texts count as empty; an empty table, or one without labels, gives no
rules, and then only the base rules decide; labels of unknown documents and null labels are left
out; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import text_of, words_of

WINDOW = 5
MIN_WORDS = 10
MOST_REPEATED = 20

#: What the rules may look at: shares, so that one threshold fits short and long documents.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "exclaim_share": "n_exclaim / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words inside windows of five that stand twice or more in the text.

    Windows are compared by a 64-bit hash. Most texts repeat none: they stop at the count of
    distinct hashes. The others sort (hash, place) once and add what each repeated window covers.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def places(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
            lambda x: x["i"])))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(places(h), covered))))


def text_statistics(docs: DataFrame) -> DataFrame:
    """Columns: doc_id and the counts the base rules and the learned rules use."""
    text = text_of()
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select("doc_id", text.alias("text")).select("doc_id", "text", words_of(F.col("text")).alias("words"))

    def counted(words: Column) -> Column:
        joined = F.array_join(words, "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(joined).cast("long").alias("word_chars"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        )

    stats = split.select(
        "doc_id",
        let(F.col("words"), counted).alias("w"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    )
    counts = stats.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "w.n_distinct",
        "l.n_lines", "n_exclaim", "n_upper")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class CoverSpec:
    #: Cells of about equal numbers of labelled rows, between whose borders thresholds are sought.
    cells: int = 64
    most_rules: int = 8
    most_conditions: int = 3
    #: A rule must be right on at least this share of the rows kept back, and cover so many bad ones.
    precision: float = 0.95
    least_bad: int = 3


def conjunction(conditions: list[Condition]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def decision_list(rules: list[list[Condition]]) -> Column:
    """False where the first matching rule rejects, true where none matches."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(conjunction(rule), F.lit(False)).otherwise(out)
    return out


def gain(bad: float, good: float, all_bad: float, all_good: float) -> float:
    """Information gained about the bad rows by narrowing to (bad, good)."""
    if bad == 0:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def best_condition(rows: DataFrame, spec: CoverSpec) -> tuple[Condition, float] | None:
    """The threshold with the highest gain, from one aggregate of cell counts.

    Cells lie between quantiles of the rows that are left, so outliers do not widen them. A cell's own least and
    largest values are counted with it: the threshold is the middle between a cell and the next one.
    """
    values = {name: F.expr(text).cast("double") for name, text in FEATURES.items()}
    shares = F.array(*[F.lit(k / spec.cells) for k in range(1, spec.cells)])
    borders = rows.agg(*[F.percentile_approx(v, shares, F.lit(100 * spec.cells)).alias(n) for n, v in values.items()]).first()
    cells = []
    for name, value in values.items():
        inner = sorted(set(borders[name] or []))
        if not inner:
            continue
        # The number of borders below the value: a value equal to a border belongs to the cell below it.
        cell = sum(((value > F.lit(b)).cast("int") for b in inner), F.lit(0))
        cells.append(F.struct(F.lit(name).alias("feature"), cell.alias("cell"), value.alias("value")))
    if not cells:
        return None
    # At most len(FEATURES) * cells rows.
    found = (
        rows.select("bad", F.explode(F.array(*cells)).alias("c"))
        .groupBy("c.feature", "c.cell").agg(
            F.sum(F.col("bad").cast("long")).alias("bad"), F.count(F.lit(1)).alias("n"),
            F.min("c.value").alias("lo"), F.max("c.value").alias("hi"))
        .collect()
    )
    best = None
    for name in FEATURES:
        own = sorted((r["cell"], r["bad"], r["n"] - r["bad"], r["lo"], r["hi"]) for r in found if r["feature"] == name)
        all_bad, all_good = sum(r[1] for r in own), sum(r[2] for r in own)
        bad = good = 0
        for (_, b, g, _, hi), following in zip(own, own[1:]):
            bad, good = bad + b, good + g
            # Neighbouring doubles have no middle of their own; the lower one separates them as well.
            cut = (hi + following[3]) / 2
            cut = cut if cut < following[3] else hi
            for above, x, y in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                value = gain(x, y, all_bad, all_good)
                if best is None or value > best[1] + 1e-9:
                    best = (Condition(name, above, cut), value)
    return best if best and best[1] > 0 else None


def judged(rows: DataFrame, rules: list[list[Condition]]) -> list[tuple[int, int]]:
    """(bad, good) rows that each rule covers, in one aggregate."""
    out = rows.agg(*[
        F.coalesce(F.sum((conjunction(r) & (F.col("bad") == v)).cast("long")), F.lit(0)).alias(f"r{k}_{v}")
        for k, r in enumerate(rules) for v in (True, False)]).first()
    return [(out[f"r{k}_True"], out[f"r{k}_False"]) for k in range(len(rules))]


def learn_rules(labelled: DataFrame, spec: CoverSpec = CoverSpec()) -> list[list[Condition]]:
    """Rules for the bad rows of labelled statistics (boolean ``bad``), by sequential covering.

    Two thirds of the rows grow a rule, the others prune and judge it.
    """
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    grow, prune, rules = labelled.where(fold != 0), labelled.where(fold == 0), []
    while len(rules) < spec.most_rules:
        left = decision_list(rules)
        rule, rows = [], grow.where(left)
        while len(rule) < spec.most_conditions:
            step = best_condition(rows, spec)
            if step is None:
                break
            rule.append(step[0])
            rows = rows.where(step[0].column())
            if not judged(rows, [[]])[0][1]:
                break
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        counts = judged(prune.where(left), prefixes)
        scores = [(bad - good) / (bad + good) if bad + good else -1.0 for bad, good in counts]
        k = scores.index(max(scores))
        bad, good = counts[k]
        if bad < spec.least_bad or bad < spec.precision * (bad + good):
            break
        rules.append(prefixes[k])
    return rules


def quality_verdicts(stats: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """The statistics with ``kept``: false where a base rule fails, else what the list says."""
    return stats.withColumn("kept", ~F.col("base_failed") & decision_list(rules))
