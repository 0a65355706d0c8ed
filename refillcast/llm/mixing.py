"""Mixing to target weights with soft membership.

A classifier, fitted on labelled documents, gives every document a posterior over the domains.
``fit_rates`` then finds a rate (expected number of copies) per document: the nonnegative rates for
which the expected tokens of each domain, sum of rate * tokens * posterior, match the targets, by
projected gradient descent on the squared differences. The gradient with respect to a document's
rate needs only its own posterior and one number per domain. Rates therefore depend on the posterior alone,
and an iteration is one aggregate over the distinct posteriors, of which there are at most as many as
combinations of the classifier's ranges (512 * 6^domains, whatever the input). Up to ``most_cells`` of them, tokens summed
per posterior, are what reaches the driver, where a step is an array expression and no job; more stay in a table, and then only
the sums reach it. Documents are read once to be scored and once to be given their rate.

The classifier is naive Bayes over ranges of surface shares and of counts of telling words. Word
list and tables come from at most ``sample`` labelled documents, those with the least hash of their
id; posteriors and totals cover all documents. Only built-in functions touch the rows.

Defined results: null texts have no tokens, rate as the classifier says, and no weight in the totals; labels
of unknown documents and null domains are left out; domains without labelled documents are left out and the other targets
rescaled; without any label every document keeps rate 1; repeated rows stay; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import SPACE, least_hashed, staged, text_of

#: Upper ends of the ranges of a share, and of a count of telling words.
SHARE_CUTS = (0.0, 0.01, 0.03, 0.06, 0.12, 0.25, 0.5)
COUNT_CUTS = (0, 1, 2, 4, 8)


@dataclass(frozen=True)
class MixSpec:
    sample: int = 8000
    #: Telling words kept for each domain.
    telling: int = 200
    #: Least log-likelihood ratio of a telling word.
    evidence: float = 20.0
    tolerance: float = 1e-6
    #: Ten steps that lower the squared differences by less than this share are slow: from then on steps
    #: carry momentum, and once they are slow with it, nothing more is to be gained.
    gain: float = 0.02
    #: Up to so many distinct posteriors the descent runs on arrays of them; more are moved and added up across the cluster.
    most_cells: int = 200_000
    #: Steps after which the rates are written then, so that expressions stay short.
    steps_per_write: int = 10
    #: An end to the descent, for trials; none unless given.
    most_steps: int | None = None


def lowered(text: Column) -> Column:
    return F.split(F.lower(text), SPACE)


def sample_of(docs: DataFrame, labels: DataFrame, spec: MixSpec) -> DataFrame:
    """doc_id, domain, text of the labelled documents the classifier is fitted on."""
    known = labels.where("doc_id is not null and domain is not null").dropDuplicates(["doc_id"])
    chosen = least_hashed(known, "doc_id", spec.sample)
    # Ids and labels only, bounded by the sample.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "domain")), "doc_id")
    return staged(joined, "mix-sample")


def telling_words(sample: DataFrame, domains: list[str], spec: MixSpec) -> dict[str, list[str]]:
    """For each domain the words over-represented in it, strongest first."""
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    words = sample.select("domain", F.explode(F.array_distinct(lowered(text_of()))).alias("word")).where("word != ''")
    seen = words.groupBy("word").agg(
        F.count(F.lit(1)).alias("seen"), *[F.sum((F.col("domain") == d).cast("long")).alias(f"in{k}") for k, d in enumerate(domains)])
    seen = staged(seen.where("seen >= 3"), "mix-words")
    out = {}
    for k, domain in enumerate(domains):
        own, inside = sizes[domain], F.col(f"in{k}")

        def part(count: Column, expected: Column) -> Column:
            return F.when(count > 0, count * F.ln(count / expected)).otherwise(0.0)

        total = F.col("seen")
        ratio = 2 * (
            part(inside, total * own / n) + part(total - inside, total * (n - own) / n)
            + part(own - inside, (n - total) * own / n) + part((n - own) - (total - inside), (n - total) * (n - own) / n))
        ranked = (
            seen.where(inside * n > total * own).select("word", ratio.alias("ratio"))
            .where(F.col("ratio") >= spec.evidence).orderBy(F.desc("ratio"), "word").limit(spec.telling))
        out[domain] = [r["word"] for r in ranked.collect()]
    return out


def ranged(value: Column, cuts: tuple) -> Column:
    """Number of the range a value is in."""
    return reduce(lambda acc, c: acc + (value > F.lit(c)).cast("int"), cuts, F.lit(0))


def surface(docs: DataFrame, telling: dict[str, list[str]], *keep: str) -> DataFrame:
    """The kept columns, n_tokens, and ``ranges``: the range numbers the classifier looks at."""
    base = docs.select(*keep, text_of().alias("text")).select(*keep, "text", lowered(F.col("text")).alias("words"))
    counted = base.select(
        *keep,
        F.char_length("text").alias("chars"),
        F.size(F.filter("words", lambda w: w != "")).alias("n_tokens"),
        F.size(F.array_distinct("words")).alias("distinct"),
        F.size("words").alias("size"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("marks"),
        F.regexp_count("text", F.lit(r"!")).alias("calls"),
        *[F.size(F.array_intersect("words", F.array(*map(F.lit, w)).cast("array<string>"))).alias(f"told{k}")
          for k, w in enumerate(telling.values())],
    )
    chars = F.greatest("chars", F.lit(1))
    shares = [F.col("marks") / chars, F.col("calls") / chars, 1 - F.col("distinct") / F.col("size")]
    ranges = [ranged(s, SHARE_CUTS) for s in shares]
    ranges += [ranged(F.col(f"told{k}"), COUNT_CUTS) for k in range(len(telling))]
    return counted.select(*keep, F.col("n_tokens").cast("long").alias("n_tokens"), F.array(*ranges).alias("ranges"))


def fit_posteriors(sample: DataFrame, domains: list[str], telling: dict[str, list[str]]) -> tuple[list[float], list[list[list[float]]]]:
    """Log prior per domain, and log probability per feature, range and domain (add-one)."""
    rows = staged(surface(sample, telling, "domain").select("domain", "ranges"), "mix-ranges")
    sizes = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    # Domains times features times ranges.
    cells = rows.select("domain", F.posexplode("ranges").alias("f", "r")).groupBy("domain", "f", "r").count().collect()
    found = {(r["domain"], r["f"], r["r"]): r["count"] for r in cells}
    n_ranges = [len(SHARE_CUTS) + 1] * 3 + [len(COUNT_CUTS) + 1] * len(telling)
    prior = [math.log(sizes[d] / sum(sizes.values())) for d in domains]
    table = [
        [[math.log((found.get((d, f, r), 0) + 1) / (sizes[d] + n)) for d in domains] for r in range(n)]
        for f, n in enumerate(n_ranges)]
    return prior, table


def posteriors(docs: DataFrame, domains: list[str], telling, prior, table, *keep: str) -> DataFrame:
    """The kept columns, n_tokens, and p0, p1, ...: the posterior of each domain."""
    out = surface(docs, telling, *keep)

    def log_score(k: int) -> Column:
        terms = [
            F.element_at(F.array(*[F.lit(row[k]) for row in rows]), F.element_at("ranges", f + 1) + 1)
            for f, rows in enumerate(table)]
        return reduce(lambda a, b: a + b, terms, F.lit(prior[k]))

    scored = out.select(*keep, "n_tokens", *[log_score(k).alias(f"s{k}") for k in range(len(domains))])
    top = F.greatest(*[F.col(f"s{k}") for k in range(len(domains))]) if len(domains) > 1 else F.col("s0")
    lifted = scored.select(*keep, "n_tokens", *[F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in range(len(domains))])
    total = reduce(lambda a, b: a + b, [F.col(f"e{k}") for k in range(len(domains))])
    return lifted.select(*keep, "n_tokens", *[(F.col(f"e{k}") / total).alias(f"p{k}") for k in range(len(domains))])


def rate_after(moves: list[tuple[list[float], float]]) -> str:
    """SQL of the rate ``r`` and the momentum's point ``y`` of a posterior after the moves, from its columns r and y.

    A move has a number per domain and a momentum: a rate goes down by the numbers weighed with the posterior,
    from where the momentum of the move before has carried it, but not below the floor.
    """
    if not moves:
        return "named_struct('r', r, 'y', y)"
    steps = ", ".join(
        "named_struct(" + ", ".join(f"'g{k}', {g!r}D" for k, g in enumerate(numbers)) + f", 'b', {b!r}D)" for numbers, b in moves)
    down = " + ".join(f"p{k} * s.g{k}" for k in range(len(moves[0][0])))
    rate = f"greatest(floor, a.y - ({down}))"
    return (
        f"aggregate(array({steps}), named_struct('r', r, 'y', y), "
        f"(a, s) -> named_struct('r', {rate}, 'y', {rate} + s.b * ({rate} - a.r)))")


class TableRates:
    """Rates of a frame of cells (distinct posteriors p0, ..., floor, tokens), moved and added up across the cluster."""

    def __init__(self, held: DataFrame, n: int, spec: MixSpec):
        self.held, self.n, self.spec = held.selectExpr("*", "1.0D as r", "1.0D as y"), n, spec
        self.moves: list[tuple[list[float], float]] = []

    def measured(self) -> tuple[list[float], list[float], float]:
        """Expected tokens per domain at the rates and at the momentum's points, and the product of
        the last move's gradient and direction: positive if it went uphill."""
        moves, domains = self.moves, range(self.n)
        gradient = moves[-1][0] if moves else [0.0 for _ in domains]
        row = (
            self.held.selectExpr("*", f"{rate_after(moves)} as a", f"{rate_after(moves[:-1])}.r as r0")
            .selectExpr(
                *[f"sum(tokens * a.r * p{k}) as r{k}" for k in domains], *[f"sum(tokens * a.y * p{k}) as y{k}" for k in domains],
                f"sum(tokens * (a.r - r0) * ({' + '.join(f'p{k} * {gradient[k]!r}D' for k in domains) or '0.0D'})) as uphill")
            .first())
        values = [float(v or 0.0) for v in row]
        return values[: self.n], values[self.n : 2 * self.n], values[-1]

    def move(self, numbers: list[float], momentum: float) -> None:
        if len(self.moves) == self.spec.steps_per_write:
            columns = [*[f"p{k}" for k in range(self.n)], "floor", "tokens"]
            written = self.held.selectExpr(*columns, f"{rate_after(self.moves)} as a")
            self.held, self.moves = staged(written.selectExpr(*columns, "a.r", "a.y"), "mix-rates"), []
        self.moves.append((numbers, momentum))

    def restart(self) -> None:
        """Take the momentum back from the last move."""
        self.moves[-1] = (self.moves[-1][0], 0.0)

    def rates(self) -> DataFrame:
        return self.held.selectExpr(*[f"p{k}" for k in range(self.n)], "floor", f"{rate_after(self.moves)}.r as rate")


class ArrayRates:
    """The same of at most ``most_cells`` cells, in arrays: a step is no job of its own then."""

    def __init__(self, held: DataFrame, n: int):
        self.spark, self.names = held.sparkSession, [*[f"p{k}" for k in range(n)], "floor"]
        table = held.select(*self.names, "tokens").toArrow()
        cells = np.stack([table.column(c).fill_null(0.0).to_numpy() for c in table.column_names], axis=1)
        cells = cells[np.lexsort(cells.T)]
        self.p, self.floor, self.tokens = cells[:, :n], cells[:, n], cells[:, n + 1]
        self.r = self.y = self.before = np.ones(len(cells))
        self.gradient = np.zeros(n)

    def measured(self) -> tuple[list[float], list[float], float]:
        uphill = float((self.tokens * (self.r - self.before) * (self.p @ self.gradient)).sum())
        return ((self.tokens * self.r) @ self.p).tolist(), ((self.tokens * self.y) @ self.p).tolist(), uphill

    def move(self, numbers: list[float], momentum: float) -> None:
        self.before, self.gradient = self.r, np.array(numbers)
        self.r = np.maximum(self.floor, self.y - self.p @ self.gradient)
        self.y = self.r + momentum * (self.r - self.before)

    def restart(self) -> None:
        self.y = self.r

    def rates(self) -> DataFrame:
        columns = [*self.p.T, self.floor, self.r]
        return self.spark.createDataFrame(pa.table([pa.array(c, pa.float64()) for c in columns], [*self.names, "rate"]))


def descend(held: DataFrame, targets: list[float], spec: MixSpec) -> tuple[DataFrame, list[float], bool]:
    """The frame of distinct posteriors (p0, ..., floor, tokens) with their rate, the expected tokens per domain,
    and whether these meet the targets."""
    domains = range(len(targets))
    rates = ArrayRates(held, len(targets)) if held.count() <= spec.most_cells else TableRates(held, len(targets), spec)
    now, at, _ = rates.measured()
    size, whole = [max(v, 1e-9) for v in now], max(sum(targets), 1.0)
    step, pace, hurried, errors = 0, 1.0, None, []
    while True:
        met = max((abs(now[k] - targets[k]) for k in domains), default=0.0) <= spec.tolerance * whole
        errors.append(sum((now[k] - targets[k]) ** 2 / size[k] for k in domains))
        slow = step >= 10 and errors[-1] > (1 - spec.gain) * errors[-11]
        if slow and hurried is None:
            hurried = step
        if met or step == spec.most_steps or slow and step >= hurried + 20:
            return rates.rates(), now, met
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2 if hurried is not None else 1.0
        momentum = (pace - 1) / faster
        rates.move([(at[k] - targets[k]) / size[k] for k in domains], momentum)
        step, pace = step + 1, faster
        now, at, uphill = rates.measured()
        if uphill > 0 and momentum > 0:
            # Momentum led uphill: the next move starts from the rates themselves.
            rates.restart()
            pace, at = 1.0, now


def fit_rates(scored: DataFrame, targets: list[float], spec: MixSpec = MixSpec(), least: Column | None = None) -> tuple[DataFrame, list[float]]:
    """The frame with ``rate`` and ``converged``, and the expected tokens per domain that the rates give.

    ``targets`` are tokens per domain (columns p0, p1, ...). Squared differences are weighed by one
    over the domain's tokens, and a rate's step by one over the document's: for this scaling a step of one
    never overshoots, whatever the input. ``least`` (0 unless given, 1 at most) is the least rate of a
    document. The descent ends when the targets are met to the tolerance, or when twenty or more steps with
    momentum no longer lower the squared differences: then such rates don't reach the targets, and ``converged`` is
    false. Momentum is used once plain steps become slow, and is started anew whenever it leads uphill.

    Documents with one posterior share their rate, so the descent runs on the tokens summed per posterior.
    """
    keys = [*[f"p{k}" for k in range(len(targets))], "floor"]
    floored = scored.withColumn("floor", (F.lit(0.0) if least is None else least).cast("double"))
    summed = floored.groupBy(*keys).agg(F.sum("n_tokens").cast("double").alias("tokens"))
    rates, reached, met = descend(staged(summed, "mix-vectors"), targets, spec)
    rated = floored.join(staged(rates, "mix-rates"), keys).drop("floor")
    return rated.withColumn("converged", F.lit(met)), reached


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], spec: MixSpec = MixSpec(),
        whole: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns: the kept ones, n_tokens, p_<domain>, rate, copies, converged.

    ``labels`` has doc_id and domain; ``weights`` the target share of tokens per domain. The target
    total is the input's tokens or, with ``whole``, the total at which that domain's tokens stay as many
    as they are; documents whose likeliest domain it is then keep a rate of 1 or more. ``copies`` rounds the
    rate up or down by the hash of the id, in the long run as often as the rate says.
    """
    sample = sample_of(docs, labels.where(F.col("domain").isin(list(weights))), spec)
    present = {r["domain"] for r in sample.select("domain").distinct().collect()}
    domains = [d for d in weights if d in present]
    if not domains:
        none = docs.select(*keep, F.size(F.filter(lowered(text_of()), lambda w: w != "")).cast("long").alias("n_tokens"))
        return none.select("*", *[F.lit(0.0).alias(f"p_{d}") for d in weights], F.lit(1.0).alias("rate"), F.lit(1).alias("copies"), F.lit(True).alias("converged"))
    telling = telling_words(sample, domains, spec)
    prior, table = fit_posteriors(sample, domains, telling)
    scored = staged(posteriors(docs, domains, telling, prior, table, *keep), "mix-posteriors")
    found = scored.agg(*[F.sum(F.col("n_tokens") * F.col(f"p{k}")).alias(f"t{k}") for k in range(len(domains))]).first()
    held = [float(v or 0.0) for v in found]
    shares = [weights[d] / sum(weights[d] for d in domains) for d in domains]
    total, least = sum(held), None
    if whole in domains:
        own = domains.index(whole)
        total = held[own] / shares[own]
        likeliest = reduce(lambda a, b: a & b, [F.col(f"p{own}") >= F.col(f"p{k}") for k in range(len(domains))])
        least = F.when(likeliest, 1.0).otherwise(0.0)
    rated, _ = fit_rates(scored, [total * s for s in shares], spec, least)
    chance = F.pmod(F.xxhash64(*keep, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    columns = [F.col(f"p{domains.index(d)}") if d in domains else F.lit(0.0) for d in weights]
    return rated.select(
        *keep, "n_tokens", *[c.alias(f"p_{d}") for c, d in zip(columns, weights)], "rate",
        F.floor(F.col("rate") + chance).cast("int").alias("copies"), "converged")


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labels table: toxic, low (quality 0) or clean; null labels count as 0 and 1."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean")
    return labels.select("doc_id", domain.alias("domain"))


#: Target shares of tokens.
WEIGHTS = {"clean": 0.9, "low": 0.07, "toxic": 0.03}
