"""Toxicity scores by a classifier chain.

Categories are predicted one after the other by linear (logistic) models on hashed words, word
beginnings and coarse surface shares; a fit uses the features whose count among positive rows is
out of line with chance (log-likelihood ratio), so words that a few rows share by accident get no
weight. From the second on, a model also sees the log odds of all
earlier categories. In training those are out-of-fold: each labelled row gets them from a model
that has not seen the row, as later documents will.

The models are fitted on at most ``sample`` labelled rows, those with the least hash of their id;
the folds of a category are fitted side by side, one Spark task each, over rows bounded by that
parameter. Scoring covers every document and its whole text.

Defined results: null texts count as empty and are scored by the intercept; rows without a label in
some category are left out of that category's fit; a category with only one value in the sample
predicts that share; without labelled rows every probability is 0; repeated rows stay; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refillcast.llm.common import as_bytes, bounded, least_hashed, staged

_WORDS = re.compile(r"\w+")
_CUTS = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6])


@dataclass(frozen=True)
class ChainSpec:
    bits: int = 17
    #: Lengths of word beginnings that are features besides the whole word.
    beginnings: tuple[int, ...] = (4, 6)
    sample: int = 16_000
    folds: int = 4
    penalty: float = 0.02
    #: Least log-likelihood ratio of a feature with the category.
    evidence: float = 12.0
    steps: int = 60
    threshold: float = 0.5


def word_slots(word: str, spec: ChainSpec) -> tuple[int, ...]:
    mask = (1 << spec.bits) - 1
    parts = [word, *(f"{word[:n]}*" for n in spec.beginnings if len(word) >= n)]
    return tuple(zlib.crc32(p.encode()) & mask for p in parts)


def surface_slots(text: str, n_words: int, n_distinct: int, spec: ChainSpec) -> list[int]:
    """One slot per share and range: marks, capitals and repeated words."""
    n = max(len(text), 1)
    marks = n - sum(map(len, _WORDS.findall(text))) - text.count(" ") - text.count("\n")
    shares = (marks / n, sum(map(str.isupper, text)) / n, 1 - n_distinct / max(n_words, 1))
    mask = (1 << spec.bits) - 1
    return [zlib.crc32(f"share {k} {np.searchsorted(_CUTS, s)}".encode()) & mask for k, s in enumerate(shares)]


class Featurizer:
    """Slots of a text. Slots of words met before come from a table of bounded size."""

    def __init__(self, spec: ChainSpec, most: int = 200_000):
        self.spec, self.most, self.known = spec, most, {}

    def __call__(self, text: bytes) -> np.ndarray:
        plain = text.decode("utf-8", "replace")
        found = _WORDS.findall(plain.lower())
        distinct = set(found)
        if len(self.known) > self.most:
            self.known = {}
        known, slots = self.known, surface_slots(plain, len(found), len(distinct), self.spec)
        for word in distinct:
            own = known.get(word)
            if own is None:
                own = known[word] = word_slots(word, self.spec)
            slots.extend(own)
        return np.unique(np.array(slots, dtype=np.int32))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def minimise(loss, start: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a halving line search."""
    x, pairs = start, []
    value, grad = loss(x)
    for _ in range(steps):
        q, used = grad.copy(), []
        for s, y, r in reversed(pairs):
            a = r * (s @ q)
            q -= a * y
            used.append(a)
        if pairs:
            s, y, r = pairs[-1]
            q *= 1 / (r * (y @ y))
        else:
            q /= max(np.linalg.norm(grad), 1e-12)
        for (s, y, r), a in zip(pairs, reversed(used)):
            q += (a - r * (y @ q)) * s
        slope, step = grad @ q, 1.0
        while step > 1e-6:
            after, there = loss(x - step * q)
            if after <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = -step * q, there - grad
        if s @ y > 1e-10:
            pairs = [*pairs, (s, y, 1 / (s @ y))][-memory:]
        done = value - after < 1e-6 * max(1.0, abs(value))
        x, value, grad = x - step * q, after, there
        if done:
            break
    return x


def association(slots: np.ndarray, owner: np.ndarray, truth: np.ndarray, n_slots: int) -> np.ndarray:
    """Log-likelihood ratio of each slot's presence with the truth."""
    n, n_true = len(truth), truth.sum()
    both = np.bincount(slots[truth[owner] > 0], minlength=n_slots)
    seen = np.bincount(slots, minlength=n_slots)
    cells = [both, seen - both, n_true - both, (n - n_true) - (seen - both)]
    expected = [seen * n_true / n, seen * (n - n_true) / n, (n - seen) * n_true / n, (n - seen) * (n - n_true) / n]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * sum(np.where(c > 0, c * np.log(c / e), 0.0) for c, e in zip(cells, expected))


def fit_logistic(rows: list[np.ndarray], extra: np.ndarray, truth: np.ndarray, spec: ChainSpec) -> np.ndarray:
    """Weights: one per slot, one per earlier category, and the intercept last."""
    width = (1 << spec.bits) + extra.shape[1] + 1
    if not len(rows) or truth.min() == truth.max():
        weights = np.zeros(width)
        share = (truth.sum() + 0.5) / (len(truth) + 1) if len(rows) else 0.0
        weights[-1] = np.log(share / (1 - share)) if share else -30.0
        return weights
    n_slots = 1 << spec.bits
    # Four bytes an entry: these two arrays are what a fit needs most memory for.
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    slots = np.concatenate(rows, dtype=np.int32)
    chosen = np.flatnonzero(association(slots, owner, truth, n_slots) >= spec.evidence)
    column = np.full(n_slots, -1, dtype=np.int32)
    column[chosen] = np.arange(len(chosen), dtype=np.int32)
    slots = column[slots]
    used = slots >= 0
    slots, owner, n_chosen = slots[used], owner[used], len(chosen)

    def loss(w):
        z = np.bincount(owner, w[slots], len(truth)) + extra @ w[n_chosen:-1] + w[-1]
        off = sigmoid(z) - truth
        value = np.logaddexp(0, z).sum() - truth @ z + spec.penalty / 2 * (w[:-1] @ w[:-1])
        grad = np.concatenate([np.bincount(slots, off[owner], n_chosen), off @ extra, [off.sum()]])
        grad[:-1] += spec.penalty * w[:-1]
        return value, grad

    found = minimise(loss, np.zeros(n_chosen + extra.shape[1] + 1), spec.steps)
    weights = np.zeros(width)
    weights[chosen], weights[n_slots:] = found[:n_chosen], found[n_chosen:]
    return weights


def slots_frame(docs: DataFrame, spec: ChainSpec) -> DataFrame:
    """The frame with its text replaced by ``slots``; other columns stay."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer(spec)
        for batch in bounded(batches, "text"):
            slots = pa.array([featurize(t) for t in as_bytes(batch.column("text"))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), slots], [*kept, "slots"])

    kinds = dict(docs.dtypes)
    return docs.select(*kept, "text").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "slots array<int>"]))


def fold_fit(name: str, k: int, spec: ChainSpec) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Fit category ``name``, the k-th, without the rows of one fold; score the rows kept back."""
    n_slots = 1 << spec.bits

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", ignore_index=True)
        task = int(part["task"].iloc[0])
        held = (part["fold"] == task).to_numpy()
        used = ~held & part[name].notna().to_numpy()
        slots = [np.asarray(s, dtype=np.int32) for s in part["slots"]]
        odds = np.array([list(o) for o in part["odds"]], dtype=float).reshape(len(part), k)
        truth = part[name].to_numpy(dtype=float)[used]
        w = fit_logistic([slots[i] for i in np.flatnonzero(used)], odds[used], truth, spec)
        if task == spec.folds:
            return pd.DataFrame({"doc_id": [None], "odds": [None], "weights": [w]})
        scored = [
            [*odds[i], float(np.clip(w[slots[i]].sum() + odds[i] @ w[n_slots:-1] + w[-1], -30, 30))]
            for i in np.flatnonzero(held)]
        # Object columns, also where no row is held back: Arrow makes no lists of other ones.
        return pd.DataFrame({
            "doc_id": part["doc_id"][held].reset_index(drop=True), "odds": pd.Series(scored, dtype=object),
            "weights": pd.Series([None] * len(scored), dtype=object)})

    return fit


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], spec: ChainSpec = ChainSpec()) -> list[np.ndarray]:
    """One weight vector per category, in order. ``categories`` maps names to boolean label columns."""
    names = list(categories)
    # Ids and labels only, at most ``sample`` rows: small enough to broadcast.
    known = (
        labels.where("doc_id is not null")
        .select("doc_id", *[c.cast("double").alias(n) for n, c in categories.items()])
        .dropDuplicates(["doc_id"])
    )
    chosen = least_hashed(known, "doc_id", spec.sample)
    text = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    rows = staged(slots_frame(text, spec), "toxicity-sample")
    rows = rows.select("doc_id", "slots", *names, F.array().cast("array<double>").alias("odds"))
    out = []
    for k, name in enumerate(names):
        fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(spec.folds)).cast("int")
        # The last "fold" keeps nothing back: it is the model that scores documents.
        tasks = rows.withColumn("fold", fold).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(spec.folds))))

        kind = dict(rows.dtypes)["doc_id"]
        fitted = staged(
            tasks.groupBy("task").applyInPandas(fold_fit(name, k, spec), f"doc_id {kind}, odds array<double>, weights array<double>"),
            "toxicity-fit")
        models = fitted.where("weights is not null").select("weights").collect()
        width = (1 << spec.bits) + k + 1
        none = np.zeros(width)
        none[-1] = -30.0
        out.append(np.array(models[0]["weights"]) if models else none)
        rows = staged(rows.drop("odds").join(fitted.where("weights is null").select("doc_id", "odds"), "doc_id"), "toxicity-odds")
    return out


def score_chain(
    docs: DataFrame, names: list[str], models: list[np.ndarray], spec: ChainSpec = ChainSpec(),
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The kept columns and one probability per category (``p_`` and its name)."""
    n_slots = 1 << spec.bits
    # Of fixed size: a weight per slot and category.
    shared = docs.sparkSession.sparkContext.broadcast([m.astype(np.float32) for m in models])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize, weights = Featurizer(spec), shared.value
        for batch in bounded(batches, "text"):
            columns = [[] for _ in weights]
            for text in as_bytes(batch.column("text")):
                slots, odds = featurize(text), []
                for w, column in zip(weights, columns):
                    z = float(w[slots].sum() + w[-1] + sum(o * x for o, x in zip(odds, w[n_slots:-1])))
                    odds.append(min(max(z, -30.0), 30.0))
                    column.append(float(sigmoid(odds[-1])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(c, pa.float64()) for c in columns)],
                [*keep, *(f"p_{n}" for n in names)])

    kept = T.StructType([docs.schema[c] for c in keep])
    schema = reduce(lambda t, n: t.add(f"p_{n}", "double"), names, kept)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def toxicity(
    docs: DataFrame, labels: DataFrame, spec: ChainSpec = ChainSpec(), keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns, p_low_quality, p_toxic, rejected: the chain of both label columns."""
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    models = fit_chain(docs, labels, categories, spec)
    scored = score_chain(docs, list(categories), models, spec, keep)
    return scored.withColumn("rejected", F.col("p_toxic") >= spec.threshold)
