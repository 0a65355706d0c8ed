"""Secret scan: known forms by pattern, other credentials by inferred grammars.

Three patterns (``assign``, ``access``, ``hex``) find credentials by their surroundings or form. The values they
find are the labelled credentials from which the grammars are inferred: per kind, a prefix tree of
character classes whose states are merged where their outgoing and ending frequencies are
statistically compatible (Hoeffding bound), giving a probabilistic automaton. A grammar of
ordinary runs of characters is inferred the same way. Every candidate run of every text is then
scored: its mean log likelihood per character under the best credential grammar, less that under the
ordinary one. A run that no pattern span overlaps is added, with kind ``format``, if that ratio
reaches the threshold and the run fits the grammar as well as the labelled values do.

The grammars are fitted on at most ``sample`` distinct values per kind, those with the least hash;
scanning and scoring cover whole texts of all documents.

Defined results: null texts count as empty; repeated rows stay; without labelled values nothing is
added; an empty table gives no rows; extra columns are ignored. Spans are code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import as_bytes, bounded, staged

KINDS = ("assign", "access", "hex")
#: Fixed forms of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: No match without one of these.
_STEMS = ("passw", "secret", "token", "key")
ORDINARY = "ordinary"


@dataclass(frozen=True)
class GrammarSpec:
    sample: int = 2000
    #: Confidence of the merge test: smaller merges more.
    alpha: float = 0.01
    #: Runs shorter than this are not candidates.
    shortest: int = 16
    #: Least log likelihood ratio per character (nats) over ordinary runs.
    threshold: float = 0.8
    #: Share of a kind's labelled values that may fit its grammar worse than a run that is added.
    misfit: float = 0.01
    #: Length up to which the prefix tree tells places apart.
    depth: int = 64


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, in order."""
    found = []
    low = text.lower()
    if any(s in low for s in _STEMS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def labelled_value(text: str, start: int, kind: int, end: int) -> str:
    return _ASSIGN.match(text, start, end)[2] if kind == 0 else text[start:end]


@lru_cache
def run_pattern(shortest: int) -> re.Pattern:
    return re.compile(rf"[A-Za-z0-9+/_=-]{{{shortest},}}")


def candidates(text: str, spans: list[tuple[int, int, int]], shortest: int) -> list[tuple[int, int]]:
    """Runs of credential characters, long enough and clear of every pattern span."""
    found, clear, reach, k = (m.span() for m in run_pattern(shortest).finditer(text)), [], 0, 0
    for a, b in found:
        # Spans and runs both go by start: the furthest end of the spans that start before the run's end.
        while k < len(spans) and spans[k][0] < b:
            reach, k = max(reach, spans[k][2]), k + 1
        if reach <= a:
            clear.append((a, b))
    return clear


def char_class(c: str) -> str:
    """Classes of the alphabet: hexadecimal and other letters by case, digits, marks."""
    if c.isdigit():
        return "0"
    if "a" <= c <= "f":
        return "a"
    if "g" <= c <= "z":
        return "z"
    if "A" <= c <= "F":
        return "A"
    return "Z" if "G" <= c <= "Z" else c


#: Characters of each class, for the chance of one of them.
SIZES = {"0": 10, "a": 6, "z": 20, "A": 6, "Z": 20}


class Automaton:
    """A deterministic probabilistic automaton over character classes."""

    def __init__(self, words: Iterable[str], spec: GrammarSpec):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        self.ends: list[int] = [0]
        for word in words:
            state = 0
            for c in map(char_class, word[: spec.depth]):
                self.count[state][c] += 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                    self.ends.append(0)
                state = self.next[state][c]
            self.ends[state] += 1
        self.merge(spec.alpha)

    def visits(self, state: int) -> int:
        return self.ends[state] + sum(self.count[state].values())

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether two states, and what follows them, could share their frequencies."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits(a), self.visits(b)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / n - self.count[b][c] / m) > bound:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for c, target in self.next[b].items():
                self.count[a][c] += self.count[b][c]
                if c in self.next[a]:
                    todo.append((self.next[a][c], target))
                else:
                    self.next[a][c] = target

    def merge(self, alpha: float) -> None:
        """Red states stay; each blue one (a child of a red state) is merged into the first compatible red one."""
        red, parent = [0], {t: (0, c) for c, t in self.next[0].items()}
        while parent:
            # The most visited blue state first: its frequencies are the surest.
            blue = max(parent, key=lambda s: (self.visits(s), -s))
            source, symbol = parent.pop(blue)
            for state in red:
                if self.compatible(state, blue, alpha):
                    self.next[source][symbol] = state
                    self.fold(state, blue)
                    break
            else:
                red.append(blue)
            reds = set(red)
            parent = {t: (s, c) for s in red for c, t in self.next[s].items() if t not in reds}
        # Keep what the start state reaches.
        at = {s: k for k, s in enumerate(red)}
        self.next = [{c: at[t] for c, t in self.next[s].items()} for s in red]
        self.count, self.ends = [self.count[s] for s in red], [self.ends[s] for s in red]

    def log_likelihood(self, word: str) -> float:
        """Per character, smoothed; unseen classes cost, and lead back to the start."""
        state, total = 0, 0.0
        for ch in word:
            c = char_class(ch)
            n = self.visits(state)
            share = (self.count[state][c] + 0.02) / (n + 0.02 * 12)
            total += math.log(share / SIZES.get(c, 1))
            state = self.next[state].get(c, 0)
        return total / max(len(word), 1)


def scan(docs: DataFrame, spec: GrammarSpec) -> DataFrame:
    """One pass over the texts: doc_id, base spans, labelled values, and candidate runs with their text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            base, labels, runs = [], [], []
            for raw in as_bytes(batch.column("text")):
                text = raw.decode("utf-8", "replace")
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "stop": b} for a, k, b in spans])
                labels.append([{"kind": k, "value": labelled_value(text, a, k, b)} for a, k, b in spans])
                runs.append([{"start": a, "value": text[a:b]} for a, b in candidates(text, spans, spec.shortest)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, BASE), pa.array(labels, LABELS), pa.array(runs, RUNS)],
                ["doc_id", "base", "labels", "runs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, base array<struct<start: int, kind: int, stop: int>>, "
             "labels array<struct<kind: int, value: string>>, runs array<struct<start: int, value: string>>")


BASE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
LABELS = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))
RUNS = pa.list_(pa.struct([("start", pa.int32()), ("value", pa.string())]))


def sampled(values: DataFrame, spec: GrammarSpec) -> list[tuple[str, str]]:
    """At most ``sample`` distinct (kind, value) per kind: those with the least hash.

    The hash first thins a kind to a few times the sample; what is left is ordered.
    """
    distinct = staged(values.groupBy("kind", "value").agg(F.xxhash64("value").alias("h")), "secret-values")
    out = []
    # One row per kind.
    for kind, n in sorted(map(tuple, distinct.groupBy("kind").count().collect())):
        own = distinct.where((F.col("kind") == kind) & (F.pmod("h", F.lit(n)) < 4 * spec.sample))
        out += [(kind, r["value"]) for r in own.orderBy("h", "value").limit(spec.sample).collect()]
    return sorted(out)


def infer(scanned: DataFrame, spec: GrammarSpec) -> dict[str, tuple[Automaton, float]]:
    """A grammar per kind and one of ordinary runs, from bounded samples; with the likelihood that
    all but a share of its own values reach."""
    labels = scanned.select(F.explode("labels").alias("l")).select(
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("l.kind") + 1).alias("kind"), "l.value")
    ordinary = scanned.select(F.explode("runs").alias("r")).select(F.lit(ORDINARY).alias("kind"), "r.value")
    words: dict[str, list[str]] = {}
    for kind, value in sampled(labels.unionByName(ordinary), spec):
        words.setdefault(kind, []).append(value)
    out = {}
    for kind, own in words.items():
        grammar = Automaton(own, spec)
        fits = sorted(map(grammar.log_likelihood, own))
        out[kind] = grammar, fits[int(spec.misfit * len(fits))]
    return out


def add_format_spans(scanned: DataFrame, grammars: dict[str, tuple[Automaton, float]], spec: GrammarSpec) -> DataFrame:
    """doc_id, base, and ``added``: (start, stop, kind, score) of the candidates that look like credentials."""
    known = [k for k in KINDS if k in grammars]

    def score(value: str) -> tuple[float, str]:
        """The best ratio among the kinds the value fits, minus infinity if it fits none."""
        usual = grammars[ORDINARY][0].log_likelihood(value)
        fits = [(grammars[k][0].log_likelihood(value), grammars[k][1], k) for k in known]
        return max([(fit - usual, k) for fit, floor, k in fits if fit >= floor], default=(-math.inf, ""))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for runs in batch.column("runs"):
                own = []
                for r in (runs.as_py() or []) if known and ORDINARY in grammars else []:
                    value, kind = score(r["value"])
                    if value >= spec.threshold:
                        own.append({"start": r["start"], "stop": r["start"] + len(r["value"]), "like": kind, "score": value})
                out.append(own)
            added = pa.list_(pa.struct([
                ("start", pa.int32()), ("stop", pa.int32()), ("like", pa.string()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base"), pa.array(out, added)], ["doc_id", "base", "added"])

    kind = scanned.schema["doc_id"].dataType.simpleString()
    return scanned.select("doc_id", "base", "runs").mapInArrow(
        run, f"doc_id {kind}, base array<struct<start: int, kind: int, stop: int>>, "
             "added array<struct<start: int, stop: int, like: string, score: double>>")


def find_secrets(docs: DataFrame, spec: GrammarSpec = GrammarSpec()) -> DataFrame:
    """Columns doc_id, base (start, kind number, stop) and added (start, stop, like, score)."""
    scanned = staged(scan(docs, spec), "secret-scan")
    return add_format_spans(scanned, infer(scanned, spec), spec)


def digest(found: DataFrame) -> DataFrame:
    """Counts and spans as text: ``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, [*KINDS, "format"]))

    def joined(spans):
        ordered = F.array_sort(spans)
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    extra = F.transform("added", lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["stop"].alias("stop")))

    def of_kind(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.size("added").cast("long").alias("n_format"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.concat(base, extra)).alias("spans"))
