"""Benchmark decontamination: rare n-gram seeds, then local alignment.

1. Every document's word n-grams are tested against a filter of fixed size that holds the hashes of the
   benchmark's n-grams. Around each hit a document keeps the words within the length of the longest item
   that has the n-gram; overlapping surroundings are one passage. All other text is left behind.
2. A passage's hits are cut into blocks, in their order, and of each block the ``rare`` ones that the fewest
   passages of the corpus have are its seeds. Which n-grams an edit leaves in a copy is not known
   beforehand, so rarity is a matter of the passage, not of the item: a passage that shares only frequent
   n-grams has these as seeds. Seeds meet the items in a join on the hash.
3. Each passage and item that share a seed are aligned word by word (Smith-Waterman: match 2,
   mismatch -1, gap -1). The score is the share of the best possible; edited copies lose by the edit.
   Pairs whose words in common cannot reach the threshold in any order are not aligned.

Words are lower-case runs of word characters, compared by 64-bit hashes. Defined results: null texts and texts or
items shorter than an n-gram match nothing; items with one id are one item, of which the best row counts, and items
with a null id are reported with a null; of a document's passages the best counts (ties: the first); rows that
share an id are one document; a null id is reported as null; an empty table on either side gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refillcast.llm.common import as_bytes, bounded, staged
from refillcast.operators.joins import join_hot

_WORDS = re.compile(r"\w+")
MATCH, MISMATCH, GAP = 2, -1, -1


@dataclass(frozen=True)
class DecontaminationSpec:
    n: int = 3
    #: Bits of the filter's address: its size does not depend on the benchmark's.
    filter_bits: int = 22
    #: Hits of a passage that are looked at together, and how many of them are seeds.
    block: int = 16
    rare: int = 4
    #: Least share of the best possible alignment score.
    threshold: float = 0.5


class WordHashes(dict):
    """Hash of a word; forgets all when it grows too large."""

    most = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) > self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value


def words(raw: bytes) -> list[str]:
    return _WORDS.findall(raw.decode("utf-8", "replace").lower())


def coded(raw: bytes, known: WordHashes) -> np.ndarray:
    """Hash of each word of a text."""
    tokens = words(raw)
    return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place."""
    if len(codes) < n:
        return np.zeros(0, dtype=np.uint64)
    count = len(codes) - n + 1
    out = codes[:count].copy()
    for k in range(1, n):
        out ^= out >> np.uint64(29)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[k : k + count]
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


def coded_items(benchmark: DataFrame, spec: DecontaminationSpec) -> DataFrame:
    """Columns item (a number), item_id, codes, grams (distinct n-grams), a row per row of the benchmark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            codes = [coded(raw, known) for raw in as_bytes(batch.column("text"))]
            grams = [np.unique(gram_hashes(c, spec.n)) for c in codes]
            lists = [pa.array([x.view(np.int64) for x in column], pa.list_(pa.int64())) for column in (codes, grams)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), *lists], ["item_id", "codes", "grams"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    coded_rows = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, codes array<long>, grams array<long>")
    return coded_rows.withColumn("item", F.monotonically_increasing_id())


def passages(docs: DataFrame, margins: np.ndarray, spec: DecontaminationSpec) -> DataFrame:
    """Columns doc_id, start (word), codes, grams: the hits that passed the filter, in their order.

    ``margins`` has, per slot of the filter, the length of the longest item with an n-gram there, 0 where there is none.
    """
    # Of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(margins)
    mask = np.uint64((1 << spec.filter_bits) - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wide = WordHashes(), shared.value
        for batch in bounded(batches, "text"):
            rows, owners = [], []
            for i, raw in enumerate(as_bytes(batch.column("text"))):
                codes = coded(raw, known)
                grams = gram_hashes(codes, spec.n)
                reach = wide[grams & mask]
                hits = np.flatnonzero(reach)
                if not len(hits):
                    continue
                reach = reach[hits].astype(np.int64)
                first, stop = np.maximum(hits - reach, 0), np.minimum(hits + spec.n + reach, len(codes))
                # Hits whose surroundings touch share a passage.
                cuts = np.flatnonzero(first[1:] > np.maximum.accumulate(stop)[:-1]) + 1
                # A later hit's surroundings may begin before an earlier one's.
                begins = np.minimum.accumulate(first[::-1])[::-1]
                for own in np.split(np.arange(len(hits)), cuts):
                    a, b = int(begins[own[0]]), int(stop[own].max())
                    rows.append((a, codes[a:b].view(np.int64), grams[hits[own]].view(np.int64)))
                    owners.append(i)
            start, held, grams = zip(*rows) if rows else ((), (), ())
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners, pa.int32())), pa.array(start, pa.int32()),
                 pa.array(held, kind), pa.array(grams, kind)],
                ["doc_id", "start", "codes", "grams"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start int, codes array<long>, grams array<long>")


def rare_seeds(found: DataFrame, grams: DataFrame, spec: DecontaminationSpec) -> DataFrame:
    """Columns passage, gram: of each block of a passage's hits those that the fewest passages have.

    ``grams`` has the benchmark's n-grams, which also removes what the filter let through wrongly.
    """
    hits = found.select("passage", F.posexplode("grams").alias("place", "gram"))
    frequency = staged(
        hits.groupBy("gram").agg(F.count(F.lit(1)).alias("seen")).join(grams.select("gram").distinct(), "gram"), "benchmark-seen")
    block = F.floor(F.col("place") / spec.block)
    rarest = Window.partitionBy("passage", block).orderBy("seen", "gram")
    ranked = join_hot(hits, frequency, "gram", "inner").withColumn("rank", F.dense_rank().over(rarest))
    return ranked.where(F.col("rank") <= spec.rare).select("passage", "gram").distinct()


def best_end(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman, one item word at a time over the whole passage: score, and the words of
    passage and item before the end of the best local alignment."""
    places = np.arange(len(passage) + 1) * -GAP
    above, best = np.zeros(len(passage) + 1, dtype=np.int64), (0, 0, 0)
    for i, word in enumerate(item):
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        # Gaps in the item: the best value to the left, less a gap per word between.
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + places) - places, 0)
        j = int(row.argmax())
        if row[j] > best[0]:
            best = int(row[j]), j, i + 1
        above = row
    return best


def align(passage: Sequence, item: Sequence, threshold: float = 0.0) -> tuple[float, int, int]:
    """Score as a share of the best possible, and the range of passage words aligned: empty below the threshold."""
    code: dict = {}
    a, b = (
        x if isinstance(x, np.ndarray) else np.array([code.setdefault(w, len(code)) for w in x], dtype=np.int64)
        for x in (passage, item))
    score, stop, item_stop = best_end(a, b)
    if not score or score < threshold * MATCH * len(item):
        return 0.0, 0, 0
    _, back, _ = best_end(a[:stop][::-1], b[:item_stop][::-1])
    return score / (MATCH * len(item)), stop - back, stop


def may_reach(passage: Sequence, item: Sequence, threshold: float) -> bool:
    """Whether an alignment can score the threshold; never false for one that does.

    Such an alignment has at least ``threshold`` matches per item word. Its other steps cost one each
    and its matches earn at most two per item word, so it covers at most 3 - 2 * threshold passage words
    per item word.
    """
    inside = np.concatenate(([0], np.cumsum(np.isin(np.asarray(passage), np.asarray(item)))))
    width = min(len(passage), math.ceil(len(item) * (3 - 2 * threshold)))
    return int((inside[width:] - inside[: len(inside) - width]).max()) >= threshold * len(item)


def alignments(pairs: DataFrame, threshold: float) -> DataFrame:
    """Score and word range for each pair (doc_id, start, codes, item_id, item); score 0 below the threshold."""
    kinds = dict(pairs.dtypes)

    def lists(column: pa.ListArray) -> list[np.ndarray]:
        values, ends = np.asarray(column.values), np.asarray(column.offsets)
        return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                align(a, b, threshold) if may_reach(a, b, threshold) else (0.0, 0, 0)
                for a, b in zip(lists(batch.column("codes")), lists(batch.column("item")))]
            first = batch.column("start").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array([f[0] for f in found], pa.float64()),
                 pa.array([s + f[1] for s, f in zip(first, found)], pa.int32()),
                 pa.array([s + f[2] for s, f in zip(first, found)], pa.int32())],
                ["doc_id", "item_id", "score", "first_word", "end_word"])

    return pairs.select("doc_id", "start", "codes", "item_id", "item").mapInArrow(
        run, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, score double, first_word int, end_word int")


def contaminated(docs: DataFrame, benchmark: DataFrame, spec: DecontaminationSpec = DecontaminationSpec()) -> DataFrame:
    """Columns doc_id, item_id, score, first_word, end_word: documents that hold an item, edited or not."""
    items = staged(coded_items(benchmark, spec), "benchmark-items")
    grams = items.select("item", F.size("codes").alias("n_words"), F.explode("grams").alias("gram"))
    margins = np.zeros(1 << spec.filter_bits, dtype=np.int32)
    # At most as many slots as the filter has.
    slot = F.col("gram").bitwiseAND(F.lit((1 << spec.filter_bits) - 1)).alias("slot")
    for row in grams.groupBy(slot).agg(F.max("n_words").alias("n_words")).collect():
        margins[row["slot"]] = row["n_words"]
    found = staged(passages(docs, margins, spec).withColumn("passage", F.monotonically_increasing_id()), "benchmark-passages")
    seeds = rare_seeds(found.select("passage", "grams"), grams, spec)
    pairs = staged(
        join_hot(seeds, grams.select("gram", "item"), "gram", "inner").select("passage", "item").distinct(), "benchmark-pairs")
    sought = join_hot(pairs, items.select("item", "item_id", F.col("codes").alias("sought")), "item", "inner")
    texts = sought.join(found.select("passage", "doc_id", "start", "codes"), "passage").select(
        "doc_id", "start", "codes", "item_id", F.col("sought").alias("item"))
    scored = alignments(texts, spec.threshold).where(F.col("score") >= spec.threshold)
    first = F.struct("score", (-F.col("first_word")).alias("before"), "first_word", "end_word")
    return scored.groupBy("doc_id", "item_id").agg(F.max(first).alias("b")).select(
        "doc_id", "item_id", "b.score", "b.first_word", "b.end_word")
