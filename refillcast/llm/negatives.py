"""Hard-negative mining with the threshold algorithm.

An anchor's score with a row is the inner product of their whole-number vectors. Of the rows with the
anchor's label the best ones are its positives; for each positive the best rows of other labels are
sought whose score lies in a window below the positive's.

1. Rows are dealt into blocks by the hash of their id. A block keeps one list of its rows per
   dimension, sorted by that component.
2. ``threshold_search``: an anchor reads all lists of a block in step, from the end that its component's sign
   makes best, and scores every row that turns up for the first time. The anchor's product with the
   components at the present depth (the threshold) bounds the score of every row not seen. Reading ends once the
   threshold is strictly below the k-th score found in each window, or below the window itself.
3. The blocks' best rows of an anchor and window are merged by a ranking in Spark.

Anchors are dealt into blocks as well, and each block of anchors meets each block of rows in a task of
bounded size: the work is that of a search of a query set against all rows. Ranks hold at most ``k`` rows
per anchor, window and block.

Defined results: rows with a null id, label or vector, with a null or non-finite component, or with a component
whose integer is over ``largest`` in size (products would not fit a long) take no part; a vector
shorter than the longest counts as if zeros followed; equal rows count once; rows that share an id but
differ are rows of their own, of which none is a positive or negative of an anchor with that id; ties go to
the smaller id, then the smaller label; an anchor without positives or a positive without negatives gives no row;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refillcast.llm.common import staged

Window_ = tuple[int, int]  # least and greatest score, both times 100


@dataclass(frozen=True)
class NegativeSpec:
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    #: A negative's score is at least this percentage of the positive's, and at most all of it.
    least_percent: int = 80
    rows_per_block: int = 4096
    anchors_per_block: int = 4096
    #: Rows read from each list before the threshold is looked at for the first time; doubles each time.
    first_depth: int = 16
    largest: int = 1 << 23


def usable(vectors: DataFrame, label: Column, spec: NegativeSpec = NegativeSpec()) -> DataFrame:
    """Columns row (a number), vec_id, label, v: whole components, padded to one length."""
    x = F.col("embedding").cast("array<double>")
    fine = F.coalesce(F.forall(x, lambda c: ~F.isnan(c) & (F.abs(c) * spec.scale < float(spec.largest))), F.lit(False))
    rows = vectors.select("vec_id", label.cast("long").alias("label"), "embedding").where(
        "vec_id is not null and label is not null and embedding is not null").where(fine)
    whole = rows.select("vec_id", "label", F.transform(x, lambda c: F.floor(c * spec.scale).cast("int")).alias("v")).distinct()
    numbered = staged(whole.withColumn("row", F.monotonically_increasing_id()), "negative-rows")
    size = numbered.agg(F.max(F.size("v"))).first()[0] or 1
    padding = F.array_repeat(F.lit(0), F.lit(size) - F.size("v"))
    return numbered.select("row", "vec_id", "label", F.concat("v", padding).alias("v"))


def threshold_search(
    values: np.ndarray, ascending: np.ndarray, anchor: np.ndarray, windows: list[Window_], k: int, first_depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows seen and their scores; the best k of every window are among them, with all their ties.

    ``ascending`` has, per dimension, the row numbers by growing component.
    """
    n = ascending.shape[1]
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    if not len(up) + len(down):
        # Every score is zero, and any list has all rows.
        return ascending[0], np.zeros(n, dtype=np.int64)
    seen, rows, scores = np.zeros(len(values), dtype=bool), [], []
    at, to = 0, min(first_depth, n)
    open_ = list(windows)
    while at < n:
        turned_up = np.concatenate([ascending[down, at:to].ravel(), ascending[up, n - to : n - at].ravel()])
        new = np.unique(turned_up[~seen[turned_up]])
        seen[new] = True
        rows.append(new)
        scores.append(values[new] @ anchor)
        threshold = int(anchor[up] @ values[ascending[up, n - to], up]) + int(anchor[down] @ values[ascending[down, to - 1], down])
        found = np.concatenate(scores)

        def settled(low: int, high: int) -> bool:
            if 100 * threshold < low:
                return True
            inside = found[(100 * found >= low) & (100 * found <= high)]
            return len(inside) >= k and int(np.partition(inside, len(inside) - k)[len(inside) - k]) > threshold

        open_ = [w for w in open_ if not settled(*w)]
        if not open_:
            break
        at, to = to, min(2 * to, n)
    return np.concatenate(rows), np.concatenate(scores)


def best_of(scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by falling score, then id, then label."""
    return np.lexsort((labels, ids, -scores))[:k]


def vectors_of(table: pa.Table, name: str) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=np.int64)


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def search_blocks(
    rows: DataFrame, anchors: DataFrame, same_label: bool, k: int, spec: NegativeSpec
) -> DataFrame:
    """Columns anchor, anchor_id, positive_id, positive_score, vec_id, label, score: each block's best k rows per window.

    ``anchors`` has row, vec_id, label, v and windows: (low, high, positive_id, positive_score) structs. With
    ``same_label`` rows of the anchor's label are searched, else the others.
    """
    n_blocks = max(1, -(-rows.count() // spec.rows_per_block))
    n_anchor_blocks = max(1, -(-anchors.count() // spec.anchors_per_block))
    block = F.pmod(F.xxhash64("vec_id", F.lit("rows")), F.lit(n_blocks)).cast("int")
    anchor_block = F.pmod(F.xxhash64("vec_id", F.lit("anchors")), F.lit(n_anchor_blocks)).cast("int")
    # Every block of anchors against every block of rows.
    left = rows.select("vec_id", "label", "v", block.alias("block")).withColumn(
        "anchor_block", F.explode(F.sequence(F.lit(0), F.lit(n_anchor_blocks - 1))))
    right = anchors.select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"),
        F.col("v").alias("anchor_v"), "windows", anchor_block.alias("anchor_block")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    names = ["anchor", "anchor_id", "positive_id", "positive_score", "vec_id", "label", "score"]

    def search(held: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[list[int]] = [[] for _ in names]
        if held.num_rows and asking.num_rows:
            values, ids, labels = vectors_of(held, "v"), numbers(held, "vec_id"), numbers(held, "label")
            ascending = np.argsort(values, axis=0, kind="stable").T
            lists: dict[int, np.ndarray] = {}
            own = zip(*(numbers(asking, c).tolist() for c in ("anchor", "anchor_id", "anchor_label")),
                      vectors_of(asking, "anchor_v"), asking.column("windows").to_pylist())
            for row, anchor_id, label, vector, windows in own:
                if label not in lists:
                    allowed = (labels == label) == same_label
                    lists[label] = ascending[allowed[ascending]].reshape(len(ascending), int(allowed.sum()))
                if not lists[label].shape[1]:
                    continue
                # The anchor itself may take one place of a block.
                at, scores = threshold_search(
                    values, lists[label], vector, [(w["low"], w["high"]) for w in windows], k + int(same_label), spec.first_depth)
                other = ids[at] != anchor_id
                at, scores = at[other], scores[other]
                for w in windows:
                    inside = np.flatnonzero((100 * scores >= w["low"]) & (100 * scores <= w["high"]))
                    best = inside[best_of(scores[inside], ids[at[inside]], labels[at[inside]], k)]
                    for place in best.tolist():
                        given = (row, anchor_id, w["positive_id"], w["positive_score"], ids[at[place]], labels[at[place]], scores[place])
                        for column, value in zip(out, given):
                            column.append(int(value))
        return pa.table([pa.array(c, pa.int64()) for c in out], names)

    # Columns of both sides have names of their own, as both come from one frame.
    right = right.select(F.col("block").alias("asked_block"), F.col("anchor_block").alias("asking_block"), *right.columns[:5])
    grouped = left.groupBy("block", "anchor_block").cogroup(right.groupBy("asked_block", "asking_block"))
    return grouped.applyInArrow(search, ", ".join(f"{n} long" for n in names))


def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best k rows of each key over all blocks, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, spec: NegativeSpec = NegativeSpec()) -> DataFrame:
    """Columns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` comes from ``usable``; ``is_anchor`` is a condition on vec_id and label.
    """
    rows = staged(rows, "negative-vectors")
    anchors = rows.where(is_anchor)
    # No score reaches these ends.
    end = 1 << 61
    everything = F.array(F.struct(
        F.lit(-end).alias("low"), F.lit(end).alias("high"), F.lit(0).cast("long").alias("positive_id"),
        F.lit(0).cast("long").alias("positive_score")))
    found = search_blocks(rows, anchors.withColumn("windows", everything), True, spec.positives, spec)
    positives = ranked(found, ["anchor"], spec.positives).where("score >= 0")
    window = F.struct(
        (F.col("score") * spec.least_percent).alias("low"), (F.col("score") * 100).alias("high"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # At most as many as positives are asked for.
    windows = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_set(window).alias("windows"))
    asking = staged(anchors.join(windows, "row"), "negative-anchors")
    mined = ranked(search_blocks(rows, asking, False, spec.negatives, spec),
                   ["anchor", "positive_id", "positive_score"], spec.negatives)
    return mined.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
