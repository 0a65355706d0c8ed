"""Frequency counts, top-k labels and the slots they open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN_LABEL = "unknown"


def entity_counts(events: DataFrame, labels: Sequence[str], keep_null: bool = False) -> DataFrame:
    """Rows per label combination as ``n_rows``; NULL labels are dropped unless ``keep_null``."""
    if not keep_null:
        events = events.dropna(subset=list(labels))
    return events.groupBy(*labels).agg(F.count(F.lit(1)).alias("n_rows"))


def _frequency_order(labels: Sequence[str]) -> list[Column]:
    return [F.desc("n_rows"), *[F.asc_nulls_first(c) for c in labels]]


def top_k_entities(events: DataFrame, labels: Sequence[str], k: int, keep_null: bool = False) -> DataFrame:
    """The k most frequent labels; ties go to the smaller label, NULL first."""
    return entity_counts(events, labels, keep_null).orderBy(*_frequency_order(labels)).limit(k)


def rank_entities(top: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Number the rows of a top-k table 1..k by frequency.

    The window has one partition, so it belongs after the limit, where at most k rows are left.
    """
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_frequency_order(labels))))


def fed_ranks(ranked: DataFrame, match: str) -> DataFrame:
    """One row per matched label with the ranks it feeds; at most k rows.

    Several ranks may share a matched label: ids with one name, or the NULL label and the text
    that stands in for it. Events of that label then feed all of them.
    """
    label = F.coalesce(F.col(match), F.lit(UNKNOWN_LABEL)).alias("match_label")
    return ranked.groupBy(label).agg(F.collect_list("rank").alias("ranks"))


def densify(target: DataFrame, entities: DataFrame, k: int) -> DataFrame:
    """Every target row once per ranked entity (``entities`` has ``rank`` 1..k at most).

    The features do not go this way (see ``trailing.channel_totals``): its output is k times the target.
    """
    ranks = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank")
    return target.select("*", ranks).join(entities, "rank")
