"""Membership pivots, wide/long conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_membership(df: DataFrame, key: str, label: str, values: Sequence[str]) -> DataFrame:
    """One row per key, one column per listed label with its number of rows, 0 where none.

    Rows without a key are dropped; rows without a label count under ``'null'`` if that is
    listed. The labels are listed, so no job has to discover them.
    """
    return (
        df.dropna(subset=[key])
        .withColumn(label, F.coalesce(label, F.lit("null")))
        .groupBy(key)
        .pivot(label, list(values))
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def pivot_features(
    long: DataFrame, key: Sequence[str], names: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Long (key, name, value) rows to one wide row per key, a column for every listed name."""
    return long.groupBy(*key).pivot(name, list(names)).agg(F.sum(value))


def unpivot_windows(
    wide: DataFrame, key: Sequence[str], cols: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Window columns to one (key, name, value) row each."""
    return wide.unpivot(list(key), list(cols), name, value)


def long_union(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked
