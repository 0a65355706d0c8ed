"""Joins of the target with dimensions and feature frames.

No side is broadcast by hint: what these joins attach grows with the data. Adaptive execution
broadcasts a side whose measured size is small and splits partitions of a hot key otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillcast.operators.trailing import TARGET_KEY

_PART = "_join_part"


def join_hot(df: DataFrame, side: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join rows, a large share of which may carry one key, with a frame of few rows per key.

    Adaptive execution splits a hot partition only where both sides come straight from an
    exchange. A side that an aggregate has left partitioned by the key would skip its own, so
    the join also uses a second key, derived from the first, that makes it exchange.
    """
    part = F.pmod(F.xxhash64(key), F.lit(1 << 20))
    return df.withColumn(_PART, part).join(side.withColumn(_PART, part), [key, _PART], how).drop(_PART)


def join_dim(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, how: str = "left") -> DataFrame:
    """Attach a dimension on one key; duplicate dimension rows fan out."""
    if dim_key and dim_key != key:
        dim = dim.withColumnRenamed(dim_key, key)
    return join_hot(df, dim, key, how)


def join_features(
    target: DataFrame, *features: DataFrame, key: Sequence[str] = TARGET_KEY, how: str = "left"
) -> DataFrame:
    """Attach feature frames on the target key; NULL keys never match."""
    for frame in features:
        target = target.join(frame, list(key), how)
    return target


def require_all(df: DataFrame, *sides: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key every side knows, fanning out over duplicate side rows."""
    known = sides[0]
    for side in sides[1:]:
        known = known.join(side, key)
    return join_hot(df, known, key, "inner")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys carried by more than one row, with their row count: empty when the key is unique."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
