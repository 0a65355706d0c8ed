"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal texts form a group. Light groups are put together into parcels by the hash of
their text; a group heavier than a mean parcel is counted in several parcels, dealt by the hash of
its document ids, so that no task has to number a whole hot group. A group stays in one shard unless
it would fill more than ``group_share`` of it; a heavier one is cut into such pieces. Pieces and
parcels, heaviest first, go to the shard where the dot product of their vector with the residual
capacity is highest. The number of parcels is bounded by the parameters, whatever the input's size:
only their sums reach the driver.

The law of this operator is ``bytes``: sizes are near equal. Defined results: a null text has size 8 and the
checksum of no bytes; null and repeated document ids are rows like others; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refillcast.llm.common import SPACE, staged, text_of

DIMENSIONS = ("size", "tokens", "n")


@dataclass(frozen=True)
class PackSpec:
    n_shards: int = 24
    #: Mean number of parcels a shard gets; bounds what the driver packs.
    parcels_per_shard: int = 256
    #: The share of a shard that one group may fill before it is cut.
    group_share: float = 0.25
    #: Weight of bytes, tokens and rows in the dot product.
    weights: tuple[float, float, float] = (2.0, 1.0, 1.0)


def measured(docs: DataFrame) -> DataFrame:
    """Per document: size, tokens, checksum and the hash of its text."""
    text = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.size(F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), SPACE)))
        .otherwise(0).cast("long").alias("tokens"),
        F.xxhash64(text).alias("text_hash"),
        F.lit(1).cast("long").alias("n"),
    )


def pack(vectors: np.ndarray, n_shards: int, weights: tuple[float, float, float]) -> np.ndarray:
    """Shard of each parcel: heaviest first, highest dot product with the residual capacity."""
    totals = np.maximum(vectors.sum(0), 1)
    scaled = vectors / totals * n_shards
    residual = np.ones((n_shards, vectors.shape[1]))
    shards = np.zeros(len(vectors), dtype=np.int64)
    weight = np.asarray(weights)
    for i in np.lexsort((np.arange(len(vectors)), -scaled[:, 0])):
        shards[i] = np.argmax(residual @ (scaled[i] * weight))
        residual[shards[i]] -= scaled[i]
    return shards


def even_out(vectors: np.ndarray, shards: np.ndarray, n_shards: int, rounds: int = 2000) -> np.ndarray:
    """Move or swap parcels between the heaviest and the lightest shard while their bytes get closer."""
    shards, size = shards.copy(), vectors[:, 0].astype(float)
    loads = np.bincount(shards, size, n_shards)
    for _ in range(rounds):
        high, low = int(loads.argmax()), int(loads.argmin())
        gap = loads[high] - loads[low]
        ours, theirs = np.flatnonzero(shards == high), np.flatnonzero(shards == low)
        order = theirs[np.argsort(size[theirs], kind="stable")]
        partner_size = np.concatenate([[0.0], size[order]])
        # For each of the heavy shard's parcels, the partner that brings the move nearest to half the gap.
        at = np.clip(np.searchsorted(partner_size, size[ours] - gap / 2), 0, len(partner_size) - 1)
        moved = size[ours] - partner_size[at]
        left = np.where((moved > 0) & (moved < gap), np.abs(gap - 2 * moved), gap)
        if not len(left) or left.min() >= gap:
            break
        k = int(left.argmin())
        shards[ours[k]] = low
        if at[k]:
            shards[order[at[k] - 1]] = high
        loads[high] -= moved[k]
        loads[low] += moved[k]
    return shards


def pieces(keys: list[tuple[int, int]], vectors: np.ndarray, most: np.ndarray) -> np.ndarray:
    """What is placed as one: a parcel of light groups, or parcels of one heavy group up to ``most``."""
    unit, group, load, out = -1, None, 0.0, []
    for (a, b), vector in zip(keys, vectors):
        share = float((vector / most).max())
        if b < 0 or a != group or load + share > 1:
            unit, group, load = unit + 1, a if b >= 0 else None, 0.0
        load += share
        out.append(unit)
    return np.array(out, dtype=np.int64)


def shard_documents(docs: DataFrame, spec: PackSpec = PackSpec()) -> DataFrame:
    """Columns: doc_id, size, text_crc32, tokens, law, shard, slot (gapless from 0), grown_shard (null)."""
    spark = docs.sparkSession
    rows = staged(measured(docs), "shard-rows")
    n_parcels = spec.n_shards * spec.parcels_per_shard
    sums = [F.sum(c).alias(c) for c in DIMENSIONS]
    totals = rows.agg(*sums).first()
    # A group of more than a mean parcel in any dimension is dealt over several: at most
    # len(DIMENSIONS) * n_parcels such groups can exist, so the frame is small enough to broadcast.
    limits = {c: max(1, (totals[c] or 0) // n_parcels) for c in DIMENSIONS}
    over = F.greatest(*[F.col(c) / F.lit(limits[c]) for c in DIMENSIONS])
    heavy = (
        rows.groupBy("text_hash").agg(*sums)
        .where((over > 1) & (F.col("n") > 1))
        .select("text_hash", F.least(F.ceil(over), F.col("n")).cast("long").alias("parts"))
    )
    part = F.pmod(F.xxhash64("doc_id", "text_hash"), F.col("parts"))
    parcel = F.when(F.col("parts").isNotNull(), F.struct(F.col("text_hash").alias("a"), part.alias("b"))).otherwise(
        F.struct(F.pmod(F.xxhash64("text_hash"), F.lit(n_parcels)).alias("a"), F.lit(-1).cast("long").alias("b")))
    dealt = rows.join(F.broadcast(heavy), "text_hash", "left").withColumn("p", parcel).select(
        "doc_id", "size", "text_crc32", "tokens", "n", F.col("p.a").alias("pa"), F.col("p.b").alias("pb"))
    # A heavy group has fewer than twice as many parts as mean parcels fit into it: at most
    # (1 + 2 * len(DIMENSIONS)) * n_parcels rows in all.
    weighed = dealt.groupBy("pa", "pb").agg(*sums).orderBy("pa", "pb").collect()
    vectors = np.array([[r[c] for c in DIMENSIONS] for r in weighed], dtype=np.float64).reshape(-1, len(DIMENSIONS))
    most = np.maximum(vectors.sum(0), 1) / spec.n_shards * spec.group_share
    unit = pieces([(r["pa"], r["pb"]) for r in weighed], vectors, most)
    units = np.zeros((int(unit.max(initial=-1)) + 1, len(DIMENSIONS)))
    np.add.at(units, unit, vectors)
    shards = even_out(units, pack(units, spec.n_shards, spec.weights), spec.n_shards)[unit]
    filled, places = [0] * spec.n_shards, []
    for r, shard in zip(weighed, shards.tolist()):
        places.append((r["pa"], r["pb"], shard, filled[shard]))
        filled[shard] += r["n"]
    schema = T.StructType([
        T.StructField("pa", T.LongType()), T.StructField("pb", T.LongType()),
        T.StructField("shard", T.IntegerType()), T.StructField("base", T.LongType())])
    in_parcel = Window.partitionBy("pa", "pb").orderBy("doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("row", F.row_number().over(in_parcel) - 1)
        .join(F.broadcast(spark.createDataFrame(places, schema)), ["pa", "pb"])
        .select(
            "doc_id", "size", "text_crc32", "tokens", F.lit("bytes").alias("law"), "shard",
            (F.col("base") + F.col("row")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
