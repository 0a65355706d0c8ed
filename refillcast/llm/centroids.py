"""Centroid clustering of whole-number vectors with built-in expressions.

A vector's components become integers, so that sums, distances and ties are exact. The centroids are
literal arrays in the plan: ``zip_with`` and ``aggregate`` give the squared distance to each, ``array_min``
of (distance, number) chooses the cluster, and the next centroids are column sums and a count per cluster.
A round is one aggregate with partial sums; what reaches the driver are clusters times components
numbers, however many rows a cluster has.

Defined results: vectors of another length than ``size``, with a null or non-finite component, or with one whose
integer is over ``largest`` in size (squared distances would not fit a long) are left out, as are null
vectors; repeated rows count each; start vectors that tie go by id and then by components; with fewer
vectors than clusters every vector starts a centroid; an empty table gives no rows; extra columns are
ignored; a null id is hashed as the text ``null``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import staged


@dataclass(frozen=True)
class CentroidSpec:
    clusters: int = 8
    rounds: int = 10
    size: int = 64
    scale: int = 1024
    seed: int = 3
    largest: int = 1 << 26


def whole_numbers(vectors: DataFrame, spec: CentroidSpec = CentroidSpec()) -> DataFrame:
    """Columns vec_id, v: floor(scale * x) of every component, of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    # A null component makes forall null; a comparison with NaN is false here.
    usable = F.forall(x, lambda c: ~F.isnan(c) & (F.abs(c) * spec.scale < float(spec.largest)))
    kept = vectors.where((F.size("embedding") == spec.size) & F.coalesce(usable, F.lit(False)))
    return kept.select("vec_id", F.transform(x, lambda c: F.floor(c * spec.scale)).alias("v"))


def starts(numbers: DataFrame, spec: CentroidSpec) -> list[list[int]]:
    """The vectors with the least hash of their id, in that order."""
    hashed = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = numbers.select(hashed.alias("h"), "vec_id", "v").orderBy("h", "vec_id", "v").limit(spec.clusters)
    return [list(r["v"]) for r in first.collect()]


def literal(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def nearest(centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid; ties go to the smaller number."""

    def distance(centroid: list[int]) -> Column:
        squares = F.zip_with("v", literal(centroid), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)

    return F.array_min(F.array(*[
        F.struct(distance(c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)]))


def moved(numbers: DataFrame, centroids: list[list[int]], spec: CentroidSpec) -> list[list[int]]:
    """The centroids after one round."""
    chosen = numbers.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = chosen.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(spec.size)])
    out = list(centroids)
    # At most one row per cluster.
    for row in sums.collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(spec.size)]
    return out


def fit_centroids(numbers: DataFrame, spec: CentroidSpec = CentroidSpec()) -> list[list[int]]:
    centroids = starts(numbers, spec)
    for _ in range(spec.rounds if centroids else 0):
        centroids = moved(numbers, centroids, spec)
    return centroids


def cluster(vectors: DataFrame, spec: CentroidSpec = CentroidSpec()) -> DataFrame:
    """Columns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    numbers = staged(whole_numbers(vectors, spec), "centroid-numbers")
    centroids = fit_centroids(numbers, spec)
    if not centroids:
        return numbers.where("false").selectExpr(
            "vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256")
    best = nearest(centroids)
    assigned = staged(numbers.select("vec_id", best.alias("b")).select("vec_id", "b.cluster", "b.distance"), "centroid-assigned")
    sums = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = F.col("cluster") + 1
    return assigned.select(
        "vec_id", "cluster", "distance",
        F.element_at(literal([sums.get(k, 0) for k in range(len(centroids))]), at).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, hashes)), at).alias("centroid_sha256"))


def oracle(spec: CentroidSpec = CentroidSpec()) -> str:
    """The same in SQL: rounds written out one after the other, components as rows."""
    rounds = []
    for k in range(spec.rounds + 1):
        rounds.append(f"""
a{k} as materialized (
  select vec_id, c as cluster, d as distance from (
    select n.vec_id, c.c, sum((n.x - c.x) * (n.x - c.x)) as d,
           row_number() over (partition by n.vec_id order by sum((n.x - c.x) * (n.x - c.x)), c.c) as r
    from n join c{k} c on n.i = c.i group by n.vec_id, c.c) where r = 1
)""")
        if k < spec.rounds:
            rounds.append(f"""
c{k + 1} as materialized (
  select old.c, old.i, coalesce(new.x, old.x) as x from c{k} old left join (
    select a.cluster as c, n.i, cast((sum(n.x) - ((sum(n.x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as x
    from a{k} a join n on n.vec_id = a.vec_id group by a.cluster, n.i) new on new.c = old.c and new.i = old.i
)""")
    last = spec.rounds
    return f"""
with kept as materialized (
  select vec_id, embedding from embeddings
  where len(embedding) = {spec.size}
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {spec.size}
), n as materialized (
  select vec_id, i, cast(floor({spec.scale} * cast(embedding[i] as double)) as bigint) as x
  from kept, range(1, {spec.size + 1}) t(i)
), c0 as materialized (
  select s.c, n.i, n.x from (
    select vec_id, row_number() over (order by sha256('{spec.seed}:' || vec_id)) - 1 as c from kept) s
  join n on n.vec_id = s.vec_id where s.c < {spec.clusters}
), {",".join(rounds)}, h as (
  select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as s from c{last} group by c
)
select a.vec_id, cast(a.cluster as int) as cluster, cast(a.distance as bigint) as distance,
       cast(sum(a.distance) over (partition by a.cluster) as bigint) as cluster_inertia,
       cast(sum(a.distance) over () as bigint) as inertia, h.s as centroid_sha256
from a{last} a join h on h.c = a.cluster"""
