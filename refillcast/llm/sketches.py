"""MinHash near-duplicates with fast similarity sketching, banding and exact verification.

1. ``fill_sketch``: a document's set of word shingles becomes ``coordinates`` values. In each round every
   element of the set is hashed to one coordinate and a value; a coordinate keeps the least value of
   the earliest round that reached it. Rounds go on until every coordinate is filled; after
   ``coordinates`` random rounds, round ``coordinates + j`` puts all elements into coordinate j, so the filling
   ends. Two sets agree on a coordinate with the probability of their Jaccard similarity, and the
   share of agreeing coordinates is as concentrated as with independent ones, at the cost of a
   few rounds in place of one hash per element and coordinate.
2. Equal sets are one class. A band is ``rows`` coordinates in a row; classes with an equal band meet.
   At the threshold of 0.85, 32 bands of 6 miss a pair with probability (1 - 0.85^6)^32 < 3e-7.
3. In a bucket (classes with an equal band) every class is compared with the bucket's least one,
   the leader, and the most similar leader of each class is verified on the full sets. That joins groups of
   copies at a cost in proportion to their size.
4. Buckets that still hold more than one component are searched in cells: classes outside the bucket's
   largest component against all its classes, by size and sketch only. Of what may be similar
   a cell returns a spanning forest. The components of these forests are clusters, and within a cluster
   the full sets of every pair that is not joined yet are compared. No list of pairs leaves a cell.
5. Connected components of the verified links.

Buckets and clusters over ``most_per_cell`` rows are cut into parts; only the classes outside the largest
component are sent to every part. No link is lost by that.

Words: runs of other than space and \\t to \\r, A-Z lower-cased. A text of fewer words than a shingle has its
whole sequence as the only element. Defined results: null, empty and blank texts have an empty
set, are linked with nothing and are their own component; repeated rows stay; rows with a null id share
their class's component, which is the least id that is not null, and are kept where all ids of it are null;
rows with one id but different texts are linked each by its own text; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import as_bytes, bounded, staged
from refillcast.llm.components import connected_components
from refillcast.operators.joins import join_hot

_U = np.uint64


@dataclass(frozen=True)
class SketchSpec:
    shingle: int = 3
    #: Least similarity of a link, in percent.
    percent: int = 85
    bands: int = 32
    rows: int = 6
    seed: int = 7
    #: Pairs whose sketches agree on a smaller share are not verified: 5.8 standard deviations under 0.85.
    floor: float = 0.70
    most_per_cell: int = 1024
    #: Whether to join classes with the leaders they share most keys with, and to compare the sketches of each bucket, before
    #: anything else: for keys that meet by chance often.
    screen: bool = False
    #: So many leaders of a class are tried then; what they do not join is left to the buckets.
    most_leaders: int = 3

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def width(self) -> int:
        """Bytes of a sketch."""
        return self.coordinates

    @property
    def least(self) -> float:
        """Least closeness of pairs to be verified."""
        return self.floor * self.coordinates

    def closeness(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Coordinates on which sketches agree."""
        return (s == t).sum(axis=-1)

    def discards(self, sketches: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
        """A function that leaves those of some rows of a cell which may be close to one row; here, all."""
        return lambda rows, i: rows

    def summary(self, elements: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Keys under which the set meets others, and its sketch."""
        sketch = fill_sketch(elements, self.coordinates, self.seed)
        return band_keys(sketch, self), sketch.astype(np.uint8).tobytes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """Hash of a word; forgets all when it grows too large."""

    most = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, known: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, dtype=_U)
    single = np.fromiter(map(known.__getitem__, tokens), dtype=_U, count=len(tokens))
    width = min(size, len(tokens))
    count = len(tokens) - width + 1
    out = np.full(count, width, dtype=_U)
    for k in range(width):
        out = mixed(out ^ single[k : k + count]) + _U(k + 1)
    return np.unique(out)


def fill_sketch(elements: np.ndarray, coordinates: int, seed: int) -> np.ndarray:
    """The least value of each coordinate, its round in the upper half. The set is not empty.

    Several rounds are hashed at once: a later round never beats an earlier one, so those after the
    last coordinate was filled change nothing.
    """
    out = np.full(coordinates, np.iinfo(_U).max, dtype=_U)
    at, wide = 0, _U(coordinates)
    batch = max(1, min(2 * coordinates, -(-2048 // len(elements))))
    while at < 2 * coordinates:
        rounds = np.arange(at, min(at + batch, 2 * coordinates), dtype=_U)
        hashed = mixed(elements[None, :] ^ mixed(rounds + _U(seed << 20))[:, None])
        low = hashed & _U(0xFFFFFFFF)
        places = ((hashed >> _U(32)) * wide) >> _U(32)
        fixed = rounds >= wide
        places[fixed] = (rounds[fixed] - wide)[:, None]
        np.minimum.at(out, places.ravel().astype(np.int64), (low | (rounds[:, None] << _U(32))).ravel())
        at += batch
        if int(out.max()) != np.iinfo(_U).max:
            break
    return out


def band_keys(sketch: np.ndarray, spec: SketchSpec) -> np.ndarray:
    """One key per band; equal bands of different places have different keys."""
    rows = sketch.reshape(spec.bands, spec.rows)
    out = np.arange(spec.bands, dtype=_U)
    for k in range(spec.rows):
        out = mixed(out + rows[:, k])
    return out.view(np.int64)


def digest(elements: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(elements.tobytes())
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def set_sketches(docs: DataFrame, spec: SketchSpec = SketchSpec()) -> DataFrame:
    """Columns doc_id, n (size of the set), d1, d2 (its digest), bands (keys), sketch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in bounded(batches, "text"):
            sizes, digests, bands, bytes_ = [], [], [], []
            for text in as_bytes(batch.column("text")):
                own = shingle_set(text, known, spec.shingle)
                sizes.append(len(own))
                digests.append(digest(own))
                keys, sketch = spec.summary(own) if len(own) else (None, None)
                bands.append(keys)
                bytes_.append(sketch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                 pa.array([d[1] for d in digests], pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(bytes_, pa.binary())],
                ["doc_id", "n", "d1", "d2", "bands", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, d1 long, d2 long, bands array<long>, sketch binary")


def full_sets(docs: DataFrame, spec: SketchSpec) -> DataFrame:
    """Columns d1, d2, elements: the sorted hashes of each text's set, eight bytes each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in bounded(batches, "text"):
            sets = [shingle_set(text, known, spec.shingle) for text in as_bytes(batch.column("text"))]
            digests = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["d1", "d2", "elements"])

    return docs.select("text").mapInArrow(run, "d1 long, d2 long, elements binary")


def sizes_allow(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be as similar as that: the smaller one lies in the other at best."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def matrix_of(sketches: list[bytes], spec: SketchSpec) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(-1, spec.width)


class Forest:
    """Disjoint sets of 0, 1, ..."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def likely_leaders(pairs: DataFrame, spec: SketchSpec) -> DataFrame:
    """Columns u, v, agreeing of the pairs (u, v, nu, nv, su, sv) that sizes and sketches allow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("nu", "nv"))
            s, t = (matrix_of(batch.column(c).to_pylist(), spec) for c in ("su", "sv"))
            agreeing = spec.closeness(s, t).astype(np.int64)
            kept = np.flatnonzero(sizes_allow(n, m, spec.percent) & (agreeing >= spec.least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u").take(pa.array(kept)), batch.column("v").take(pa.array(kept)), pa.array(agreeing[kept])],
                ["u", "v", "agreeing"])

    return pairs.select("u", "v", "nu", "nv", "su", "sv").mapInArrow(run, "u long, v long, agreeing long")


def verified(pairs: DataFrame, sets: DataFrame, spec: SketchSpec) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                i for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b")))
                if similar(np.frombuffer(a.as_py(), dtype=_U), np.frombuffer(b.as_py(), dtype=_U), spec.percent)]
            yield batch.select(["u", "v"]).take(pa.array(kept, pa.int64()))

    whole = join_hot(join_hot(pairs, sets.toDF("u", "a"), "u", "inner"), sets.toDF("v", "b"), "v", "inner")
    return whole.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def frequent_leaders(met: DataFrame, spec: SketchSpec) -> DataFrame:
    """Pairs (u, v) of each class with the leaders it shares most keys with. A class has one row a key at most."""
    counts = met.where("node != leader").repartition("node").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("keys"))
    ranked = counts.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("keys", "leader")), asc=False).alias("led"))
    return ranked.select(F.col("node").alias("u"), F.explode(F.slice("led.leader", 1, spec.most_leaders)).alias("v"))


def leader_links(docs: DataFrame, led: DataFrame, known: DataFrame, spec: SketchSpec, sets: DataFrame | None = None) -> DataFrame:
    """Verified links (u, v) of classes with the most similar one of their leaders, one a class at most.

    Without ``sets``, the full sets of the classes that remain to be verified are read.
    """
    one = known.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    other = known.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
    likely = likely_leaders(join_hot(join_hot(led, one, "u", "inner"), other, "v", "inner"), spec)
    best = staged(likely.groupBy("u").agg(F.max(F.struct("agreeing", "v"))["v"].alias("v")), "sketch-led")
    if sets is None:
        ends = best.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        sets = staged(sets_of(docs, known.join(ends, "node", "left_semi"), spec), "sketch-led-sets")
    return staged(verified(best, sets, spec), "sketch-links")


def screened(met: DataFrame, placed: DataFrame, spec: SketchSpec) -> DataFrame:
    """The rows (key, node, leader) of buckets that size and sketch allow to be similar to one of another component.

    ``met`` has the number of rows of each bucket, ``placed`` the component of each class. Buckets of one component have no such
    rows; others over ``most_per_cell`` pass as they are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("held")
            flat, sizes = column.flatten(), np.diff(np.asarray(column.offsets))
            node, n, component = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "component"))
            sketches = matrix_of(flat.field("sketch").to_pylist(), spec)
            bucket = np.repeat(np.arange(len(sizes)), sizes)
            after = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(node)) - 1
            close = np.zeros(len(node), dtype=bool)
            # Every row with the one so many places after it, in all buckets at once.
            for d in range(1, int(sizes.max(initial=0))):
                i = np.flatnonzero(after >= d)
                i = i[(component[i] != component[i + d]) & sizes_allow(n[i], n[i + d], spec.percent)]
                i = i[spec.closeness(sketches[i], sketches[i + d]) >= spec.least]
                close[i] = close[i + d] = True
            kept = np.flatnonzero(close)
            least = np.full(len(sizes), np.iinfo(np.int64).max)
            np.minimum.at(least, bucket[kept], node[kept])
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (keys[bucket[kept]], node[kept], least[bucket[kept]])], ["key", "node", "leader"])

    known = join_hot(met, placed.select("node", "n", "sketch", "component"), "node", "inner")
    small = known.where(F.col("rows") <= spec.most_per_cell).groupBy("key").agg(
        F.collect_list(F.struct("node", "n", "sketch", "component")).alias("held"))
    mixed_cells = small.where(F.array_min("held.component") != F.array_max("held.component"))
    large = met.where(F.col("rows") > spec.most_per_cell)
    several = join_hot(large, placed.select("node", "component"), "node", "inner").groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b")).where("a != b")
    passed = join_hot(large, several.select("key", F.lit(True).alias("several")), "key", "inner").select("key", "node", "leader")
    return mixed_cells.mapInArrow(run, "key long, node long, leader long").unionByName(passed)


def dealt(rows: DataFrame, group: str, spec: SketchSpec) -> DataFrame:
    """Rows (group, node, component, ...) of the groups with more than one component, in cells.

    Column part is added, and ``seeks``: the row is to be compared with the others of its cell. Rows outside
    the largest component of a group seek, in every part of the group; the others lie in one part.
    """
    sizes = rows.groupBy(group, "component").agg(F.count(F.lit(1)).alias("rows"))
    groups = sizes.groupBy(group).agg(
        F.max(F.struct("rows", "component"))["component"].alias("largest"), F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("components")).where("components > 1")
    parts = staged(
        groups.select(group, "largest", F.ceil(F.col("rows") / spec.most_per_cell).cast("int").alias("parts")), "sketch-parts")
    seeks = F.col("component") != F.col("largest")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    met = join_hot(rows, parts, group, "inner").withColumn("seeks", seeks)
    return met.withColumn("part", F.explode(F.when(F.col("seeks"), everywhere).otherwise(F.array(own)))).drop("largest", "parts")


def gathered(cells: DataFrame, group: str, *columns: str) -> DataFrame:
    """One row per cell: lists of the columns, in one order."""
    packed = F.collect_list(F.struct("seeks", "node", "component", *columns)).alias("held")
    return cells.groupBy(group, "part").agg(packed).where(F.exists("held", lambda x: x["seeks"])).select(
        *[F.col(f"held.{c}").alias(c) for c in ("seeks", "node", "component", *columns)])


def cell_arrays(batch: pa.RecordBatch) -> Iterator[dict[str, list]]:
    for row in range(batch.num_rows):
        yield {name: batch.column(name)[row].as_py() for name in batch.schema.names}


class Cell:
    """The rows of a cell: which of them size and sketch allow to be similar to one."""

    def __init__(self, held: dict[str, list], spec: SketchSpec):
        self.n, self.sketches, self.spec = np.array(held["n"]), matrix_of(held["sketch"], spec), spec
        self.discards = spec.discards(self.sketches)

    def near(self, i: int) -> np.ndarray:
        """Possible rows, the closest first."""
        fits = self.discards(np.flatnonzero(sizes_allow(self.n, self.n[i], self.spec.percent)), i)
        closeness = self.spec.closeness(self.sketches[fits], self.sketches[i]).astype(np.int64)
        kept = np.flatnonzero(closeness >= self.spec.least)
        return fits[kept[np.argsort(-closeness[kept], kind="stable")]]


def possible_links(cells: DataFrame, spec: SketchSpec) -> DataFrame:
    """Columns u, v: per cell a spanning forest of what sizes and sketches allow across components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for cell in cell_arrays(batch):
                rows, component, forest = Cell(cell, spec), np.array(cell["component"]), Forest(len(cell["n"]))
                for i in np.flatnonzero(cell["seeks"]):
                    near = rows.near(i)
                    for j in near[component[near] != component[i]].tolist():
                        forest.join(int(i), j)
                roots, least = [forest.root(i) for i in range(len(cell["node"]))], {}
                for root, node in zip(roots, cell["node"]):
                    least[root] = min(least.get(root, node), node)
                # Links to the least node of a tree: those of the many buckets of one group are often the same.
                for root, node in zip(roots, cell["node"]):
                    if node != least[root]:
                        left.append(node)
                        right.append(least[root])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    return gathered(cells, "key", "n", "sketch").mapInArrow(run, "u long, v long").distinct()


def cell_links(cells: DataFrame, spec: SketchSpec) -> DataFrame:
    """Columns u, v: verified links that join all similar rows of each cell which are not of one component yet."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for cell in cell_arrays(batch):
                sets = [np.frombuffer(e, dtype=_U) for e in cell["elements"]]
                rows, forest, first = Cell(cell, spec), Forest(len(sets)), {}
                for i, c in enumerate(cell["component"]):
                    forest.join(i, first.setdefault(c, i))
                for i in np.flatnonzero(cell["seeks"]).tolist():
                    # The most similar first: later pairs are joined already, then.
                    for j in rows.near(i).tolist():
                        if forest.root(i) != forest.root(j) and similar(sets[i], sets[j], spec.percent):
                            forest.join(i, j)
                            left.append(cell["node"][i])
                            right.append(cell["node"][j])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    return gathered(cells, "cluster", "n", "sketch", "elements").mapInArrow(run, "u long, v long")


def sets_of(docs: DataFrame, classes: DataFrame, spec: SketchSpec) -> DataFrame:
    """Columns node, elements: the full set of each class (node, least_id, d1, d2), read from a document that has it.

    The ids grow with the input, so the join takes the same form at every size.
    """
    ids = classes.where("least_id is not null").select(F.col("least_id").alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text")
    chosen = texts.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))
    found = full_sets(chosen, spec).join(classes.select("node", "d1", "d2").hint("shuffle_hash"), ["d1", "d2"])
    # The rows of a digest lie in one partition already.
    return found.groupBy("d1", "d2", "node").agg(F.first("elements").alias("elements")).select("node", "elements")


def with_leaders(rows: DataFrame, links: DataFrame, doublings: int = 3) -> DataFrame:
    """The rows (node, ...) with ``component``: the leader at the end of their chain of links.

    A link leads to a lesser node and every node has one at most, so chains end. Doubling three times
    follows chains of eight links; a longer one gives a leader on the way, which is of the same component.
    """
    for _ in range(doublings):
        onward = links.select(F.col("u").alias("v"), F.col("v").alias("w"))
        links = staged(join_hot(links, onward, "v").select("u", F.coalesce("w", "v").alias("v")), "sketch-leaders")
    return join_hot(rows, links.toDF("node", "component"), "node").withColumn("component", F.coalesce("component", "node"))


def class_components(docs: DataFrame, classes: DataFrame, spec: SketchSpec = SketchSpec()) -> DataFrame:
    """Columns node, root: components of the links between classes of equal sets whose sets are similar enough.

    ``classes`` has node, n, d1, d2, bands, sketch and least_id, a document with that set. Classes without a
    bucket in common with others are not listed.
    """
    keyed = classes.select("node", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("leader")).where("rows > 1")
    met = staged(join_hot(keyed, buckets, "key", "inner").select("key", "node", "leader", "rows"), "sketch-buckets")
    early = None
    if spec.screen:
        early = leader_links(docs, frequent_leaders(met, spec), classes, spec)
        placed = staged(with_leaders(classes.select("node", "n", "sketch"), early), "sketch-early")
        met = staged(screened(met, placed, spec), "sketch-screened")
    nodes = met.select("node")
    if early is not None:
        nodes = nodes.unionByName(early.select(F.explode(F.array("u", "v")).alias("node")))
    nodes = staged(nodes.distinct(), "sketch-met")
    known = staged(classes.join(nodes, "node", "left_semi").select("node", "n", "sketch", "d1", "d2", "least_id"), "sketch-known")
    sought = known if early is None else known.join(met.select("node").distinct(), "node", "left_semi")
    sets = staged(sets_of(docs, sought, spec), "sketch-sets")

    led = met.where("node != leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    links = leader_links(docs, led, known, spec, sets)
    onward = links
    if early is not None:
        links = links.unionByName(early)
        onward = links.groupBy("u").agg(F.min("v").alias("v"))

    placed = staged(with_leaders(known.select("node", "n", "sketch"), onward), "sketch-placed")
    contested = join_hot(met.select("key", "node"), placed, "node", "inner")
    near = staged(possible_links(dealt(contested, "key", spec), spec), "sketch-near")
    clusters = connected_components(near, "sketch-clusters").select("node", F.col("root").alias("cluster"))
    inside = join_hot(join_hot(placed, staged(clusters, "sketch-clusters"), "node", "inner"), sets, "node", "inner")
    late = cell_links(dealt(inside, "cluster", spec), spec)
    # Links between leaders: of the late ones, and of chains that were not followed to their end.
    leader = placed.select(F.col("node").alias("u"), F.col("component").alias("a"))
    between = join_hot(join_hot(links.unionByName(late), leader, "u", "inner"), leader.toDF("v", "b"), "v", "inner")
    roots = staged(connected_components(between.where("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")), "sketch"), "sketch-roots")
    rooted = join_hot(placed.select("node", "component"), roots.toDF("component", "root"), "component")
    return rooted.select("node", F.coalesce("root", "component").alias("root"))


def near_duplicates(docs: DataFrame, spec: SketchSpec = SketchSpec()) -> DataFrame:
    """Columns doc_id, n_shingles, component_id (least document id reachable), kept.

    ``spec`` says what the sketches are; near copies by another kind of fingerprint have a spec of their own.
    """
    own = staged(set_sketches(docs, spec), "sketches")
    same = own.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    # Numbers are settled once the table is written.
    classes = staged(same.withColumn("node", F.monotonically_increasing_id()), "sketch-classes")
    roots = class_components(docs, classes, spec)
    rooted = staged(
        join_hot(classes.select("node", "d1", "d2", "least_id"), roots, "node")
        .select("d1", "d2", "least_id", F.coalesce("root", "node").alias("component")), "sketch-rooted")
    least = rooted.groupBy("component").agg(F.min("least_id").alias("component_id"))
    members = staged(join_hot(rooted, least, "component").select("d1", "d2", "component_id"), "sketch-members")
    part = F.pmod(F.col("d2"), F.lit(1 << 20)).alias("part")
    joined = own.select("doc_id", "n", "d1", "d2", part).join(
        members.select("d1", "d2", part, F.col("component_id")), ["d1", "d2", "part"], "left")
    component: Column = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
