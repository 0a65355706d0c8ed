"""SimHash near-duplicates: 64-bit fingerprints, linked at three or fewer differing bits.

1. ``fingerprints``: per document, a majority vote of the hashes of its word shingles.
2. ``fingerprint_links``: equal fingerprints are one. Two fingerprints that differ in at most
   ``radius`` bits agree on all bits of at least ``blocks - radius`` of the blocks, so each is put
   under one key per choice of that many blocks, and only rows with an equal key meet. Within a key,
   a table of Hamming distances to fixed reference fingerprints (pivots) is computed once per
   row; a pair whose distances to any pivot differ by more than the radius is discarded unseen (triangle
   inequality), and the survivors are verified on the fingerprints themselves.
3. ``near_duplicates``: connected components of the links; every document gets the least id.

``near_copies`` links documents by the similarity of their shingles instead, with fingerprints wide enough for 0.8.

A key with more rows than ``most_per_cell`` is cut into parts, and each pair of parts is a cell of
its own: no task holds a whole hot key, and no link is lost. A cell returns a spanning forest of
its links (fewer rows than it was given), never the pairs of a group.

Defined results: null, empty and blank texts have fingerprint zero and link like any other; repeated
rows stay; rows with a null id keep their component, whose id is the least id that is not null; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.llm import sketches
from refillcast.llm.common import as_bytes, bounded, staged
from refillcast.llm.components import connected_components
from refillcast.llm.sketches import SketchSpec, band_keys, fill_sketch, mixed
from refillcast.operators.joins import join_hot

BITS = 64


@dataclass(frozen=True)
class SimHashSpec:
    shingle: int = 3
    seed: int = 42
    radius: int = 3
    #: Blocks the bits are cut into; a key is made of ``blocks - radius`` of them.
    blocks: int = 6
    n_pivots: int = 16
    most_per_cell: int = 2048


def fingerprint(text: bytes, size: int, seed: int) -> int:
    """Bit k is one where more than half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < size:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(s), seed) for s in zip(*(words[k:] for k in range(size)))]
    votes, step = np.zeros(BITS, dtype=np.int64), 1 << 16
    for at in range(0, len(hashes), step):
        part = np.frombuffer(b"".join(hashes[at : at + step]), dtype=np.uint8).reshape(-1, 8)
        votes += np.add.reduce(np.unpackbits(part, axis=1), axis=0, dtype=np.int64)
    # unpackbits and the digest both put the highest bit first.
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """Columns doc_id, fp (the fingerprint's bits as a long)."""
    size, seed = spec.shingle, spec.seed

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            fp = [fingerprint(text, size, seed) for text in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def block_masks(blocks: int) -> list[int]:
    """The bits of each block, as signed longs; blocks differ by one bit in length at most."""
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]


def signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def keys(fp: Column, spec: SimHashSpec) -> Column:
    """One key per choice of blocks: the choice's number and the bits of its blocks."""
    masks = block_masks(spec.blocks)
    return F.array(*[
        F.struct(F.lit(k).cast("short").alias("choice"), fp.bitwiseAND(F.lit(signed(sum(chosen)))).alias("bits"))
        for k, chosen in enumerate(combinations(masks, spec.blocks - spec.radius))
    ])


def pivots(n: int, seed: int) -> np.ndarray:
    """Reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(k.to_bytes(8, "little"), seed) for k in range(n)], dtype=np.uint64)


def spanning_links(fps: np.ndarray, table: np.ndarray, radius: int, strip: int = 256) -> list[tuple[int, int]]:
    """(row, row) links that join the rows of each component of one cell.

    Rows are ordered by their distance to the first pivot, so a strip of rows meets only rows
    within the radius of it; the other pivots thin the pairs before bits are compared.
    """
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    first, parent = table[:, 0], np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for a in range(0, len(fps), strip):
        b = min(a + strip, len(fps))
        end = int(np.searchsorted(first, first[b - 1] + radius, "right"))
        near = np.abs(table[a:b, None, 0] - table[None, a:end, 0]) <= radius
        for p in range(1, table.shape[1]):
            near &= np.abs(table[a:b, None, p] - table[None, a:end, p]) <= radius
        i, j = np.nonzero(near)
        i, j = i[j > i], j[j > i]
        linked = np.bitwise_count(fps[a + i] ^ fps[a + j]) <= radius
        i, j = a + i[linked], a + j[linked]
        # A row needs one link to each component it touches: skip pairs already joined.
        while len(i):
            roots = np.array([root(k) for k in range(len(parent))]) if len(i) > len(parent) else None
            if roots is not None:
                apart = roots[i] != roots[j]
                i, j = i[apart], j[apart]
            step = min(len(i), max(64, len(parent)))
            for x, y in zip(i[:step].tolist(), j[:step].tolist()):
                x0, y0 = root(x), root(y)
                if x0 != y0:
                    parent[max(x0, y0)] = min(x0, y0)
                    out.append((int(order[x]), int(order[y])))
            i, j = i[step:], j[step:]
    return out


def link_cells(spec: SimHashSpec) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = pivots(spec.n_pivots, spec.seed)
        for batch in batches:
            left, right = [], []
            column = batch.column("fps")
            values = np.asarray(column.values).view(np.uint64)
            ends = np.asarray(column.offsets)
            for a, b in zip(ends[:-1], ends[1:]):
                fps = values[a:b]
                table = np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)
                for i, j in spanning_links(fps, table, spec.radius):
                    left.append(fps[i])
                    right.append(fps[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (left, right)], ["u", "v"])

    return run


def fingerprint_links(distinct: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints (column fp) within the radius of each other."""
    keyed = staged(
        distinct.select("fp", F.explode(keys(F.col("fp"), spec)).alias("k")).select("fp", "k.choice", "k.bits"),
        "simhash-keys")
    counts = keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = staged(
        counts.select("choice", "bits", F.ceil(F.col("n") / spec.most_per_cell).cast("int").alias("parts")),
        "simhash-parts")
    # Most keys hold one fingerprint: the inner join drops them before rows are gathered.
    met = keyed.join(parts, ["choice", "bits"])
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda other: F.struct(F.least(own, other).alias("a"), F.greatest(own, other).alias("b"))))
    gathered = (
        met.select("fp", "choice", "bits", F.explode(cells).alias("cell"))
        .groupBy("choice", "bits", "cell").agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1).select("fps")
    )
    return gathered.mapInArrow(link_cells(spec), "u long, v long")


def near_duplicates(docs: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """Columns doc_id, fp, component_id: the least document id reachable over links."""
    own = staged(fingerprints(docs, spec), "simhash")
    distinct = staged(own.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    components = staged(connected_components(fingerprint_links(distinct.select("fp"), spec), "simhash"), "simhash-roots")
    # A fingerprint without links is a component of its own.
    rooted = distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = staged(join_hot(rooted.select("fp", "root"), least, "root").select("fp", "component_id"), "simhash-members")
    return join_hot(own, members, "fp").select("doc_id", "fp", "component_id")


@dataclass(frozen=True)
class NearCopySpec(SketchSpec):
    """SimHash for near copies: documents whose sets of word shingles have a similarity of ``percent``.

    At a similarity of 0.8 two fingerprints differ in 15 of 100 bits, so a key of bits alone has to be short, and then documents
    without a shingle in common share keys by chance, as a square of their number. Each of ``bands`` keys is therefore
    made of the least hashes of ``rows`` hash functions over the set, which such documents never share, and of ``key_bits`` places
    of the fingerprint drawn at random. At 0.8 a pair shares a key with probability
    1 - (1 - 0.8^4 * 0.85^4)^24 = 0.997. Pairs that share one are discarded by their distances to pivots, then by their own
    distance, and the rest are verified on the full sets.
    """

    shingle: int = 5
    percent: int = 80
    bits: int = 256
    bands: int = 24
    rows: int = 4
    key_bits: int = 4
    #: 3.7 standard deviations over the mean distance at a similarity of 0.8.
    radius: int = 60
    n_pivots: int = 16
    seed: int = 42
    screen: bool = True

    @property
    def width(self) -> int:
        return self.bits // 8

    @property
    def least(self) -> float:
        return self.bits - self.radius

    def closeness(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        return self.bits - np.bitwise_count(s ^ t).sum(axis=-1, dtype=np.int64)

    def discards(self, sketches: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
        references = np.random.default_rng(self.seed).integers(0, 256, (self.n_pivots, self.width), dtype=np.uint8)
        table = np.bitwise_count(sketches[:, None, :] ^ references[None, :, :]).sum(axis=2, dtype=np.int16)
        return lambda rows, i: rows[np.abs(table[rows] - table[i]).max(axis=1, initial=0) <= self.radius]

    def summary(self, elements: np.ndarray) -> tuple[np.ndarray, bytes]:
        places, weights = _drawn(self)
        votes = np.zeros(self.bits, dtype=np.int64)
        for at in range(0, len(elements), 1 << 13):
            part = elements[at : at + (1 << 13)]
            words = np.stack([mixed(part + np.uint64(k + 1)) for k in range(self.bits // 64)], axis=1)
            votes += np.unpackbits(words.view(np.uint8).reshape(len(part), -1), axis=1).sum(axis=0, dtype=np.int64)
        first = np.stack([mixed(elements[:1] + np.uint64(k + 1)) for k in range(self.bits // 64)], axis=1)
        # A tied bit is that of the least hash.
        tied = np.unpackbits(first.view(np.uint8).ravel())
        bits = np.where(2 * votes == len(elements), tied, 2 * votes > len(elements)).astype(np.int64)
        least = band_keys(fill_sketch(elements, self.coordinates, self.seed), self).view(np.uint64)
        keys = mixed(least + (bits[places] @ weights).view(np.uint64)).view(np.int64)
        return keys, np.packbits(bits.astype(np.uint8)).tobytes()


@functools.cache
def _drawn(spec: NearCopySpec) -> tuple[np.ndarray, np.ndarray]:
    """The bit places of each band's key, and the weights of a key's bits."""
    rng = np.random.default_rng(spec.seed)
    places = np.stack([rng.choice(spec.bits, spec.key_bits, replace=False) for _ in range(spec.bands)])
    return places, np.int64(1) << np.arange(spec.key_bits, dtype=np.int64)


def near_copies(docs: DataFrame, spec: NearCopySpec = NearCopySpec()) -> DataFrame:
    """Columns doc_id, n_shingles, component_id, kept: documents linked by a verified similarity of their shingle sets."""
    return sketches.near_duplicates(docs, spec)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
