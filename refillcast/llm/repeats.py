"""Suffix dedup: bytes covered by a long string that also starts in a document with a smaller id.

Matches are found on a Burrows-Wheeler transform (``bwt``), whose common prefixes are derived in
increasing value by breadth-first backward extension, up to the minimum length. A transform of
the whole corpus would be one task's work, so the corpus is first cut to the places that can match:

- Anchors. Among the grams (of ``gram`` bytes) of every window of ``least`` bytes, those of the
  least hash are anchors. Equal windows have equal anchors, so only anchors whose gram also stands in another
  document matter, and a window lies inside the context of its anchors.
- Contexts. Equal contexts of an anchor count once, with their least document id. A context that
  stands in an earlier document is removed whole; of a gram with several different contexts, those
  that share a part common to many of their windows are sent, with their bytes, to the bucket of
  the gram, and there enter the transform.
- A gram with more than ``most_contexts`` contexts has no bucket to itself: its windows are dealt by their own
  hash instead, reduced to the least id in every chunk first, so a very common passage costs one row
  per chunk and window.

Documents are dealt into chunks by the hash of their id and written once as a bucketed table, so
the rounds (grams, contexts, bytes, removal) read them without another exchange. Messages between
chunks and buckets are packed arrays; answers are bits. Grams and contexts are compared by 48- and
64-bit hashes.

Defined results: null and empty texts, and texts shorter than the minimum length, stay as they are; a
document without an id neither gives nor takes matches; rows that share an id are one source, and do
not match each other; every row gets a result row; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillcast.llm.bwt import first_seen
from refillcast.llm.common import staged
from refillcast.session import fresh_path

KEY_BITS = 48
SEGMENT = 1 << 18
GROUPS = 4


@dataclass(frozen=True)
class RepeatSpec:
    #: Length in bytes from which a repeat counts.
    least: int = 50
    #: Bytes of a gram; at least half of ``least`` and a multiple of 8.
    gram: int = 32
    #: Bytes of text in a chunk and, about, in a bucket.
    chunk_bytes: int = 8 << 20
    most_contexts: int = 2048
    #: Bits of the bucket number, at least 8; set from the input's size.
    bucket_bits: int = 8

    @property
    def width(self) -> int:
        """Grams in a window."""
        return self.least - self.gram + 1


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two hashes."""
    h = (a ^ (b >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def gram_hashes(buffer: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place."""
    n = len(buffer) - 7
    words = np.empty(n, dtype=np.uint64)
    for offset in range(8):
        words[offset::8] = buffer[offset : offset + (n - offset + 7) // 8 * 8].view("<u8")
    out = words[: n - size + 8] * np.uint64(0x9E3779B97F4A7C15)
    for at in range(8, size, 8):
        out ^= out >> np.uint64(29)
        out += words[at : at + len(out)]
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every run of ``width`` values."""
    have = 1
    while have * 2 <= width:
        values, have = pick(values[:-have], values[have:]), have * 2
    return pick(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


class Chunk:
    """The texts of one chunk, joined, and the anchors of their windows."""

    def __init__(self, table: pa.Table, spec: RepeatSpec):
        self.spec, self.table = spec, table
        texts = [t.as_py() or b"" for t in table.column("text").cast(pa.binary())]
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
        known = table.column("doc_id").combine_chunks()
        self.known = np.array(known.is_valid())
        self.ids = known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.find_anchors()

    def find_anchors(self) -> None:
        """Places, document rows, gram keys and context hashes of the anchors, by place."""
        spec, n = self.spec, len(self.bytes)
        w, k = spec.width, spec.gram
        lengths = self.ends - self.starts
        # From each document: the places where a window starts.
        found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for a in range(0, max(n - spec.least + 1, 0), SEGMENT):
            b = min(a + SEGMENT, n - spec.least + 1)
            hashes = gram_hashes(self.bytes[a : b + spec.least - 1], k)
            least = sliding(hashes, w, np.minimum)
            first = np.searchsorted(self.ends, a, "right")
            last = np.searchsorted(self.starts, b, "left")
            inside = np.zeros(b - a, dtype=bool)
            for d in range(first, last):
                if lengths[d] >= spec.least and self.known[d]:
                    inside[max(self.starts[d] - a, 0) : max(min(self.ends[d] - spec.least + 1, b) - a, 0)] = True
            least[~inside] = 0
            none = np.zeros(w - 1, dtype=np.uint64)
            reach = sliding(np.concatenate([none, least, none]), w, np.maximum)
            at = np.flatnonzero((reach == hashes) & (reach != 0))
            found[0].append(at + a)
            found[1].append(hashes[at])
        place, hashes = np.concatenate(found[0]), np.concatenate(found[1])
        # Neighbouring segments find the anchors of their border twice.
        place, once = np.unique(place, return_index=True)
        self.place, self.hash = place, hashes[once]
        self.doc = np.searchsorted(self.ends, place, "right")
        self.key = self.keys_of(self.hash)

    def keys_of(self, hashes: np.ndarray) -> np.ndarray:
        """The low bits of a hash with the bucket number in front. (Anchors have small hashes.)"""
        rest = KEY_BITS - self.spec.bucket_bits
        low = hashes & np.uint64((1 << KEY_BITS) - 1)
        bucket = low & np.uint64((1 << self.spec.bucket_bits) - 1)
        return (bucket << np.uint64(rest)) | (low >> np.uint64(self.spec.bucket_bits))

    def gram_at(self, place: np.ndarray) -> np.ndarray:
        """Gram hashes of single places."""
        spread = np.lib.stride_tricks.sliding_window_view(self.bytes, self.spec.gram)
        out = np.empty(len(place), dtype=np.uint64)
        for a in range(0, len(place), SEGMENT):
            words = np.ascontiguousarray(spread[place[a : a + SEGMENT]]).view("<u8")
            h = words[:, 0] * np.uint64(0x9E3779B97F4A7C15)
            for j in range(1, words.shape[1]):
                h ^= h >> np.uint64(29)
                h += words[:, j]
                h *= np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            out[a : a + SEGMENT] = h ^ (h >> np.uint64(29))
        return out

    def take(self, chosen: np.ndarray) -> None:
        """Keep some anchors; with their contexts' borders and hashes."""
        self.place, self.hash, self.doc, self.key = (x[chosen] for x in (self.place, self.hash, self.doc, self.key))
        w, k, place = self.spec.width, self.spec.gram, self.place
        self.left = np.maximum(self.starts[self.doc], place - (w - 1))
        self.right = np.minimum(self.ends[self.doc], place + self.spec.least)
        # A context is shorter than three grams: these five cover it.
        out = mix(self.hash, ((place - self.left) * 256 + (self.right - place)).astype(np.uint64))
        for at in (self.left, np.minimum(self.left + k, place), np.maximum(place, self.right - 2 * k), self.right - k):
            out = mix(out, self.gram_at(at))
        self.context = out

    def entries(self) -> None:
        """Distinct contexts: ordered by key, context and document id; the first row stands for each."""
        owner = self.ids[self.doc]
        order = np.lexsort((self.place, owner, self.context, self.key))
        key, context = self.key[order], self.context[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
        self.first = order[new]
        self.entry = np.empty(len(order), dtype=np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.least_id = owner[self.first]

    def group_bounds(self) -> list[tuple[int, int]]:
        """Windows start 0 to width - 1 bytes before their anchor: the ranges of these distances."""
        cuts = [round(g * self.spec.width / GROUPS) for g in range(GROUPS + 1)]
        return [(a, b - 1) for a, b in zip(cuts, cuts[1:]) if b > a]

    def shared_parts(self) -> np.ndarray:
        """Per entry and range of windows: hash of the bytes that all these windows hold, 0 if cut."""
        k, at = self.spec.gram, self.first
        out = np.zeros((len(at), GROUPS), dtype=np.uint32)
        for g, (low, high) in enumerate(self.group_bounds()):
            start, stop = self.place[at] - low, self.place[at] - high + self.spec.least
            whole = (start >= self.left[at]) & (stop <= self.right[at])
            h = mix(self.gram_at(start[whole]), self.gram_at(stop[whole] - k))
            out[whole, g] = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        return out

    def windows_of(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All windows of entries: row into ``entry``, place, hash."""
        at = self.first[entry]
        begin, end = self.left[at], np.minimum(self.place[at], self.right[at] - self.spec.least) + 1
        count = end - begin
        row = np.repeat(np.arange(len(entry)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[row]
        k = self.spec.gram
        h = mix(self.gram_at(place), self.gram_at(place + self.spec.least - k))
        return row, place, h


def split_by_bucket(key: np.ndarray, spec: RepeatSpec) -> list[tuple[int, int, int]]:
    """(bucket, from, to) over sorted keys."""
    bucket = (key >> np.uint64(KEY_BITS - spec.bucket_bits)).astype(np.int64)
    found, start = np.unique(bucket, return_index=True)
    stop = np.append(start[1:], len(key))
    return list(zip(found.tolist(), start.tolist(), stop.tolist()))


def packed(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def unpack(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype=kind) for x in column]


def joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


GRAMS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWERS = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("answer", pa.binary())])
CONTEXTS = pa.schema([
    ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("contexts", pa.binary()),
    ("owners", pa.binary()), ("parts", pa.binary())])
STRINGS = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("owners", pa.binary()),
    ("shapes", pa.binary()), ("body", pa.binary())])
KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("kept", pa.string())])

#: Answers about a gram.
COLD, SHARED, COMMON = 0, 1, 2
#: Answers about a context.
ALONE, EARLIER, SENT = 0, 1, 2


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def distinct_grams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the chunk; per key the number of documents it stands in."""
    owner = chunk.ids[chunk.doc]
    order = np.lexsort((owner, chunk.key))
    key, owner = chunk.key[order], owner[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return np.unique(key[fresh], return_counts=True)


def send_grams(spec: RepeatSpec) -> Callable[[pa.Table], pa.Table]:
    def run(docs: pa.Table) -> pa.Table:
        chunk = Chunk(docs, spec)
        key, count = distinct_grams(chunk)
        name = docs.column("chunk")[0].as_py()
        count = np.minimum(count, np.iinfo(np.uint32).max).astype(np.uint32)
        rest = np.uint64((1 << (KEY_BITS - spec.bucket_bits)) - 1)
        low = (key & rest).view(np.uint8).reshape(-1, 8)[:, :5]
        return packed([
            {"bucket": b, "chunk": name, "keys": low[i:j].tobytes(), "counts": packed_counts(count[i:j])}
            for b, i, j in split_by_bucket(key, spec)], GRAMS)

    return run


def packed_counts(count: np.ndarray) -> bytes:
    """Counts over one, with their place: nearly all are one."""
    at = np.flatnonzero(count > 1).astype(np.uint32)
    return np.concatenate([at, count[at]]).astype(np.uint32).tobytes()


def answer_grams(spec: RepeatSpec) -> Callable[[pa.Table], pa.Table]:
    """For each key of a bucket: in one document only, shared, or very common."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for raw, more in zip(unpack(table.column("keys"), np.uint8), unpack(table.column("counts"), np.uint32)):
            wide = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
            wide[:, :5] = raw.reshape(-1, 5)
            keys.append(wide.reshape(-1).view(np.uint64))
            count = np.ones(len(keys[-1]), dtype=np.int64)
            at, value = np.split(more, 2)
            count[at] = value
            counts.append(count)
        _, of = np.unique(joined(keys, np.uint64), return_inverse=True)
        total = np.bincount(of, joined(counts, np.int64))[of]
        answer = np.where(total > spec.most_contexts, COMMON, np.where(total > 1, SHARED, COLD)).astype(np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        return packed([
            {"chunk": c.as_py(), "kind": 0, "bucket": b.as_py(), "answer": pack_two(part)}
            for c, b, part in zip(table.column("chunk"), table.column("bucket"), np.split(answer, ends[:-1]))], ANSWERS)

    return run


def pack_two(values: np.ndarray) -> bytes:
    """Values of two bits as two bit planes."""
    return np.concatenate([np.packbits(values & 1), np.packbits(values >> 1)]).tobytes()


def unpack_two(raw: np.ndarray, n: int) -> np.ndarray:
    low, high = np.split(raw, 2)
    return np.unpackbits(low, count=n) | (np.unpackbits(high, count=n) << 1)


def answers_of(table: pa.Table, kind: int) -> dict[int, np.ndarray]:
    return {
        b.as_py(): np.frombuffer(a.as_py(), dtype=np.uint8)
        for k, b, a in zip(table.column("kind"), table.column("bucket"), table.column("answer")) if k.as_py() == kind}


def with_grams(docs: pa.Table, answers: pa.Table, spec: RepeatSpec) -> tuple[Chunk, np.ndarray]:
    """The chunk with its shared and common anchors as entries; whether an entry's gram is common."""
    chunk, got = Chunk(docs, spec), answers_of(answers, 0)
    key = np.unique(chunk.key)
    verdict = np.zeros(len(key), dtype=np.uint8)
    for b, i, j in split_by_bucket(key, spec):
        verdict[i:j] = unpack_two(got[b], j - i)
    of = verdict[np.searchsorted(key, chunk.key)] if len(key) else verdict
    chunk.take(of != COLD)
    chunk.entries()
    return chunk, (of[of != COLD] == COMMON)[chunk.first]


def send_contexts(spec: RepeatSpec) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return packed([], CONTEXTS)
        chunk, common = with_grams(docs, answers, spec)
        at = np.flatnonzero(~common)
        key, context = chunk.key[chunk.first][at], chunk.context[chunk.first][at]
        owner, parts = chunk.least_id[at], chunk.shared_parts()[at]
        name = docs.column("chunk")[0].as_py()
        return packed([
            {"bucket": b, "chunk": name, "keys": key[i:j].tobytes(), "contexts": context[i:j].tobytes(),
             "owners": owner[i:j].tobytes(), "parts": parts[i:j].tobytes()}
            for b, i, j in split_by_bucket(key, spec)], CONTEXTS)

    return run


def answer_contexts(spec: RepeatSpec) -> Callable[[pa.Table], pa.Table]:
    """For each context of a bucket: alone, in an earlier document too, or to be sent."""

    def run(table: pa.Table) -> pa.Table:
        keys = unpack(table.column("keys"), np.uint64)
        key, context = joined(keys, np.uint64), joined(unpack(table.column("contexts"), np.uint64), np.uint64)
        owner = joined(unpack(table.column("owners"), np.int64), np.int64)
        parts = joined(unpack(table.column("parts"), np.uint32), np.uint32).reshape(-1, GROUPS)
        order = np.lexsort((owner, context, key))
        k, c = key[order], context[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        answer = np.full(len(order), EARLIER, dtype=np.uint8)
        least = order[new]
        answer[least] = ALONE
        for g in range(GROUPS):
            part = parts[least, g]
            _, of, count = np.unique(mix(key[least], part.astype(np.uint64)), return_inverse=True, return_counts=True)
            answer[least[(part != 0) & (count[of] > 1)]] = SENT
        # Equal ids in two chunks do not occur: a chunk holds all rows of an id.
        ends = np.cumsum([len(x) for x in keys])
        return packed([
            {"chunk": ch.as_py(), "kind": 1, "bucket": b.as_py(), "answer": pack_two(part)}
            for ch, b, part in zip(table.column("chunk"), table.column("bucket"), np.split(answer, ends[:-1]))], ANSWERS)

    return run


class Judged:
    """A chunk with what the first two rounds say about its entries."""

    def __init__(self, docs: pa.Table, answers: pa.Table, spec: RepeatSpec):
        self.chunk, common = with_grams(docs, answers, spec)
        chunk, got = self.chunk, answers_of(answers, 1)
        self.verdict = np.zeros(len(chunk.first), dtype=np.uint8)
        plain = np.flatnonzero(~common)
        for b, i, j in split_by_bucket(chunk.key[chunk.first][plain], spec):
            self.verdict[plain[i:j]] = unpack_two(got[b], j - i)
        self.sent = np.flatnonzero(self.verdict == SENT)
        # Windows of common grams: one row per distinct window, with the least id.
        self.common = np.flatnonzero(common)
        row, self.window_place, h = chunk.windows_of(self.common)
        self.window_row, owner = row, chunk.least_id[self.common][row]
        key = chunk.keys_of(mix(h, h))
        order = np.lexsort((owner, h, key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])
        self.window_of = np.empty(len(order), dtype=np.int64)
        self.window_of[order] = np.cumsum(new) - 1
        self.window_first = order[new]
        self.window_key, self.window_hash = key[self.window_first], h[self.window_first]
        self.window_owner = owner[self.window_first]


def send_strings(spec: RepeatSpec) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return packed([], STRINGS)
        judged = Judged(docs, answers, spec)
        chunk, name = judged.chunk, docs.column("chunk")[0].as_py()
        at = chunk.first[judged.sent]
        owner, left, right = chunk.least_id[judged.sent], chunk.left[at], chunk.right[at]
        body = chunk.bytes.tobytes()
        rows = []
        for b, i, j in split_by_bucket(chunk.key[at], spec):
            rows.append({
                "kind": 1, "bucket": b, "chunk": name, "owners": owner[i:j].tobytes(),
                "shapes": (right[i:j] - left[i:j]).astype(np.uint16).tobytes(),
                "body": b"".join(body[x:y] for x, y in zip(left[i:j].tolist(), right[i:j].tolist()))})
        for b, i, j in split_by_bucket(judged.window_key, spec):
            rows.append({
                "kind": 2, "bucket": b, "chunk": name, "owners": judged.window_owner[i:j].tobytes(),
                "shapes": b"", "body": judged.window_hash[i:j].tobytes()})
        return packed(rows, STRINGS)

    return run


def answer_strings(spec: RepeatSpec) -> Callable[[pa.Table], pa.Table]:
    """Which windows also stand in a document with a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        owners = unpack(table.column("owners"), np.int64)
        owner, kind = joined(owners, np.int64), table.column("kind")[0].as_py()
        ends = np.cumsum([len(x) for x in owners])
        if kind == 2:
            h = joined(unpack(table.column("body"), np.uint64), np.uint64)
            _, of = np.unique(h, return_inverse=True)
            least = np.full(int(of.max(initial=-1)) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, of, owner)
            parts = [np.packbits(p).tobytes() for p in np.split(least[of] < owner, ends[:-1])]
        else:
            shapes = joined(unpack(table.column("shapes"), np.uint16), np.uint16).astype(np.int64)
            body = b"".join(x.as_py() for x in table.column("body"))
            stop = np.cumsum(shapes)
            strings = [body[a:b] for a, b in zip((stop - shapes).tolist(), stop.tolist())]
            start, seen = first_seen(strings, owner, spec.least)
            # A context has at most ``width`` windows: one bit each, by distance from its left border.
            width, bits = spec.width, np.zeros(len(strings), dtype=np.uint64)
            padded = np.concatenate([seen, np.zeros(width, dtype=bool)])
            for t in range(width):
                bits |= (padded[start + t] & (t + spec.least <= shapes)).astype(np.uint64) << np.uint64(t)
            parts = [p.tobytes() for p in np.split(bits, ends[:-1])]
        return packed([
            {"chunk": c.as_py(), "kind": 1 + kind, "bucket": b.as_py(), "answer": p}
            for c, b, p in zip(table.column("chunk"), table.column("bucket"), parts)], ANSWERS)

    return run


def removed_places(judged: Judged, answers: pa.Table, spec: RepeatSpec) -> np.ndarray:
    """For each byte of the chunk, whether it goes."""
    chunk = judged.chunk
    cover = np.zeros(len(chunk.bytes) + 1, dtype=np.int64)
    entry, at_least = chunk.entry, chunk.ids[chunk.doc] == chunk.least_id[chunk.entry]
    whole = (judged.verdict[entry] == EARLIER) | ~at_least
    np.add.at(cover, chunk.left[whole], 1)
    np.add.at(cover, chunk.right[whole], -1)
    # Windows of sent contexts and of common grams, at every place of the entry's least document.
    got, begins = answers_of(answers, 2), []
    bits = np.zeros(len(chunk.first), dtype=np.uint64)
    for b, i, j in split_by_bucket(chunk.key[chunk.first[judged.sent]], spec):
        bits[judged.sent[i:j]] = got[b].view(np.uint64)
    got = answers_of(answers, 3)
    seen = np.zeros(len(judged.window_key), dtype=bool)
    for b, i, j in split_by_bucket(judged.window_key, spec):
        seen[i:j] = np.unpackbits(got[b], count=j - i).astype(bool)
    # A window is first seen here only if this entry's least id is the window's least id in the chunk.
    hit = seen[judged.window_of] | (
        chunk.least_id[judged.common][judged.window_row] > judged.window_owner[judged.window_of])
    offset = judged.window_place - chunk.left[chunk.first[judged.common]][judged.window_row]
    np.bitwise_or.at(bits, judged.common[judged.window_row[hit]], np.uint64(1) << offset[hit].astype(np.uint64))
    some = np.flatnonzero(~whole & (bits[entry] != 0))
    for t in range(spec.width):
        on = some[(bits[entry[some]] >> np.uint64(t)) & np.uint64(1) == 1]
        begins.append(chunk.left[on] + t)
    begin = joined(begins, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + spec.least, -1)
    return np.cumsum(cover[:-1]) > 0


def remove(spec: RepeatSpec) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return packed([], KEPT)
        judged = Judged(docs, answers, spec)
        chunk = judged.chunk
        gone = removed_places(judged, answers, spec)
        turns = np.concatenate([[False], gone])
        begins = np.flatnonzero(turns[1:] & ~turns[:-1])
        rows = []
        ids = docs.column("doc_id").to_pylist()
        for d, (a, b) in enumerate(zip(chunk.starts.tolist(), chunk.ends.tolist())):
            off = gone[a:b]
            kept = chunk.bytes[a:b][~off].tobytes()
            # A run that reaches over from the document before starts anew here.
            runs = int(np.searchsorted(begins, b) - np.searchsorted(begins, a))
            runs += int(b > a and off[0] and (a not in begins[np.searchsorted(begins, a) :][:1]))
            rows.append((ids[d], b - a, int(off.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT)], schema=KEPT)

    return run


def chunked(docs: DataFrame, spec: RepeatSpec) -> tuple[DataFrame, RepeatSpec]:
    """The documents as a table bucketed by chunk, and the spec with its number of buckets."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / spec.chunk_bytes))
    name, files = f"chunked_{uuid.uuid4().hex}", max(1, math.ceil(chunks / 2))
    # Rows without an id match nothing, so their texts deal them out.
    part = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(chunks))
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", part.alias("chunk"))
        .repartition(files, "chunk")
        .write.bucketBy(files, "chunk").option("path", fresh_path(spark, "chunked")).option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name), replace(spec, bucket_bits=max(8, (chunks - 1).bit_length()))


def without_repeats(docs: DataFrame, spec: RepeatSpec = RepeatSpec()) -> DataFrame:
    """Columns doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept: the bytes that stay, as
    text (a character cut by a match shows as a replacement character; the checksum is of the bytes)."""
    table, spec = chunked(docs, spec)
    groups = table.groupBy("chunk")

    def answered(messages: DataFrame, answer, name: str, *keys: str) -> DataFrame:
        return staged(messages.groupBy(*keys).applyInArrow(answer(spec), ddl(ANSWERS)), name)

    first = answered(groups.applyInArrow(send_grams(spec), ddl(GRAMS)), answer_grams, "repeat-grams", "bucket")
    contexts = groups.cogroup(first.groupBy("chunk")).applyInArrow(send_contexts(spec), ddl(CONTEXTS))
    second = first.unionByName(answered(contexts, answer_contexts, "repeat-contexts", "bucket"))
    strings = groups.cogroup(second.groupBy("chunk")).applyInArrow(send_strings(spec), ddl(STRINGS))
    third = second.unionByName(answered(strings, answer_strings, "repeat-strings", "kind", "bucket"))
    return groups.cogroup(third.groupBy("chunk")).applyInArrow(remove(spec), ddl(KEPT))
