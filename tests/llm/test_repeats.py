"""Suffix dedup against brute force over every window."""

import hashlib
import random

import numpy as np
import pytest

from refillcast.llm import bwt
from refillcast.llm.bwt import first_seen
from refillcast.llm.repeats import RepeatSpec, chunked, without_repeats


def brute(pairs, least):
    first = {}
    for i, text in pairs:
        if i is not None:
            b = (text or "").encode()
            for p in range(len(b) - least + 1):
                first[b[p : p + least]] = min(i, first.get(b[p : p + least], i))
    out = []
    for i, text in pairs:
        b = (text or "").encode()
        off = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if i is not None and first[b[p : p + least]] < i:
                off[p : p + least] = b"\1" * least
        kept = bytes(x for x, o in zip(b, off) if not o)
        runs = sum(1 for k in range(len(b)) if off[k] and (k == 0 or not off[k - 1]))
        out.append((i, len(b), sum(off), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n, alphabet):
    rng = random.Random(seed)
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, 90))) for _ in range(12)]
    texts = []
    for _ in range(n):
        body = [rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(40))
                for _ in range(rng.randint(0, 8))]
        texts.append("".join(body))
    texts += [None, "", "ab" * 200, "a" * 300, "a" * 299, texts[3], texts[3], "é" * 60]
    pairs = list(enumerate(texts)) + [(4, texts[4]), (4, texts[5]), (None, texts[3])]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("most_contexts", [2, 2048])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh éß"])
def test_removal_equals_brute_force(spark, documents, most_contexts, alphabet):
    pairs = corpus(7, 60, alphabet)
    spec = RepeatSpec(least=24, gram=16, chunk_bytes=4000, most_contexts=most_contexts)
    got = without_repeats(documents(pairs), spec).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(pairs, 24)


def test_production_length(spark, documents):
    pairs = corpus(8, 60, "abcd ")
    got = without_repeats(documents(pairs), RepeatSpec(chunk_bytes=4000)).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(pairs, 50)


def test_empty_table(spark, documents):
    assert without_repeats(documents([])).collect() == []


def test_transform_finds_earlier_windows():
    rng = random.Random(3)
    for _ in range(100):
        alphabet = rng.choice(["ab", "abc", "a"])
        strings = [bytes(rng.choices(alphabet.encode(), k=rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        owners = np.array([rng.randint(0, 5) for _ in strings])
        least = rng.randint(1, 6)
        starts, seen = first_seen(strings, owners, least)
        for s, o, at in zip(strings, owners, starts):
            for i in range(len(s) + 1):
                w = s[i : i + least]
                want = len(w) == least and any(w in t and p < o for t, p in zip(strings, owners))
                assert bool(seen[at + i]) == want


def test_rows_without_an_id_spread_over_the_chunks(spark, documents):
    text = {k: f"text number {k} " * 40 for k in range(64)}
    docs = documents([(None, t) for t in text.values()])
    spec = RepeatSpec(chunk_bytes=4096)
    table, _ = chunked(docs, spec)
    sizes = [r["count"] for r in table.groupBy("chunk").count().collect()]
    assert sum(sizes) == 64 and max(sizes) <= 32 and len(sizes) > 3
    got = without_repeats(docs, spec).collect()
    assert sorted(r["kept"] for r in got) == sorted(text.values())


def test_the_transform_sorts_only_suffixes_of_shared_rank_again(monkeypatch):
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(1, 80))) for _ in range(200)]
    strings += [strings[0] * 2, strings[0], b"a"]
    text = np.frombuffer(b"\x00".join(strings) + b"\x00", dtype=np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    sizes, argsort = [], np.argsort
    monkeypatch.setattr(bwt.np, "argsort", lambda a, **kind: sizes.append(len(a)) or argsort(a, **kind))
    order, found = bwt.transform(text, ends)
    symbols = text.astype(int) + len(ends)
    symbols[ends] = range(len(ends))
    whole = symbols.tolist()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: whole[i:])
    assert found.tolist() == text[order - 1].tolist()
    assert sum(sizes) < 2 * len(text)


@pytest.mark.parametrize("text", [b"\x00", b"a\x00", b"\x00\x00a\x00"])
def test_the_transform_of_short_texts(text):
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 0)
    order, _ = bwt.transform(np.frombuffer(text, dtype=np.uint8), ends)
    symbols = [c + len(text) for c in text]
    for k, e in enumerate(ends.tolist()):
        symbols[e] = k
    assert order.tolist() == sorted(range(len(text)), key=lambda i: symbols[i:])
