"""Burrows-Wheeler transform of a bundle of strings, and its common prefixes up to a threshold."""

from __future__ import annotations

import numpy as np


def transform(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and transform of strings that each end in a mark at ``ends``.

    Marks are smaller than every byte and differ by place, so suffixes end where their string
    does. The first seven symbols are sorted at once, then prefixes double; only suffixes whose rank is
    shared yet are sorted again.
    """
    n = len(text)
    symbols = text.astype(np.int64) + 1
    symbols[ends] = 0
    key, open_ = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for k in range(7):
        here = np.zeros(n, dtype=np.int64)
        here[: max(n - k, 0)] = symbols[k:]
        key = (key << 9) | np.where(open_, here, 0)
        open_ &= here > 0
    # Equal up to a mark: by its place, which is the order a stable sort leaves.
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.ones(n, dtype=bool)
    first[1:] = (ranked[1:] != ranked[:-1]) | ~open_[order][1:]
    # A rank is the place of the first suffix that shares it.
    slots, width, rank = np.arange(n), 7, np.empty(n, dtype=np.int64)
    while True:
        rank[order[slots]] = np.maximum.accumulate(np.where(first, slots, 0))
        shared = ~first
        shared[:-1] |= ~first[1:]
        slots = slots[shared]
        if not len(slots):
            return order, text[order - 1]
        rows = order[slots]
        # A shared rank has no mark in its prefix, so the text goes on after it.
        key = rank[rows] * n + rank[rows + width]
        by = np.argsort(key)
        order[slots], ranked = rows[by], key[by]
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        width *= 2


def threshold_groups(bwt: np.ndarray, is_mark: np.ndarray, least: int) -> np.ndarray:
    """Group number of each suffix, in suffix order: equal where ``least`` leading bytes are equal.

    Breadth first over the values of common prefixes. A boundary stands between neighbouring
    suffixes whose common prefix is known; all boundaries of value v are found from those below
    v by one backward step: neighbours c·x and c·y are parted at v where x and y were parted at
    v - 1. The expansion stops at ``least``: what is still together shares that many bytes. ``is_mark`` tells
    which symbols of the transform are string ends; those never match.
    """
    n = len(bwt)
    # Backward step as a permutation: the p-th suffix, without its first symbol, is suffix back[p].
    key = np.where(is_mark, 0, bwt.astype(np.int16) + 1).astype(np.int16)
    back = np.argsort(key, kind="stable")
    first = key[back]
    boundary = np.ones(n, dtype=bool)
    boundary[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    open_ = np.flatnonzero(~boundary)
    left, right = back[open_ - 1], back[open_]
    for _ in range(1, least):
        group = np.cumsum(boundary, dtype=np.int32)
        parted = group[left] != group[right]
        boundary[open_[parted]] = True
        open_, left, right = open_[~parted], left[~parted], right[~parted]
        if not len(open_):
            break
    return np.cumsum(boundary) - 1


def first_seen(strings: list[bytes], owners: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of ``least`` bytes also stand in a string of a smaller owner.

    Returns, over the joined strings with one mark after each, the place each string starts at and
    a flag per place.
    """
    lengths = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(strings) else np.zeros(0, dtype=np.int64)
    text = np.frombuffer(b"\x00".join(strings) + b"\x00", dtype=np.uint8) if strings else np.zeros(0, dtype=np.uint8)
    seen = np.zeros(len(text), dtype=bool)
    if not len(strings):
        return starts, seen
    ends = starts + lengths - 1
    mark = np.zeros(len(text), dtype=bool)
    mark[ends] = True
    order, bwt = transform(text, ends)
    group = threshold_groups(bwt, mark[order - 1], least)
    owner = np.repeat(owners, lengths)[order]
    smallest = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, group, owner)
    seen[order] = smallest[group] < owner
    return starts, seen
