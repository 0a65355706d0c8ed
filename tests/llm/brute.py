"""Brute-force versions that several tests compare with."""

import xxhash


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        votes = [v + (h >> k & 1) for k, v in enumerate(votes)]
    return sum(1 << k for k, v in enumerate(votes) if 2 * v > len(shingles))


def brute_components(fps, ids):
    """Least id reachable over links of three bits or fewer."""
    left, out = set(range(len(fps))), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = [j for j in left if (fps[i] ^ fps[j]).bit_count() <= 3]
            left -= set(near)
            todo += near
        least = min((ids[i] for i in group if ids[i] is not None), default=None)
        out.update({i: least for i in group})
    return [out[i] for i in range(len(fps))]


def brute_score(passage, item):
    """Smith-Waterman over all cells."""
    above, best = [0] * (len(passage) + 1), 0
    for b in item:
        row = [0]
        for j, a in enumerate(passage):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best / (2 * len(item)) if item else 0.0
