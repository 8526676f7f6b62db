"""The operators' contracts in plain Python, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def fold(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def shingles(text: str | None, k: int) -> set:
    ws = words((text or "").translate(LOWER))
    if not ws:
        return set()
    return {tuple(ws)} if len(ws) < k else {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}


def components(texts: dict[int, str | None], k: int, percent: int = 80) -> dict[int, int]:
    """Smallest id of each document's component, by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in texts}


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Shares of 150 % by weight, stopped at twice the size, the excess reshared."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, open_names = 1.5 * sum(sizes.values()), list(names)
    while open_names:
        total = sum(weight[s] for s in open_names)
        above = [s for s in open_names if left * weight[s] / total >= 2 * sizes[s]]
        if not above:
            out |= {s: left * weight[s] / total for s in open_names}
            break
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_names.remove(s)
    return out


def local_alignment(a: list, b: list, match: int = 2, mismatch: int = -1, skip: int = -1) -> int:
    best, previous = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, previous[j - 1] + (match if x == y else mismatch), previous[j] + skip, row[-1] + skip))
        best, previous = max(best, max(row)), row
    return best


def grouped(rows, key: str) -> dict:
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def crc_of(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
