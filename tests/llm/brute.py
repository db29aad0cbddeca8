"""Plain versions of the text-corpus operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base_figures(text: str | None) -> tuple:
    text = text or ""
    w = WORDS.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def fingerprint(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(lower)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n: int, linked) -> list[int]:
    """Least position reachable from each of n positions."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
