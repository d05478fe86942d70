"""Plain statements of what the operators should find, over lists of texts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None, lower: bool = True) -> list[str]:
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def shingle_set(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def links(sets: dict) -> list[tuple]:
    holders = defaultdict(list)
    for key, s in sets.items():
        for x in s:
            holders[x].append(key)
    shared = Counter((a, b) for keys in holders.values() for k, b in enumerate(keys) for a in keys[:k])
    return [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]


def components(sets: dict) -> dict:
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links(sets):
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


def rule_measures(text: str | None) -> tuple:
    w = words(text, lower=False)
    n = len(w)
    runs = Counter(tuple(w[k : k + 8]) for k in range(n - 7))
    covered = {i for k in range(n - 7) if runs[tuple(w[k : k + 8])] > 1 for i in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)
