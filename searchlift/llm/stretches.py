"""Coding of texts stretch by stretch, where a code breaks at places that can be told from the bytes alone.

Words come again and again, so a worker codes each distinct stretch once and puts the texts together from the results.
Stretches are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from searchlift.llm.hashing import word_hashes

#: Bytes of text read at once, and stretches remembered by a worker; both bound memory, not results.
READ_BYTES = 1 << 20
REMEMBERED = 1 << 20

Coded = tuple[np.ndarray, np.ndarray]


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes first[0], first[0] + 1, ... for counts[0] of them, then those of the next run."""
    before = np.cumsum(counts) - counts
    return np.repeat(first - before, counts) + np.arange(int(counts.sum()))


def runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts [first, last) of about READ_BYTES together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(offsets, offsets[first] + READ_BYTES, side="right")) - 1))
        yield first, last
        first = last


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the first place of each, and which one each place holds; only distinct keys are sorted."""
    which, own = pd.factorize(keys)
    sample = np.zeros(len(own), dtype=np.int64)
    sample[which[::-1]] = np.arange(len(keys) - 1, -1, -1)
    order = np.argsort(own)
    rank = np.empty(len(own), dtype=np.int64)
    rank[order] = np.arange(len(own))
    return own[order], sample[order], rank[which]


class StretchCoder:
    """Codes texts; `breaks` marks the bytes that open a stretch, `code_of(data, starts, ends)` codes stretches."""

    def __init__(self, breaks: Callable[[np.ndarray], np.ndarray], code_of: Callable[[np.ndarray, np.ndarray, np.ndarray], Coded]):
        self.breaks, self.code_of = breaks, code_of
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.int32)

    def code(self, data: np.ndarray, offsets: np.ndarray) -> Coded:
        """Ids of the texts in a row, and where each text's begin (one more entry than texts)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        opens = self.breaks(data)
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(opens)
        ends = np.r_[starts[1:], len(data)]
        hashes, sample, which = _distinct(word_hashes(data, starts, ends, lower=False))
        self._learn(data, hashes, starts[sample], ends[sample])
        at = np.searchsorted(self.known, hashes)[which]
        counts = self.counts[at]
        token = np.r_[0, np.cumsum(counts)]
        return self.pool[ragged(self.first[at], counts)], token[np.searchsorted(starts, offsets)]

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(self.known) + len(hashes) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != hashes
        ids, counts = self.code_of(data, starts[new], ends[new])
        first = len(self.pool) + np.cumsum(counts) - counts
        self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        self.known = np.insert(self.known, at[new], hashes[new])
        self.first = np.insert(self.first, at[new], first)
        self.counts = np.insert(self.counts, at[new], counts)
