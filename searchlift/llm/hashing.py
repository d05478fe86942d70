"""Word and shingle hashes of whole texts, computed on the UTF-8 bytes of many documents at once.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. White space is ASCII only, so
working on bytes gives the same words as working on characters. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
#: Bytes of text handled at once; arrays of eight bytes a character stay small.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=_U)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            with np.errstate(over="ignore"):
                size = max(n, CHUNK_BYTES) + 1
                self.up = np.cumprod(np.r_[_U(1), np.full(size, _BASE, dtype=_U)])
                self.down = np.cumprod(np.r_[_U(1), np.full(size, _INVERSE, dtype=_U)])
        return self.up, self.down


_POWERS = _Powers()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts (one more entry than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents [first, last) of about CHUNK_BYTES together; a longer document is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each document (one more entry than documents)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of each word's bytes, whatever its place."""
    with np.errstate(over="ignore"):
        up, down = _POWERS.of(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(((_LOWER[data] if lower else data).astype(_U) + _U(1)) * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def _joined(hashes: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.full(len(places), width, dtype=_U)
        for k in range(width):
            total = mix(total * _U(0xFF51AFD7ED558CCD) + hashes[places + k])
        return total


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words in order, and each document's first; a shorter text is one run of its words."""
    sizes = np.diff(bounds)
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    first = np.r_[0, np.cumsum(counts)]
    long = sizes >= width
    out = np.zeros(first[-1], dtype=_U)
    places = np.repeat(bounds[:-1] - first[:-1], counts) + np.arange(first[-1])
    is_long = np.repeat(long, counts)
    out[is_long] = _joined(hashes, places[is_long], width)
    for k in range(1, width):
        of = np.flatnonzero(sizes == k)
        if len(of):
            out[first[of]] = _joined(hashes, bounds[of], k)
    return out, first


def document_sets(column: pa.Array | pa.ChunkedArray, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct shingle hashes (empty for a text without words)."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        part, places = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, bounds = word_spans(part, places)
        flat, at = shingles(word_hashes(part, starts, ends), bounds, width)
        for k in range(last - first):
            yield np.unique(flat[at[k] : at[k + 1]])


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of the run of `width` words that starts at each word, for all words in a row."""
    if len(hashes) < width:
        return np.zeros(0, dtype=_U)
    with np.errstate(over="ignore"):
        up, down = _POWERS.of(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, dtype=_U)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * down[: len(hashes) - width + 1])
