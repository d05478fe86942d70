"""Removal of word windows that earlier documents have, with a count-min prefilter.

A window is WINDOW consecutive words of one document. A word goes when a window that covers it also starts in a document
with a smaller doc_id. Windows are judged on the input, so what is removed in one place changes nothing elsewhere.

1. Documents are written in bundles of some megabytes (see `bundles`), so all that is learned about a window is sent
   once for each bundle, and a passage that a third of all documents share stays small.
2. A bundle's sketch counts, for each cell of one wide hash row, the bundle's documents that have a window there (two
   count for many). Sketches are cut by cell range and the parts of one range are merged by adding: no task and no
   driver holds a whole sketch, which is why it can be as wide as the corpus asks for (2^SPARE_BITS cells a window and
   more). With that width further hash rows would cost more than the few windows they would hold back. Merged counts
   are never below the true number of documents; cells that reach two go back to the bundles that filled them.
3. The second pass takes the windows in such cells only, with hashes of 64 and 32 bits, groups them exactly and finds the
   least doc_id of each. A window that two documents share is in a cell of two at least, so none is lost.
4. Bundles learn the least doc_id of those windows that a later document of theirs has, and drop the words.

Defined results. doc_id decides what is smaller; rows that share a doc_id are one document to each other, and rows
without doc_id keep all their words and take none from others. Null texts are empty. Texts with fewer than WINDOW words
lose nothing. Words are compared as they are, and kept words are joined by single spaces. An empty table gives no rows;
columns besides doc_id and text are not looked at. Two windows with equal 96 bits of hash count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlift.llm.bundles import COLUMNS, batch_of, bundled, from_planes, from_steps, opened, packed_rows, planes, slices, steps, table_of
from searchlift.llm.hashing import chunks, mix, run_hashes, word_hashes, word_spans

WINDOW = 13
BUNDLE_BYTES = 4 << 20
#: Entries of one part of the sketch, or of the exact grouping, about.
PART_ENTRIES = 1 << 20
#: At least so many parts, as a power of two, for small tables to use many tasks.
PART_BITS = 6
#: Cells for each window, as a power of two.
SPARE_BITS = 6
#: Bytes of a word and its space, as guessed for the number of windows; only the sketch's width depends on it.
WORD_BYTES = 4

#: What is sent of a window, and how it is written: two hashes, the least doc_id, the largest less the least, its place.
_NAMES, _KINDS = ("one", "other", "least", "extra", "at"), ("<u8", "<u4", "<i8", "<i8", "<u4")

_SKETCH = {"part": pa.int64(), "bundle": pa.int64(), "cells": pa.binary()}
_CELLS = {"part": pa.int64(), "bundle": pa.int64(), "n": pa.int64(), "cells": pa.binary()}
_WINDOWS = {"part": pa.int64(), "bundle": pa.int64(), **dict.fromkeys(_NAMES, pa.binary())}
_LATE = {"bundle": pa.int64(), "at": pa.binary(), "least": pa.binary()}

_U = np.uint64
_OTHER = _U(0xA0761D6478BD642F)


class Words(NamedTuple):
    """Some documents of a bundle: their bytes, their words, and the hashes of their windows."""

    first: int
    bounds: np.ndarray  # first word of each document, and the number of words
    texts: list[bytes]
    places: np.ndarray  # word at which each window starts
    owners: np.ndarray  # document of each window, counted in the bundle
    one: np.ndarray
    other: np.ndarray


def _words(data: np.ndarray, offsets: np.ndarray) -> Iterator[Words]:
    for first, last in chunks(offsets):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, bounds = word_spans(part, cuts)
        hashes = word_hashes(part, starts, ends, lower=False)
        counts = np.maximum(np.diff(bounds) - WINDOW + 1, 0)
        before = np.r_[0, np.cumsum(counts)]
        places = np.repeat(bounds[:-1] - before[:-1], counts) + np.arange(before[-1])
        owners = np.repeat(np.arange(first, last), counts)
        one, other = run_hashes(hashes, WINDOW)[places], run_hashes(mix(hashes ^ _OTHER), WINDOW)[places] >> _U(32)
        whole = [part[cuts[k] : cuts[k + 1]].tobytes() for k in range(last - first)]
        yield Words(first, bounds, whole, places, owners, one, other)


def _sketcher(bits: int, part_bits: int):
    shift, below = _U(64 - bits), _U(bits - part_bits)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, known, _, *texts in opened(batches):
            cells, owners = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
            for w in _words(*texts):
                own = known[w.owners]
                cells.append(w.one[own] >> shift)
                owners.append(ids[w.owners[own]])
            cell, owner = np.concatenate(cells), np.concatenate(owners)
            order = np.lexsort((owner, cell))
            cell, owner = cell[order], owner[order]
            new = np.r_[True, (cell[1:] != cell[:-1]) | (owner[1:] != owner[:-1])][: len(cell)]
            cell = cell[new]  # once for each document
            cell = cell[np.r_[np.ones(min(2, len(cell)), bool), cell[2:] != cell[:-2]]]  # two stand for many
            found = [(p, steps(cell[a:b] & ((_U(1) << below) - _U(1)))) for p, a, b in slices(cell >> below)]
            yield batch_of([(p, row["bundle"].as_py(), body) for p, body in found], _SKETCH)

    return sketch


def _merged(table: pa.Table) -> pa.Table:
    """Adds the sketches of one range; each bundle gets those of its cells whose count is two or more."""
    sketches = [from_steps(body) for body in table.column("cells").to_pylist()]
    every = np.sort(np.concatenate(sketches))
    many = np.unique(every[1:][every[1:] == every[:-1]])
    back = []
    for part, bundle, cells in zip(table.column("part").to_pylist(), table.column("bundle").to_pylist(), sketches, strict=True):
        cells = cells[np.r_[True, cells[1:] != cells[:-1]]]
        cells = cells[np.isin(cells, many, assume_unique=True)]
        if len(cells):
            back.append((part, bundle, len(cells), steps(cells)))
    return table_of(back, _CELLS)


def _candidates(bits: int, cell_part_bits: int, part_bits: int):
    """The windows of a bundle that lie in cells of two, once each, with the least and the largest doc_id that has them.

    `at` counts the bundle's windows up to the first one of the kind, for the answer to name it.
    """
    shift, below, top = _U(64 - bits), _U(bits - cell_part_bits), _U(64 - part_bits)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, known, _, *texts in opened(batches):
            held = row["many"].as_py() or []
            if not held:
                continue
            many = np.sort(np.concatenate([(_U(x["part"]) << below) | from_steps(x["cells"]) for x in held]))
            found, before = [(np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
            for w in _words(*texts):
                cell = w.one >> shift
                near = many[np.minimum(np.searchsorted(many, cell), len(many) - 1)] == cell
                own = np.flatnonzero(known[w.owners] & near)
                found.append((w.one[own], w.other[own], ids[w.owners[own]], own + before))
                before += len(w.one)
            one, other, owner, at = (np.concatenate(x) for x in zip(*found, strict=True))
            one, other, least, most, at = _reduced(one, other, owner, owner, at)
            columns = list(zip((one, other, least, most - least, at), _KINDS, strict=True))
            sent = [(p, row["bundle"].as_py(), *(planes(x[a:b], kind) for x, kind in columns)) for p, a, b in slices(one >> top)]
            yield batch_of(sent, _WINDOWS)

    return emit


def _reduced(one: np.ndarray, other: np.ndarray, least: np.ndarray, most: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each window once, in order, with the least and the largest of its numbers and its first place."""
    order = np.lexsort((other, one))
    one, other, least, most, at = one[order], other[order], least[order], most[order], at[order]
    cuts = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (other[1:] != other[:-1])][: len(one)])
    if not len(cuts):
        return one, other, least, most, at
    return one[cuts], other[cuts], np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts), at[cuts]


def _among(one: np.ndarray, other: np.ndarray, keys: np.ndarray, key_others: np.ndarray) -> np.ndarray:
    """Place of each window among keys in order, or -1."""
    out = np.full(len(one), -1, np.int64)
    if not len(keys):
        return out
    left, right = np.searchsorted(keys, one, "left"), np.searchsorted(keys, one, "right")
    for k in range(int((right - left).max(initial=0))):  # once, unless two windows share 64 bits
        at = np.minimum(left + k, len(keys) - 1)
        out = np.where((left + k < right) & (key_others[at] == other), at, out)
    return out


def _grouped(table: pa.Table) -> pa.Table:
    """Groups one range of windows exactly; each bundle gets the least doc_id of those that a larger doc_id of its own has.

    Answers are in the order of the bundle's text, where a copied passage is a run of windows with one least doc_id.
    """
    own = [tuple(from_planes(body, kind) for body, kind in zip(row, _KINDS, strict=True)) for row in zip(*(table.column(n).to_pylist() for n in _NAMES), strict=True)]
    one, other, least, _, _ = _reduced(*(np.concatenate([x[k] for x in own]) for k in (0, 1, 2, 2, 2)))
    back = []
    for bundle, (a, b, lo, extra, at) in zip(table.column("bundle").to_pylist(), own, strict=True):
        first = least[_among(a, b, one, other)]
        late = np.flatnonzero(lo + extra > first)
        if len(late):
            late = late[np.argsort(at[late])]
            back.append((bundle, steps(at[late].astype(_U)), planes(np.diff(first[late], prepend=0), "<i8")))
    return table_of(back, _LATE)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, ids, known, _, *texts in opened(batches):
        held = row["seen"].as_py() or []
        parts = list(_words(*texts))
        every, others = (np.concatenate([np.zeros(0, _U), *x]) for x in ([w.one for w in parts], [w.other for w in parts]))
        at = np.concatenate([np.zeros(0, np.int64), *[from_steps(x["at"]).astype(np.int64) for x in held]])
        least = np.concatenate([np.zeros(0, np.int64), *[np.cumsum(from_planes(x["least"], "<i8")) for x in held]])
        one, other, least, _, _ = _reduced(every[at], others[at], least, least, at)
        n_words, n_removed, kept = [], [], []
        for w in parts:
            place = _among(w.one, w.other, one, other)
            gone = (place >= 0) & known[w.owners]
            gone[gone] = ids[w.owners[gone]] > least[place[gone]]
            change = np.zeros(int(w.bounds[-1]) + 1, np.int64)
            np.add.at(change, w.places[gone], 1)
            np.add.at(change, w.places[gone] + WINDOW, -1)
            covered = np.cumsum(change[:-1]) > 0
            for k, text in enumerate(w.texts):
                own, off = text.split(), covered[w.bounds[k] : w.bounds[k + 1]]
                n_words.append(len(own))
                n_removed.append(int(off.sum()))
                kept.append(b" ".join(x for x, y in zip(own, off, strict=True) if not y) if n_removed[-1] else b" ".join(own))
        yield pa.RecordBatch.from_arrays(
            [row["ids"].values.cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([k.decode() for k in kept], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _bits(entries: int) -> int:
    return max(1, entries - 1).bit_length()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; `kept` holds the words that stay, joined by single spaces."""
    bundles = bundled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(False).alias("flag")), BUNDLE_BYTES)
    windows = (bundles.agg(F.sum("n_bytes")).first()[0] or 0) // WORD_BYTES
    bits = min(60, _bits(windows) + SPARE_BITS)
    cell_parts = max(PART_BITS, _bits(windows // PART_ENTRIES), bits - 32)
    bits = max(bits, cell_parts)
    sketches = bundles.select(*COLUMNS).mapInArrow(_sketcher(bits, cell_parts), "part long, bundle long, cells binary")
    many = packed_rows(sketches.groupBy("part").applyInArrow(_merged, "part long, bundle long, n long, cells binary"), "many")

    repeated = many.agg(F.sum("n")).first()[0] or 0
    parts = max(PART_BITS, _bits(repeated // PART_ENTRIES))
    cells = many.groupBy("bundle").agg(F.collect_list(F.struct("part", "cells")).alias("many"))
    asked = bundles.join(cells, "bundle").select(*COLUMNS, "many")
    emitted = asked.mapInArrow(_candidates(bits, cell_parts, parts), "part long, bundle long, " + ", ".join(f"{name} binary" for name in _NAMES))
    late = packed_rows(emitted.groupBy("part").applyInArrow(_grouped, "bundle long, at binary, least binary"), "late")

    seen = late.groupBy("bundle").agg(F.collect_list(F.struct("at", "least")).alias("seen"))
    judged = bundles.join(seen, "bundle", "left").select(*COLUMNS, "seen")
    return judged.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
