"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is predicted byte by byte, and a byte bit by bit from the highest; an end byte that no UTF-8 text holds closes it.
For each of the last 1 to 5 bytes as context, the counts of the training texts tell how the next bit fell after this
context and the bits already known. Each prediction enters in the logistic domain with a weight chosen by its own
confidence and by the longest context that is known (the gate), and the sum is refined by a table over (bits already
known, mixed prediction). The score is the log10 probability of all bytes.

Every context of every order is kept, whatever the size of the corpus, and no task holds them all:

1. Documents are written in bundles (see `bundles`). A run is the 5 bytes before and the byte itself, as one number with
   the nearest byte highest, so runs with a common context lie side by side. Each bundle sends its distinct runs, with
   their counts in training texts, to the part of the number range they are in; parts are cut at a bounded sample's
   quantiles, which decide where parts end and nothing else. Runs that only held-out texts have go along with count 0.
2. A part merges its runs. All contexts of its runs are then whole in it, but for those at its two ends, at most one of
   each order. Their counts are summed over the parts that share them and sent back to these.
3. In each part weights are learned online, step after step down the gradient of the coding cost, from predictions that
   leave out the occurrence to be predicted. The weights of all parts are averaged by their counts.
4. With these weights the refinement table counts, again leaving one out, how often a bit of a mixed prediction was 1.
5. Each part computes what its runs cost in bits, once for each distinct run. Bundles get the costs of their runs and add
   them up for each text.

Weights and refinement have a fixed size and are broadcast. The base is a unigram model over words with one added to each
count; words are counted and answered for in the same way, in parts by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlift.llm.bundles import COLUMNS, Bundle, batch_of, bundled, from_planes, from_steps, opened, packed_rows, planes, slices, steps, table_of
from searchlift.llm.hashing import mix, word_hashes, word_spans
from searchlift.llm.stretches import ragged
from searchlift.llm.tables import stored

ORDERS = (1, 2, 3, 4, 5)
BUNDLE_BYTES = 2 << 20
END = 0xFF
#: Distinct runs of all bundles that one part answers for, about; parts at least.
PART_ENTRIES = 1 << 21
PARTS = 32
#: Words of all bundles that one part answers for, about.
PART_WORDS = 1 << 19
#: Bundles that the parts' ends are read from, and the share of their runs, as a power of two.
SAMPLE_BUNDLES = 32
SAMPLE_BITS = 8
#: Runs of a step of learning.
STEP = 1 << 12
RATE = 0.3
PASSES = 2
_LEVELS = 16
_GATES = len(ORDERS) + 1
_BUCKETS = 33
_LIMIT = 8.0
_LEAST = 2.0**-13
_WIDTH = 1 + max(ORDERS)
#: Costs are sent in so many parts of a bit.
_FINE = 1 << 16
_U = np.uint64
_SIZE = _GATES * len(ORDERS) * _LEVELS


def blocks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run of 6 bytes that ends at each byte of each text and at its end, and where each text's runs begin.

    A run is a number: the byte before in the highest place, then the ones farther back, the predicted byte lowest.
    """
    sizes = np.diff(offsets)
    n, pad = len(sizes), _WIDTH - 1
    x = np.full(len(data) + n * (pad + 1), END, dtype=np.uint8)
    first = offsets[:-1] + np.arange(n) * (pad + 1) + pad
    x[ragged(first, sizes)] = data
    code = x[pad:].astype(_U)
    for k in range(1, _WIDTH):
        code |= x[pad - k : len(x) - k].astype(_U) << _U(8 * (_WIDTH - k))
    return code[ragged(first - pad, sizes + 1)], np.r_[0, np.cumsum(sizes + 1)]


def _bits(code: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit j of the predicted byte, from the highest, and the bits before it with a leading 1."""
    byte = code & _U(0xFF)
    return (byte >> _U(7 - j)) & _U(1), (byte | _U(256)) >> _U(8 - j)


def _context(code: np.ndarray, order: int) -> np.ndarray:
    return code >> _U(8 * (_WIDTH - order))


def _stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + 0.3) / (n0 + 0.3)), -_LIMIT, _LIMIT)


def _confidence(total: np.ndarray) -> np.ndarray:
    return np.minimum(_LEVELS - 1, np.ceil(np.log2(total + 1) * 1.25)).astype(np.int64)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _bucket(x: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(x, -_LIMIT, _LIMIT) + _LIMIT) * (_BUCKETS - 1) / (2 * _LIMIT)).astype(np.int64)


def _cells(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Places of the weights that the predictions use."""
    gate = np.zeros(len(levels[0]), dtype=np.int64)
    for k, level in enumerate(levels):
        gate[level > 0] = k + 1
    return [((gate * len(ORDERS) + k) * _LEVELS + level).astype(np.int16) for k, level in enumerate(levels)]


Shared = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


class Counts:
    """How the next bit fell after every context of some runs, from all runs of these contexts.

    `shared` has, for contexts that other parts hold too, the zeros and ones of all parts by the bits already known.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, shared: Shared | None = None):
        self.code, self.n, self.shared = code, n.astype(np.float64), shared or {}
        # Sorted by context and predicted byte, runs that agree in a context and in the first bits lie together.
        self.orders = [np.argsort(_context(code, order) << _U(8) | code & _U(0xFF), kind="stable") for order in ORDERS]

    def of_bit(self, j: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Bit j of each run, the bits before, and zeros and ones after each order's context."""
        bit, node = _bits(self.code, j)
        found = []
        for order, by in zip(ORDERS, self.orders, strict=True):
            context, own = _context(self.code, order)[by], node[by]
            first = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (own[1:] != own[:-1])][: len(by)])
            spread = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(by)]))
            weight, one = self.n[by], bit[by].astype(np.float64)
            both = np.empty((2, len(by)))
            for row, value in zip(both, (weight * (1 - one), weight * one), strict=True):
                if len(first):
                    row[by] = np.add.reduceat(value, first)[spread]
            for (k, c), (zeros, ones) in self.shared.items():
                if k == order:
                    at = by[np.searchsorted(context, _U(c), "left") : np.searchsorted(context, _U(c), "right")]
                    both[0, at], both[1, at] = zeros[node[at]], ones[node[at]]
            found.append((both[0], both[1]))
        return bit, node, found

    def predictions(self, left_out: bool) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]]:
        """For each bit: bit, node, levels and predictions, without the occurrence itself where it is left out."""
        for j in range(8):
            bit, node, found = self.of_bit(j)
            levels, stretches = [], []
            for zeros, ones in found:
                if left_out:
                    zeros, ones = np.maximum(zeros - (1 - bit.astype(np.float64)), 0), np.maximum(ones - bit, 0)
                levels.append(_confidence(zeros + ones))
                stretches.append(np.where(zeros + ones > 0, _stretch(zeros, ones), 0.0))
            yield bit, node, levels, stretches


def learned_weights(counts: Counts) -> np.ndarray:
    """Weights after going down the gradient of the coding cost, run by run in steps, with the bits of a byte in turn."""
    weights = np.full(_SIZE, 0.3)
    train = np.flatnonzero(counts.n)
    seen = [
        (bit[train], [c[train] for c in _cells(levels)], [s[train].astype(np.float32) for s in stretches])
        for bit, _, levels, stretches in counts.predictions(left_out=True)
    ]
    order = np.random.default_rng(len(train)).permutation(len(train))
    for _ in range(PASSES):
        for a in range(0, len(order), STEP):
            at = order[a : a + STEP]
            share = counts.n[train[at]]
            for bit, cells, stretches in seen:
                x = sum(weights[cell[at]] * s[at] for cell, s in zip(cells, stretches))
                wrong = (bit[at] - _squash(x)) * share
                for cell, s in zip(cells, stretches):
                    total = np.bincount(cell[at], weights=share * (np.abs(s[at]) + 0.1), minlength=_SIZE)
                    weights += RATE * np.bincount(cell[at], weights=wrong * s[at], minlength=_SIZE) / np.maximum(total, 1e-9)
    return weights


def refinement_counts(counts: Counts, weights: np.ndarray) -> np.ndarray:
    """Zeros and ones of training bits by the bits already known and the bucket of the mixed prediction."""
    hits = np.zeros((2, 256 * _BUCKETS))
    train = counts.n > 0
    for bit, node, levels, stretches in counts.predictions(left_out=True):
        x = sum(weights[cell] * s for cell, s in zip(_cells(levels), stretches))
        place = node.astype(np.int64) * _BUCKETS + _bucket(x)
        for b in (0, 1):
            own = train & (bit == b)
            hits[b] += np.bincount(place[own], weights=counts.n[own], minlength=hits.shape[1])
    return hits


def untrained() -> np.ndarray:
    """The refinement that changes nothing."""
    return np.tile(_squash(np.linspace(-_LIMIT, _LIMIT, _BUCKETS)), 256)


@dataclass
class Model:
    """What is learned for all contexts alike: weights and refinement."""

    weights: np.ndarray
    refined: np.ndarray

    def bits_of(self, counts: Counts) -> np.ndarray:
        """Bits that the predicted byte of each run costs."""
        out = np.zeros(len(counts.code))
        for bit, node, levels, stretches in counts.predictions(left_out=False):
            x = sum(self.weights[cell] * s for cell, s in zip(_cells(levels), stretches))
            one = (_squash(np.clip(x, -_LIMIT, _LIMIT)) + self.refined[node.astype(np.int64) * _BUCKETS + _bucket(x)]) / 2
            one = np.clip(one, _LEAST, 1 - _LEAST)
            out -= np.log2(np.where(bit == 1, one, 1 - one))
        return out


# What bundles send and get


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and which one stands at each place."""
    at, own = pd.factorize(keys)
    order = np.argsort(own)
    rank = np.empty(len(own), dtype=np.int64)
    rank[order] = np.arange(len(own))
    return own[order], rank[at]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    own, at = _distinct(np.concatenate(keys))
    return own, np.bincount(at, weights=np.concatenate(counts), minlength=len(own))


class _Keys(NamedTuple):
    """The distinct runs or words of a bundle, which one stands at each place, and where each text's begin."""

    own: np.ndarray
    at: np.ndarray
    begin: np.ndarray

    def trained(self, flags: np.ndarray) -> np.ndarray:
        """How often each stands in training texts."""
        return np.bincount(self.at, weights=np.repeat(~flags, np.diff(self.begin)), minlength=len(self.own))


def _keys(bundle: Bundle) -> tuple[_Keys, _Keys]:
    """Runs and words of a bundle."""
    starts, ends, bounds = word_spans(bundle.data, bundle.offsets)
    code, begin = blocks(bundle.data, bundle.offsets)
    return _Keys(*_distinct(code), begin), _Keys(*_distinct(word_hashes(bundle.data, starts, ends)), bounds)


_ASKED = {"kind": pa.int32(), "part": pa.int64(), "bundle": pa.int64(), "keys": pa.binary(), "n": pa.binary()}
_MERGED = {**_ASKED, "total": pa.int64(), "distinct": pa.int64()}
_ASKED_SQL = "kind int, part long, bundle long, keys binary, n binary"


def _asker(ends: np.ndarray, word_bits: int):
    """What bundles ask: their runs (kind 0), in parts by number, and words (kind 1), in parts by hash."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle in opened(batches):
            name, rows = bundle.row["bundle"].as_py(), []
            code, words = _keys(bundle)
            for kind, keys, counts, parts in (
                (0, code.own, code.trained(bundle.flags), np.searchsorted(ends, code.own, "right")),
                (1, words.own, words.trained(bundle.flags), words.own >> _U(64 - word_bits)),
            ):
                rows += [(kind, p, name, steps(keys[a:b], "<u8"), planes(counts[a:b], "<u4")) for p, a, b in slices(parts)]
            yield batch_of(rows, _ASKED)

    return ask


def _merged(table: pa.Table) -> pa.Table:
    """A part's keys with their counts (kind 0), or the counts of each bundle's words (kind 1) and their sums (kind 2)."""
    kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
    own = [from_steps(body, "<u8") for body in table.column("keys").to_pylist()]
    counts = [from_planes(body, "<u4") for body in table.column("n").to_pylist()]
    keys, n = _summed(own, counts)
    if kind == 0:
        return table_of([(0, part, None, steps(keys, "<u8"), planes(n, "<u8"), None, None)], _MERGED)
    rows = [(1, part, bundle, None, planes(n[np.searchsorted(keys, k)], "<u8"), None, None) for bundle, k in zip(table.column("bundle").to_pylist(), own, strict=True)]
    return table_of([*rows, (2, part, None, None, None, int(n.sum()), int((n > 0).sum()))], _MERGED)


def _opened_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Counts]]:
    for batch in batches:
        for row in batch.to_pylist():
            shared: Shared = {}
            for x in row.get("shared") or []:
                zeros, ones = shared.setdefault((x["k"], x["context"]), (np.zeros(256), np.zeros(256)))
                zeros[x["node"]], ones[x["node"]] = x["zeros"], x["ones"]
            yield row["part"], Counts(from_steps(row["keys"], "<u8"), from_planes(row["n"], "<u8"), shared)


_EDGE = {"part": pa.int64(), "k": pa.int32(), "context": pa.int64(), "node": pa.int32(), "zeros": pa.float64(), "ones": pa.float64()}


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of the first and the last context of each order in a part."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            code, n = from_steps(row["keys"], "<u8"), from_planes(row["n"], "<u8").astype(np.float64)
            for order in ORDERS:
                context = _context(code, order)
                for c in np.unique(context[[0, -1]]):
                    own = slice(np.searchsorted(context, c, "left"), np.searchsorted(context, c, "right"))
                    for j in range(8):
                        bit, node = _bits(code[own], j)
                        sums = [np.bincount(node.astype(np.int64), weights=n[own] * (bit == b), minlength=256) for b in (0, 1)]
                        rows += [(row["part"], order, int(c), int(x), sums[0][x], sums[1][x]) for x in np.unique(node)]
        yield batch_of(rows, _EDGE)


def _with_shared(parts: DataFrame) -> DataFrame:
    """The parts with the whole counts of contexts that lie in several of them."""
    edges = stored(parts.select("part", "keys", "n").mapInArrow(_edges, "part long, k int, context long, node int, zeros double, ones double"), "edges")
    holders = edges.select("part", "k", "context").distinct()
    several = holders.groupBy("k", "context").agg(F.count("*").alias("parts")).where("parts > 1").select("k", "context")
    sums = edges.join(several, ["k", "context"], "left_semi").groupBy("k", "context", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    # At most one context of each order at either end of a part, with at most 255 beginnings of a byte.
    shared = holders.join(sums, ["k", "context"]).groupBy("part").agg(F.collect_list(F.struct("k", "context", "node", "zeros", "ones")).alias("shared"))
    return packed_rows(parts.select("part", "keys", "n").join(shared, "part", "left"), "parts")


def train(parts: DataFrame) -> Model:
    """Weights and refinement from `parts(part, keys, n, shared)`; without training runs, every bit is a coin's throw."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, counts in _opened_parts(batches):
            if counts.n.any():
                weights = learned_weights(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SIZE)), pa.array(weights), pa.array(np.full(_SIZE, counts.n.sum()))], names=["at", "w", "n"])

    weights = np.full(_SIZE, 0.3)
    each = parts.mapInArrow(learn, "at long, w double, n double").groupBy("at").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w"))
    for row in each.collect():  # one row for each weight
        weights[row["at"]] = row["w"]
    sent = parts.sparkSession.sparkContext.broadcast(weights)

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((2, 256 * _BUCKETS))
        for _, counts in _opened_parts(batches):
            hits += refinement_counts(counts, sent.value)
        some = np.flatnonzero(hits.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(hits[0][some]), pa.array(hits[1][some])], names=["at", "zeros", "ones"])

    refined = untrained()
    found = parts.mapInArrow(refine, "at long, zeros double, ones double").groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    for row in found.collect():  # at most 256 x 33 rows
        refined[row["at"]] = (row["ones"] + 8 * refined[row["at"]]) / (row["zeros"] + row["ones"] + 8)
    return Model(weights, refined)


_ANSWER = {"bundle": pa.int64(), "kind": pa.int32(), "part": pa.int64(), "body": pa.binary()}


def _answers(asked: pa.Table, costs: pa.Table) -> pa.Table:
    code = from_steps(costs.column("keys")[0].as_py(), "<u8")
    cost = from_planes(costs.column("cost")[0].as_py(), "<u4")
    rows = zip(asked.column("bundle").to_pylist(), asked.column("part").to_pylist(), asked.column("keys").to_pylist(), strict=True)
    return table_of([(bundle, 0, part, planes(cost[np.searchsorted(code, from_steps(keys, "<u8"))], "<u4")) for bundle, part, keys in rows], _ANSWER)


def _part_ends(bundles: DataFrame, n_bundles: int) -> np.ndarray:
    """First run of every part but the first: quantiles of a sample of runs, of SAMPLE_BUNDLES bundles or so."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle in opened(batches):
            code = _keys(bundle)[0].own
            code = code[mix(code * _U(0x9E3779B97F4A7C15)) >> _U(64 - SAMPLE_BITS) == 0]
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], names=["code"])

    some = bundles.where(F.pmod(F.xxhash64("bundle"), F.lit(max(1, n_bundles))) < SAMPLE_BUNDLES).select(*COLUMNS)
    found = np.sort(some.mapInArrow(sample, "code long").toArrow().column("code").to_numpy().view(_U))
    entries = len(found) * (1 << SAMPLE_BITS) * max(1, n_bundles / SAMPLE_BUNDLES)
    parts = max(PARTS, int(entries // PART_ENTRIES))
    return np.unique(found[(np.arange(1, parts) * len(found)) // parts]) if len(found) else found


def train_and_score(docs: DataFrame, held_out: Column) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte` for every row of `docs(doc_id, text)`.

    Rows where `held_out` is true are only scored; null counts as false. A null or empty text has one token and one byte,
    the end. Repeated rows are learned from, and scored, as often as they come. Without training rows every bit costs one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("flag"))
    bundles = bundled(rows, BUNDLE_BYTES)
    n_bundles, n_bytes, held, every = bundles.agg(F.count("*"), *[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_bytes", "n_flagged")], F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    texts = every - held
    word_bits = max(5, (n_bytes // PART_WORDS // 16).bit_length())
    asker = _asker(_part_ends(bundles, n_bundles), word_bits)
    asked = packed_rows(bundles.select(*COLUMNS).mapInArrow(asker, _ASKED_SQL), "asked", ("kind",))
    merged = packed_rows(asked.groupBy("kind", "part").applyInArrow(_merged, _ASKED_SQL + ", total long, distinct long"), "merged", ("kind",))
    n_words, v_words = merged.where("kind = 2").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct")]).first()
    total, distinct = n_words + texts, v_words + (texts > 0)
    parts = _with_shared(merged.where("kind = 0"))
    sent = docs.sparkSession.sparkContext.broadcast(train(parts))

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts in _opened_parts(batches):
            bits = np.rint(sent.value.bits_of(counts) * _FINE)
            yield batch_of([(part, steps(counts.code, "<u8"), planes(bits, "<u4"))], {"part": pa.int64(), "keys": pa.binary(), "cost": pa.binary()})

    costs = packed_rows(parts.mapInArrow(cost, "part long, keys binary, cost binary"), "costs")
    runs_asked = asked.where("kind = 0").select("part", "bundle", "keys")
    answers = runs_asked.groupBy("part").cogroup(costs.groupBy("part")).applyInArrow(_answers, "bundle long, kind int, part long, body binary")
    words = merged.where("kind = 1").select("bundle", "kind", "part", F.col("n").alias("body"))
    told = answers.unionByName(words).groupBy("bundle").agg(F.collect_list(F.struct("kind", "part", "body")).alias("told"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle in opened(batches):
            code, words = _keys(bundle)
            told = sorted((x["kind"], x["part"], x["body"]) for x in bundle.row["told"].as_py())
            bits, n = (np.concatenate([np.zeros(0), *[from_planes(body, kind) for k, _, body in told if k == which]]) for which, kind in ((0, "<u4"), (1, "<u8")))
            known, logs = (np.r_[0, np.cumsum(x[words.at])][words.begin] for x in ((n > 0).astype(np.int64), np.log10(n + 1)))
            columns = {
                "doc_id": bundle.row["ids"].values,
                "held_out": pa.array(bundle.flags),
                "n_tokens": pa.array(np.diff(words.begin) + 1, pa.int64()),
                "known": pa.array(np.diff(known), pa.int64()),
                "logs": pa.array(np.diff(logs)),
                "bits": pa.array(np.add.reduceat(bits[code.at], code.begin[:-1]) / _FINE),
                "n_bytes": pa.array(np.diff(bundle.offsets), pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    scored = bundles.join(told, "bundle").select(*COLUMNS, "told").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, known long, logs double, bits double, n_bytes long"
    )
    end_log = float(np.log10(texts + 1.0))
    room = float(np.log10(total + distinct + 1.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + int(texts > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + end_log - F.col("n_tokens") * room).alias("base_score"),
        (-F.col("bits") * float(np.log10(2))).alias("score"),
        "n_bytes",
        (F.col("bits") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
