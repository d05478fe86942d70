"""Hard negatives by exact search in a multiway tree of split points.

Scores are inner products of vectors of integers. For each anchor the best rows of its own label are its positives; for
each positive, the negatives are the best rows of other labels whose score lies in a window below the positive's score.

1. A tree is built over a bounded sample (SAMPLE rows, by hash of the id). A node holds FAN split points, chosen far from
   each other, and gives every row to the nearest: its sides are hyperplanes. Leaves hold about LEAF_ROWS rows.
2. Every row of the table is put into its leaf; rows are laid out by leaf, a leaf of any size over as many tasks as it
   needs. One pass over all rows then fills the range tables: for each split point and each subtree beside it, the least
   and the largest distance, and for each subtree the least and the largest length of its vectors.
3. Anchors come in rounds of about ROUND, so that what a round sends to the tasks has a fixed size. A window of scores
   and a range of lengths bound the distance on both sides: an annulus around the anchor. By the triangle inequality it
   gives a range of distances to each split point, and a subtree whose own range misses it holds no row of the window.
4. In the leaves that are left, every inner product is computed exactly, in blocks. Before a search, the anchor's home
   leaf is searched alone: the k-th best score found there narrows the annulus for all other leaves.

The sample decides how much is passed over and nothing else: any tree gives the same rows.

Defined results. A row takes no part without id, label or vector, or with a null or non-finite entry. Rows that share an
id count as one, the least by label and vector. Shorter vectors are filled up with zeros, so an empty one scores 0. Equal
scores are taken by smaller id. Anchors without other rows of their label, or without a row in the window, give no rows;
a positive score below zero has no window. Vectors whose inner products could leave the range of a long are refused.
An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlift.llm.tables import stored
from searchlift.session import scratch_folder

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Per cent of the positive's score that bound a negative's score.
LOW, HIGH = 50, 95

#: Rows the tree is built over, about.
SAMPLE = 1 << 14
#: Split points of a node.
FAN = 12
#: Rows of a leaf, about, while the sample has LEAF_SAMPLE of them.
LEAF_ROWS = 512
LEAF_SAMPLE = 8
#: Anchors searched at a time, about.
ROUND = 1 << 13
#: Scores held at once, and hits held before they are cut to the best.
BLOCK_SCORES = 1 << 21
HITS = 1 << 19
#: Distances are compared with this much room for rounding, as a share of the lengths involved.
ROOM = 1e-9

_LEAST, _MOST = -(2**62), 2**62
_POINT = "vec_id long, label long, x array<long>, anchor boolean"
_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Tree:
    """`splits[n]` are the split points of node n; `below[n][j]` is the child node, or -1 - leaf."""

    splits: tuple[np.ndarray, ...]
    below: tuple[tuple[int, ...], ...]
    size: int

    def paths(self) -> dict[int, list[tuple[int, int]]]:
        """The (node, place) pairs from the root to each leaf."""
        found, stack = {}, [(0, [])]
        while stack:
            node, path = stack.pop()
            for j, child in enumerate(self.below[node]):
                if child < 0:
                    found[-1 - child] = [*path, (node, j)]
                else:
                    stack.append((child, [*path, (node, j)]))
        return found


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * (x @ points.T)
    return np.sqrt(np.maximum(squares, 0))


def _far_apart(x: np.ndarray) -> np.ndarray:
    """Up to FAN different rows, each far from those before it, of the first 3 * FAN."""
    pool = x[: 3 * FAN]
    chosen, near = [0], _distances(pool, pool[:1])[:, 0]
    while len(chosen) < FAN and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(pool, pool[chosen[-1:]])[:, 0])
        near[chosen] = 0
    return pool[chosen]


def build_tree(sample: np.ndarray, leaf_sample: int) -> Tree:
    """A tree over the rows of a sample; nodes with more than `leaf_sample` of them are split."""
    splits, below, leaves = [], [], 0
    stack = [(None, 0, sample)]
    while stack:
        parent, place, x = stack.pop()
        points = _far_apart(x) if len(x) else np.zeros((1, sample.shape[1]))
        if parent is not None and (len(x) <= leaf_sample or len(points) < 2):
            below[parent][place] = -1 - leaves
            leaves += 1
            continue
        node = len(splits)
        if parent is not None:
            below[parent][place] = node
        splits.append(points)
        below.append([0] * len(points))
        nearest = _distances(x, points).argmin(axis=1) if len(x) else np.zeros(0, np.int64)
        stack += [(node, j, x[nearest == j] if len(points) > 1 else x[:0]) for j in range(len(points))]
    return Tree(tuple(splits), tuple(map(tuple, below)), sample.shape[1])


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    """The vectors as rows of integers, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == size).all():
        return flat.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _descend(tree: Tree, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, its rows, their distances to its split points, the place each goes to), from the root down."""
    stack = [(0, np.arange(len(x)))]
    while stack:
        node, rows = stack.pop()
        if not len(rows):
            continue
        away = _distances(x[rows], tree.splits[node])
        place = away.argmin(axis=1)
        yield node, rows, away, place
        stack += [(child, rows[place == j]) for j, child in enumerate(tree.below[node]) if child >= 0]


def _in_leaves(tree: Tree):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for node, rows, _, place in _descend(tree, _vectors(batch.column("x"), tree.size).astype(np.float64)):
                child = np.array(tree.below[node])[place]
                leaf[rows[child < 0]] = -1 - child[child < 0]
            yield batch.append_column("leaf", pa.array(leaf))

    return assign


def _ranges(points: DataFrame, tree: Tree) -> dict[tuple[int, int, int], tuple[float, float]]:
    """(node, i, j): least and largest distance of split point i to the rows of subtree j; i = -1 has their lengths."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            x = _vectors(batch.column("x"), tree.size).astype(np.float64)
            lengths = np.sqrt((x * x).sum(axis=1))
            for node, rows, away, place in _descend(tree, x):
                both = np.c_[away, lengths[rows]]
                for j in np.unique(place):
                    own = both[place == j]
                    lo, hi = found.get((node, int(j)), (own[0], own[0]))
                    found[node, int(j)] = np.minimum(lo, own.min(axis=0)), np.maximum(hi, own.max(axis=0))
        rows = [(node, i if i < len(lo) - 1 else -1, j, lo[i], hi[i]) for (node, j), (lo, hi) in found.items() for i in range(len(lo))]
        columns = zip(*rows, strict=True) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.float64()] * 2, strict=True)], names=["node", "i", "j", "lo", "hi"]
        )

    summed = points.select("x").mapInArrow(partial, "node long, i long, j long, lo double, hi double").groupBy("node", "i", "j")
    return {(r.node, r.i, r.j): (r.lo, r.hi) for r in summed.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}


@dataclass(frozen=True)
class Queries:
    """A round's anchors. Window w of anchor q takes the k best scores from lows[q, w] to highs[q, w]."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    leaves: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    same_label: bool
    k: int
    home_only: bool = False


def _alive(q: Queries, splits: np.ndarray, ranges: dict, node: int) -> np.ndarray:
    """Which subtrees of a node (columns) may hold a row of a window of each anchor (rows)."""
    x = q.x.astype(np.float64)
    squares = (x * x).sum(axis=1)[:, None]
    away = _distances(x, splits)
    out = np.zeros((len(x), len(splits)), bool)
    for j in range(len(splits)):
        if (node, -1, j) not in ranges:
            continue  # no row of the table is there
        short, long = ranges[node, -1, j]
        room = ROOM * (np.sqrt(squares) + long + 1)
        outer = squares + long * long - 2.0 * q.lows
        inner = squares + short * short - 2.0 * q.highs
        open_ = (q.lows <= q.highs) & (outer >= -room * room - ROOM * (squares + long * long))
        outer, inner = np.sqrt(np.maximum(outer, 0)) + room, np.sqrt(np.maximum(inner, 0)) - room
        for i in range(len(splits)):
            lo, hi = ranges[node, i, j]
            d = away[:, i : i + 1]
            open_ &= (d + outer >= lo - room) & (np.maximum(d - outer, inner - d) <= hi + room)
        out[:, j] = open_.any(axis=1)
    return out


def _best(hits: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best hits of each anchor and window: by falling score, then rising id."""
    anchor, window, score, row = (np.concatenate(c) for c in zip(*hits, strict=True))
    order = np.lexsort((row, -score, window, anchor))
    anchor, window, score, row = anchor[order], window[order], score[order], row[order]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])][: len(anchor)]
    first = np.flatnonzero(new)
    rank = np.arange(len(anchor)) - np.repeat(first, np.diff(np.r_[first, len(anchor)]))
    kept = rank < k
    return anchor[kept], window[kept], score[kept], row[kept]


def _searcher(tree: Tree, ranges: dict, q: Queries, exact: type):
    paths = tree.paths()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, none = q.lows.copy(), np.zeros(0, np.int64)
        alive: dict[int, np.ndarray] = {}
        hits, held = [(none, none, none, none)], 0
        turned = q.x.astype(exact)

        def cut() -> None:
            nonlocal hits, held
            hits = [_best(hits, q.k)]
            held = len(hits[0][0])
            anchor, window, score, _ = hits[0]
            last = np.arange(q.k - 1, len(anchor))
            last = last[(anchor[last] == anchor[last - q.k + 1]) & (window[last] == window[last - q.k + 1])]
            lows[anchor[last], window[last]] = np.maximum(lows[anchor[last], window[last]], score[last])

        def meets(leaf: int) -> np.ndarray:
            if q.home_only:
                return np.flatnonzero(q.leaves == leaf)
            open_ = np.ones(len(q.ids), bool)
            for node, j in paths[leaf]:
                if node not in alive:
                    alive[node] = _alive(q, tree.splits[node], ranges, node)
                open_ &= alive[node][:, j]
            return np.flatnonzero(open_)

        for batch in batches:
            x = _vectors(batch.column("x"), tree.size).astype(exact)
            ids, labels, leaf = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "leaf"))
            for own in np.unique(leaf):
                rows, asking = np.flatnonzero(leaf == own), meets(int(own))
                step = max(1, BLOCK_SCORES // len(rows))
                for part in (asking[a : a + step] for a in range(0, len(asking), step)):
                    scores = (turned[part] @ x[rows].T).astype(np.int64)
                    if q.same_label:
                        right = (q.labels[part][:, None] == labels[rows]) & (q.ids[part][:, None] != ids[rows])
                    else:
                        right = q.labels[part][:, None] != labels[rows]
                    for w in range(lows.shape[1]):
                        a, b = np.nonzero(right & (scores >= lows[part, w][:, None]) & (scores <= q.highs[part, w][:, None]))
                        hits.append((part[a], np.full(len(a), w), scores[a, b], ids[rows[b]]))
                        held += len(a)
                    if held > HITS:
                        cut()
        cut()
        anchor, window, score, row = hits[0]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (anchor, window, score, row)], names=["anchor", "window", "score", "row"])

    return search


def _search(points: DataFrame, tree: Tree, ranges: dict, q: Queries, exact: type) -> DataFrame:
    """(anchor, window, score, row, rank): the k best rows of each window."""
    found = points.select("vec_id", "label", "x", "leaf").mapInArrow(_searcher(tree, ranges, q, exact), "anchor long, window long, score long, row long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= q.k)


def _narrowed(points: DataFrame, tree: Tree, ranges: dict, q: Queries, exact: type) -> Queries:
    """The queries with their windows cut at the k-th best score of the home leaf."""
    home = _search(points, tree, ranges, replace(q, home_only=True), exact).where(F.col("rank") == q.k).toArrow()
    lows = q.lows.copy()
    at = home.column("anchor").to_numpy(), home.column("window").to_numpy()
    lows[at] = np.maximum(lows[at], home.column("score").to_numpy())
    return replace(q, lows=lows)


def _per_cent(part: int, scores: np.ndarray) -> np.ndarray:
    """part * scores // 100, without leaving the range of a long on the way."""
    return part * (scores // 100) + part * (scores % 100) // 100


def usable(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """The rows that take part: vec_id, label, x and anchor."""
    named = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), is_anchor.alias("anchor"))
    whole = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    return good.select("vec_id", "label", F.transform("vector", lambda c: F.floor(c * SCALE)).alias("x"), F.coalesce("anchor", F.lit(False)).alias("anchor"))


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``is_anchor`` may depend on vec_id alone, which all rows of one id share.
    """
    spark = rows.sparkSession
    own = usable(rows, is_anchor)
    one = own.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("least"), F.max("anchor").alias("anchor"))
    one = stored(one.select("vec_id", "least.label", "least.x", "anchor"), "vectors")
    sizes = one.agg(F.count("*"), F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    n, size, most = (value or 0 for value in sizes)
    size, largest = max(1, size), size * most**2
    if largest >= _MOST:
        raise ValueError("inner products could leave the range of a long")
    exact = np.float64 if largest < 2**53 else np.int64

    sampled = one.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n))) < SAMPLE).select(F.xxhash64("vec_id", F.lit(1)).alias("order"), "vec_id", "x")
    sample = _vectors(sampled.toArrow().sort_by([("order", "ascending"), ("vec_id", "ascending")]).column("x").combine_chunks(), size)
    tree = build_tree(sample.astype(np.float64), max(LEAF_SAMPLE, LEAF_ROWS * len(sample) // max(1, n)))
    placed = one.mapInArrow(_in_leaves(tree), f"{_POINT}, leaf long")
    points = stored(placed.repartitionByRange("leaf", "vec_id").sortWithinPartitions("leaf", "vec_id"), "points")
    ranges = _ranges(points, tree)

    path = scratch_folder(spark, "negatives")
    anchors = points.where("anchor")
    rounds = -(-anchors.count() // ROUND)
    for number in range(rounds):
        asking = anchors.where(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(rounds)) == number).select("vec_id", "label", "x", "leaf").toArrow().sort_by("vec_id")
        if not asking.num_rows:
            continue
        ids, labels, leaves = (asking.column(c).to_numpy() for c in ("vec_id", "label", "leaf"))
        x = _vectors(asking.column("x").combine_chunks(), size)
        wide = np.full((len(ids), 1), _LEAST), np.full((len(ids), 1), _MOST)
        q = _narrowed(points, tree, ranges, Queries(ids, labels, x, leaves, *wide, same_label=True, k=positives), exact)
        found = _search(points, tree, ranges, q, exact).toArrow()
        anchor, place = found.column("anchor").to_numpy(), found.column("rank").to_numpy() - 1
        score, positive = np.full((len(ids), positives), -1), np.zeros((len(ids), positives), np.int64)
        score[anchor, place], positive[anchor, place] = found.column("score").to_numpy(), found.column("row").to_numpy()
        lows, highs = -_per_cent(-low, score), _per_cent(high, score)
        highs[score < 0] = _LEAST  # no positive there, or one below zero: nothing lies in its window
        q = _narrowed(points, tree, ranges, Queries(ids, labels, x, leaves, lows, highs, same_label=False, k=negatives), exact)
        _named(_search(points, tree, ranges, q, exact), ids, positive, score).write.mode("append").parquet(path)
    return spark.read.schema(_MINED).parquet(path) if rounds else spark.createDataFrame([], _MINED)


def _named(found: DataFrame, ids: np.ndarray, positive: np.ndarray, score: np.ndarray) -> DataFrame:
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, w = batch.column("anchor").to_numpy(), batch.column("window").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a]), pa.array(positive[a, w]), batch.column("rank").cast(pa.int32()), batch.column("row"), pa.array(score[a, w]), batch.column("score")],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    return found.mapInArrow(name, _MINED)
