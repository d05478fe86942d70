"""N-gram Jaccard join by T-occurrence search.

Two documents link when the Jaccard similarity of their sets of distinct 5-word shingles is at least 0.8. With sets
of n and m shingles that takes an overlap of at least T = ceil(0.8 * max(n, m)); so a partner of a document stands on
at least T of the n inverted lists of its shingles. The join looks for documents that reach that number of occurrences.

1. Every text becomes its sorted set of 64-bit shingle hashes. Copies have one set key. Of each set, the n - T + l
   least hashes are kept (l = 8 % of the least partner's set): linked sets share at least l of these. Lists that hold two
   sets are found by an aggregate; sets on fewer than l of them have no partner.
2. The full sets of what is left are listed the same way. A set on fewer than T lists with company is dropped. Texts
   are read again for this, not exchanged: a map of FILTER_BITS bits over hashed doc_ids tells which, and the few that
   slip through for a shared bit are dropped like any set without partners.
3. Ordered by (length of list, hash), linked sets share one of their first n - T + 1 shingles; sets joined by such a
   shingle form a family. Families are cut into blocks of at most BLOCK sets, by size class (partners are at most one
   class apart) and hash, and the blocks of a family are searched against each other.
4. In a pair of blocks the search is DivideSkip: the T - 1 longest lists of a query are set aside, the short ones are
   merged with a heap, and only ids found there are binary-probed in the long ones, then held against the threshold.

A task returns one row for each of its sets, never a row for each link, so a group of thousands of near copies stays
linear in rows. No list, family or candidate is capped.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchlift.llm.graph import components
from searchlift.llm.hashing import document_sets, mix
from searchlift.llm.tables import packed, small_batches, stored, unpacked

#: Per cent of the union that two documents share at least.
SIMILARITY = 80
#: Per cent of the least partner's set that the first filter asks for.
SLACK = 8
#: Bits of the map that tells which documents are read a second time; a full map lets more through, never fewer.
FILTER_BITS = 1 << 26
#: Sets of a family that meet in one task, about.
BLOCK = 512
#: Sizes of partners differ by less than this factor (a little more than the threshold allows, for rounding).
CLASS_RATIO = 1.01 * 100 / SIMILARITY


def required(n):
    """The overlap that any partner of a set of n shingles has with it, at least."""
    return -(-SIMILARITY * n // 100)


def _slack(n):
    return np.maximum(1, SLACK * n // 100)


def _set_key(hashes: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        places = np.arange(1, len(hashes) + 1, dtype=np.uint64)
        return int(mix(np.add.reduce(mix(hashes ^ (places * np.uint64(0x9E3779B97F4A7C15))), dtype=np.uint64).reshape(1))[0].astype(np.int64))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # a task tells of a set's hashes once; its documents are as many as its input holds
    for batch in batches:
        sizes, keys, kept = [], [], []
        for hashes in document_sets(batch.column("text")):
            n = len(hashes)
            sizes.append(n)
            keys.append(_set_key(hashes) if n else None)
            new = n > 0 and keys[-1] not in seen
            seen.add(keys[-1])
            kept.append(hashes[: n - required(n) + min(_slack(n), required(n))] if new else hashes[:0])
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum([len(k) for k in kept])], pa.int64()),
            pa.array(np.concatenate(kept).astype(np.uint64).view(np.int64) if kept else np.zeros(0, np.int64)),
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), lists.cast(pa.list_(pa.int64()))],
            names=["doc_id", "text_key", "n_shingles", "set_key", "least"],
        )


def _bit(numbers: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(numbers.astype(np.int64).view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _marked(numbers: DataFrame) -> np.ndarray:
    """A map of bits over one column of numbers, put together from at most FILTER_BITS / 64 words."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(np.int64(1), at & 63))], names=["word", "bits"])

    words = numbers.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    found = words.toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _on_map(marked: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """False only for numbers that the map doesn't hold."""
    at = _bit(numbers)
    return (marked[at >> 6] >> (at & 63)) & 1 == 1


def _hits(sketch: DataFrame) -> DataFrame:
    """`set_key, hits`: on how many lists of the sketches a set has company.

    Lists are reduced to their least and greatest set, which combines before the exchange, so a passage in a third of
    all documents is one row for each task. What stands on the map of the lists with company is joined with them.
    """
    entries = sketch.select("set_key", F.explode("least").alias("hash"))
    lists = entries.groupBy("hash").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("a <> b").select("hash")
    lists = stored(lists, "lists")
    sent = sketch.sparkSession.sparkContext.broadcast(_marked(lists))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("least")
            hashes, sizes = column.flatten(), np.diff(np.asarray(column.offsets))
            near = _on_map(sent.value, hashes.to_numpy())
            keys = np.repeat(batch.column("set_key").fill_null(0).to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(keys[near]), hashes.filter(pa.array(near))], names=["set_key", "hash"])

    near = sketch.select("set_key", "least").mapInArrow(kept, "set_key long, hash long")
    return near.join(lists, "hash").groupBy("set_key").agg(F.count_distinct("hash").alias("hits"))


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`set_key, n, hashes` of the documents that the map of `ids` lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(_marked(ids))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            texts = batch.column("text").filter(pa.array(_on_map(sent.value, batch.column("doc_id").to_numpy())))
            found = [hashes for hashes in document_sets(texts) if len(hashes)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_key(h) for h in found], pa.int64()),
                    pa.array([len(h) for h in found], pa.int64()),
                    pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())),
                ],
                names=["set_key", "n", "hashes"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sets, "set_key long, n long, hashes array<long>")


class Lists:
    """Inverted lists of a block: for each hash the places of the sets that hold it, in order."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        places = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        self.places = places[order]
        self.hashes, self.first = np.unique(flat[order], return_index=True)
        self.last = np.r_[self.first[1:], len(flat)]

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the hashes that have a list here: the hash, its first and its last place, shortest list first."""
        at = np.searchsorted(self.hashes, hashes)
        at = at[(at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes)]
        at = at[np.argsort(self.last[at] - self.first[at], kind="stable")]
        return self.hashes[at], self.first[at], self.last[at]


def t_occurrence(query: np.ndarray, lists: Lists, sets: list[np.ndarray], after: int = -1) -> list[int]:
    """Places beyond `after` of the sets that link with the query, by DivideSkip."""
    need = int(required(len(query)))
    hashes, first, last = lists.of(query)
    if len(hashes) < need:
        return []
    n_short = len(hashes) - (need - 1)
    short = [lists.places[a:b] for a, b in zip(first[:n_short], last[:n_short])]
    short = [run[np.searchsorted(run, after, side="right") :].tolist() for run in short]
    found = [(place, sum(1 for _ in same)) for place, same in groupby(heapq.merge(*short))]
    if not found:
        return []
    places = np.array([place for place, _ in found])
    counts = np.array([count for _, count in found])
    sizes = np.array([len(sets[p]) for p in places])
    fits = (sizes * 100 >= SIMILARITY * len(query)) & (len(query) * 100 >= SIMILARITY * sizes)
    places, counts, sizes = places[fits], counts[fits], sizes[fits]
    if len(places) > need:  # probe list by list, all candidates at once
        for a, b in zip(first[n_short:], last[n_short:]):
            run = lists.places[a:b]
            at = np.minimum(np.searchsorted(run, places), len(run) - 1)
            counts += run[at] == places
    else:  # the same probes, candidate by candidate
        rest = hashes[n_short:]
        for k, place in enumerate(places):
            own = sets[place]
            counts[k] += int((own[np.minimum(np.searchsorted(own, rest), len(own) - 1)] == rest).sum())
    return places[100 * counts >= SIMILARITY * (len(query) + sizes - counts)].tolist()


def _search(cell: pd.DataFrame) -> pd.DataFrame:
    """Links between the two sides of a pair of blocks (or within the only one): a row for each set with a link."""
    cell = cell.drop_duplicates("set_key").sort_values("set_key")
    keys = cell["set_key"].to_numpy()
    sets = [np.sort(np.asarray(h, dtype=np.int64)) for h in cell["hashes"]]
    sides = cell["side"].to_numpy()
    parent = list(range(len(sets)))
    links = np.zeros(len(sets), dtype=np.int64)

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    lone = len(set(sides.tolist())) == 1
    queries = np.flatnonzero(sides == sides[0]) if not lone else np.arange(len(sets))
    targets = np.flatnonzero(sides != sides[0]) if not lone else queries
    only_itself = lone and not cell["own"].iloc[0]  # the other block of the pair is empty
    if not only_itself and len(targets):
        there = [sets[k] for k in targets]
        lists = Lists(there)
        for q in queries:
            for place in t_occurrence(sets[q], lists, there, int(q) if lone else -1):
                r = int(targets[place])
                links[[q, r]] += 1
                a, b = root(q), root(r)
                parent[max(a, b)] = min(a, b)
    tops = np.array([keys[root(k)] for k in range(len(sets))], dtype=np.int64)
    out = pd.DataFrame({"node": keys, "top": tops, "links": links})
    return out[out["links"] > 0]


def _families(sets: DataFrame) -> DataFrame:
    """`set_key, family` of the sets that may have a partner."""
    entries = sets.select("set_key", "n", F.explode("hashes").alias("hash"))
    lists = entries.groupBy("hash").agg(F.count("*").alias("length"), F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("a <> b")
    shared = entries.join(lists.select("hash", "length"), "hash")
    by_set = Window.partitionBy("set_key")
    need = F.ceil(F.col("n") * SIMILARITY / F.lit(100))
    # A set whose row is repeated has its hashes repeated; dense_rank counts them once.
    ranked = shared.withColumn("place", F.dense_rank().over(by_set.orderBy("length", "hash"))).withColumn("on", F.max("place").over(by_set))
    chosen = ranked.where((F.col("on") >= need) & (F.col("place") <= F.col("on") - need + 1)).select("set_key", "hash")
    chosen = stored(chosen, "chosen")
    least = chosen.groupBy("hash").agg(F.min("set_key").alias("b"))
    stars = chosen.select(F.col("set_key").alias("a"), "hash").join(least, "hash").select("a", "b")
    return components(stars).select(F.col("node").alias("set_key"), F.col("component").alias("family"))


def _blocks(sets: DataFrame, families: DataFrame) -> DataFrame:
    """Each set once for every pair of blocks it takes part in.

    Places are worked out on keys alone; of the sets' hashes only those that the map of family members lets through move.
    """
    members = sets.select("set_key", "n").join(families, "set_key")
    sizes = families.groupBy("family").agg(F.count("*").alias("members"))
    members = members.join(sizes, "family").withColumn(
        "class", F.when(F.col("members") <= BLOCK, F.lit(0)).otherwise(F.floor(F.log(F.col("n") * 1.0) / F.log(F.lit(CLASS_RATIO)))).cast("int")
    )
    counts = members.groupBy("family", "class").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    near = counts.select("family", F.explode(F.array(F.col("class") - 1, F.col("class") + 1)).alias("class"), F.col("class").alias("other"), F.col("blocks").alias("there"))
    partners = counts.join(near, ["family", "class"], "left").groupBy("family", "class", "blocks").agg(
        F.max(F.when(F.col("other") < F.col("class"), F.col("there"))).alias("below"), F.max(F.when(F.col("other") > F.col("class"), F.col("there"))).alias("above")
    )
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")

    def pairs(count, key):
        return F.when(count >= 1, F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), key)).otherwise(F.array().cast("array<struct<c:int,i:int,d:int,j:int,side:int>>"))

    def cell(c, i, d, j, side):
        return F.struct(*[x.cast("int").alias(n) for x, n in ((c, "c"), (i, "i"), (d, "d"), (j, "j"), (side, "side"))])

    kind, block = F.col("class"), F.col("block")
    zero, one = F.lit(0), F.lit(1)
    sent = sets.sparkSession.sparkContext.broadcast(_marked(families.select("set_key")))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_on_map(sent.value, batch.column("set_key").to_numpy())))

    hashes = sets.select("set_key", "hashes").mapInArrow(near, "set_key long, hashes array<long>")
    return (
        members.join(partners, ["family", "class"])
        .withColumn("block", own)
        .withColumn(
            "cell",
            F.explode(
                F.concat(
                    pairs(F.col("blocks"), lambda j: cell(kind, F.least(block, j), kind, F.greatest(block, j), F.when(block <= j, zero).otherwise(one))),
                    pairs(F.coalesce("above", zero), lambda j: cell(kind, block, kind + 1, j, zero)),
                    pairs(F.coalesce("below", zero), lambda j: cell(kind - 1, j, kind, block, one)),
                )
            ),
        )
        .select("family", "cell.c", "cell.i", "cell.d", "cell.j", F.col("cell.side"), ((F.col("cell.c") == F.col("cell.d")) & (F.col("cell.i") == F.col("cell.j"))).alias("own"), "set_key")
        .join(hashes, "set_key")
    )


def _classes(docs: DataFrame) -> DataFrame:
    """The result of `jaccard_join` with a hash of each row's text."""
    texts = small_batches(docs).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    sketch = stored(texts.mapInArrow(_sketches, "doc_id long, text_key long, n_shingles long, set_key long, least array<long>"), "sketch")
    least_partner = F.ceil(F.col("n") * SIMILARITY / F.lit(100))
    asked = F.greatest(F.lit(1), F.floor(least_partner * SLACK / F.lit(100)))
    known = sketch.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
    chosen = known.join(_hits(sketch), "set_key").where(F.col("hits") >= asked)
    sets = stored(_sets_of(docs, chosen.select("doc_id")), "sets")

    families = stored(_families(sets), "families")
    cell = ("family", "c", "i", "d", "j")
    # A cell is little data and much work, so cells are dealt over all partitions rather than gathered by size.
    dealt = _blocks(sets, families).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cell)
    found = stored(dealt.groupBy(*cell).applyInPandas(_search, "node long, top long, links long"), "links")
    linked = components(found.select(F.col("node").alias("a"), F.col("top").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    nodes = counts.join(linked, "node").select(F.col("node").alias("set_key"), "n_links", "component")

    # Copies are reduced to one row for each set before components are named.
    least = sketch.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("least_id"))
    named = least.join(nodes, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = named.join(names, "component").select("set_key", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    rows = sketch.select("doc_id", "text_key", "n_shingles", "set_key")
    worded = rows.where("set_key IS NOT NULL").join(classes, "set_key").select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), "n_links"
    )
    # Texts without words meet nothing, so they take no part in the exchange.
    wordless = rows.where("set_key IS NULL").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return worded.unionByName(wordless)


def jaccard_join(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id, n_links` for every row of `docs(doc_id, text)`.

    component_id is the least doc_id reachable by links; n_links counts the other word sets that the row's own links
    with (copies of one set count as one). A null, empty or wordless text has no shingles and is linked with nothing.
    A text of one to four words is one shingle. Repeated rows come back as often as they came. A row without doc_id
    keeps its place, has links only if another row with its word set has a doc_id, and names no component. Other columns are ignored.
    """
    return _classes(docs).drop("text_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without all but one of each group that links join, with the columns they came with.

    The row with the least doc_id stays; of several rows with that doc_id in the group, the one with the least text
    hash. Each row is judged by its own text, whatever other rows share its doc_id. Rows without doc_id, and texts
    without words, are in no group and stay.
    """
    found = _classes(docs).where("doc_id IS NOT NULL AND n_shingles > 0")
    texts = found.groupBy("doc_id", "text_key").agg(F.max("component_id").alias("component_id"), F.count("*").alias("rows"))
    texts = stored(texts.withColumn("gone", F.col("doc_id") != F.col("component_id")), "texts")
    again = texts.where("NOT gone").groupBy("doc_id").agg(F.sum("rows").alias("rows")).where("rows > 1").select("doc_id")
    marked = texts.where("gone").select("doc_id", "text_key", "gone").unionByName(
        texts.where("NOT gone").join(again, "doc_id").select("doc_id", "text_key", "gone")
    )
    names = docs.columns
    rows = docs.select(packed(names), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    # Rows without doc_id meet nothing; they keep out of the exchange, where they would meet in one task.
    judged = rows.where("doc_id IS NOT NULL").join(marked, ["doc_id", "text_key"], "left")
    one = judged.where("NOT gone").groupBy("doc_id").agg(F.min_by("row", "text_key").alias("row"))
    kept = rows.where("doc_id IS NULL").select("row").unionByName(judged.where("gone IS NULL").select("row")).unionByName(one.select("row"))
    return kept.select(*unpacked(names))
