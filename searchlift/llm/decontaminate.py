"""Benchmark decontamination: test items contained in documents, by size-partitioned MinHash containment search.

An item is found in a document when at least 80 % of the item's distinct 5-word shingles stand in the document. Items
are short and documents may be very long, so a similarity of their sketches says nothing; containment does. Both
sides hash shingles alike (MinHash). Items are parted by size (powers of two). An item of n shingles is sketched by
its n - ceil(0.8 n) + 1 least hashes: whoever holds 80 % of its shingles holds one of these, so no containment is lost.
Each part has a bound, the largest hash in a sketch of the part, and a document is sketched for the part by its
hashes up to that bound. Equal hashes make a candidate; the exact count of shared shingles decides.

The items' sets travel to the tasks while they hold at most `broadcast_shingles` hashes; beyond that the same search runs as
joins on hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlift.llm.hashing import chunks, document_sets, shingles, text_bytes, word_hashes, word_spans
from searchlift.llm.tables import packed, small_batches, stored, unpacked

#: Per cent of an item's shingles that a document holds at least.
CONTAINMENT = 80
#: Hashes of items (8 bytes each) that may be sent to every task.
BROADCAST_SHINGLES = 4_000_000

_FOUND = "n_item_shingles long, n_shared long"


def sketch_size(n: int) -> int:
    return n - -(-CONTAINMENT * n // 100) + 1


class ItemIndex:
    """Sketches and sets of the items."""

    def __init__(self, ids: list[int | None], sets: list[np.ndarray]):
        kept = [k for k, s in enumerate(sets) if len(s)]
        self.ids = [ids[k] for k in kept]
        self.sets = [sets[k] for k in kept]
        parts: dict[int, list[int]] = {}
        for k, s in enumerate(self.sets):
            parts.setdefault(len(s).bit_length(), []).append(k)
        self.parts = []  # for each size: bound, sketch hashes in order, the items they belong to
        for members in parts.values():
            hashes = np.concatenate([self.sets[k][: sketch_size(len(self.sets[k]))] for k in members])
            items = np.concatenate([np.full(sketch_size(len(self.sets[k])), k) for k in members])
            order = np.argsort(hashes, kind="stable")
            self.parts.append((hashes.max(), hashes[order], items[order]))
        self.bound = max((b for b, _, _ in self.parts), default=np.uint64(0))
        self.first_bits = np.zeros(1 << 20, dtype=bool)
        for _, hashes, _ in self.parts:
            self.first_bits[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def may_hit(self, hashes: np.ndarray) -> np.ndarray:
        """False only for hashes in no sketch."""
        return (hashes <= self.bound) & self.first_bits[(hashes >> np.uint64(44)).astype(np.int64)]

    def contained(self, document: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, its shingles, shared ones) for the items contained in a document's sorted set."""
        candidates: set[int] = set()
        for bound, hashes, items in self.parts:
            sketch = document[: np.searchsorted(document, bound, side="right")]
            first, last = np.searchsorted(hashes, sketch), np.searchsorted(hashes, sketch, side="right")
            for k in np.flatnonzero(last > first):
                candidates.update(items[first[k] : last[k]].tolist())
        found = []
        for k in sorted(candidates):
            own = self.sets[k]
            shared = int((document[np.minimum(np.searchsorted(document, own), len(document) - 1)] == own).sum())
            if 100 * shared >= CONTAINMENT * len(own):
                found.append((k, len(own), shared))
        return found


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.view(np.int64) for s in document_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "hashes"])


def _item_sets(items: DataFrame) -> DataFrame:
    return stored(small_batches(items).select(F.col("item_id").cast("long").alias("id"), "text").mapInArrow(_hashed, "id long, hashes array<long>"), "items")


def _too_many(sets: DataFrame, broadcast_shingles: int) -> bool:
    return sets.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0] > broadcast_shingles


def _sent_index(sets: DataFrame) -> Broadcast:
    rows = sets.collect()
    # Stored as signed, ordered as unsigned.
    index = ItemIndex([r["id"] for r in rows], [np.sort(np.array(r["hashes"], dtype=np.int64).view(np.uint64)) for r in rows])
    return sets.sparkSession.sparkContext.broadcast(index)


def _hits(index: ItemIndex, texts: pa.Array) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Places of texts, in order, and what is contained in them."""
    data, offsets = text_bytes(texts)
    places, found = [], []
    for first, last in chunks(offsets):
        at = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        starts, ends, bounds = word_spans(part, at)
        flat, begin = shingles(word_hashes(part, starts, ends), bounds)
        hits = np.flatnonzero(index.may_hit(flat))
        for k in np.unique(np.searchsorted(begin, hits, side="right") - 1):
            for item in index.contained(np.unique(flat[begin[k] : begin[k + 1]])):
                places.append(first + int(k))
                found.append(item)
    return places, found


def find_contained(docs: DataFrame, items: DataFrame, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """`doc_id, item_id, n_item_shingles, n_shared`, a row for each row of `docs(doc_id, text)` and item contained in it.

    A text of one to four words is one shingle, so such an item is found in documents with just these words. Null,
    empty and wordless texts, items or documents, are contained in nothing and hold nothing. A repeated item or document
    row is reported for each of its rows. Other columns are ignored.
    """
    sets = _item_sets(items)
    if _too_many(sets, broadcast_shingles):
        return _contained_by_join(docs, sets)
    sent = _sent_index(sets)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            places, found = _hits(index, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(places, pa.int64())),
                    pa.array([index.ids[k] for k, _, _ in found], pa.int64()),
                    pa.array([n for _, n, _ in found], pa.int64()),
                    pa.array([s for _, _, s in found], pa.int64()),
                ],
                names=["doc_id", "item_id", "n_item_shingles", "n_shared"],
            )

    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id long, item_id long, {_FOUND}")


def _contained_by_join(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same by joins: sketches meet on hash, then whole sets of the candidates do."""
    unsigned = F.transform("hashes", lambda h: h.bitwiseXOR(F.lit(-(1 << 63))))
    number = items.where(F.size("hashes") > 0).withColumn("hashes", F.sort_array(unsigned)).withColumn("n", F.size("hashes"))
    number = stored(number.withColumn("item", F.xxhash64("id", "hashes")), "items")
    kept = F.col("n") - F.ceil(F.col("n") * CONTAINMENT / F.lit(100)) + 1
    part = F.length(F.bin(F.col("n").cast("long")))
    sketch = number.select("item", part.alias("part"), F.explode(F.slice("hashes", 1, kept.cast("int"))).alias("h"))
    bounds = sketch.groupBy("part").agg(F.max("h").alias("bound")).collect()  # a row for each power of two
    sets = docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(_hashed, "id long, hashes array<long>")
    sets = sets.where(F.size("hashes") > 0).withColumn("doc", F.xxhash64("id", "hashes")).withColumn("hashes", unsigned)
    own = stored(sets.select("id", "doc", F.explode("hashes").alias("h")), "shingles")
    near = own.where(F.col("h") <= max((r["bound"] for r in bounds), default=None)).select("doc", "h").distinct()
    pairs = near.join(sketch.select("item", "h").distinct(), "h").select("doc", "item").distinct()
    whole = number.dropDuplicates(["item"]).select("item", F.explode("hashes").alias("h"))
    hits = pairs.join(own.select("doc", "h").distinct(), "doc").join(whole, ["item", "h"]).groupBy("doc", "item").agg(F.count("*").alias("n_shared"))
    found = hits.join(number.select("item", F.col("id").alias("item_id"), F.col("n").cast("long").alias("n_item_shingles")), "item").where(
        F.col("n_shared") * 100 >= F.col("n_item_shingles") * CONTAINMENT
    )
    rows = sets.select("doc", F.col("id").alias("doc_id"))
    return rows.join(found, "doc").select("doc_id", "item_id", "n_item_shingles", "n_shared")


def without_contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` in which no item is found; rows without doc_id stay only if nothing is found in such a row."""
    found = find_contained(docs, items).select("doc_id").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def clean_rows(docs: DataFrame, items: DataFrame, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """The rows of `docs` in whose own text no item is found, whatever their doc_id and the rows that share it.

    While the items travel to the tasks, a row is dropped where it is read. Beyond that texts are dropped by their hash,
    since what is found hangs on the text alone; a null text holds nothing.
    """
    sets = _item_sets(items)
    if _too_many(sets, broadcast_shingles):
        key = F.xxhash64("text")
        found = _contained_by_join(docs.select(key.alias("doc_id"), "text"), sets)
        gone = found.select("doc_id").distinct()
        return docs.join(gone, docs["text"].isNotNull() & (F.xxhash64(docs["text"]) == gone["doc_id"]), "left_anti")
    sent = _sent_index(sets)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.ones(batch.num_rows, dtype=bool)
            stays[_hits(sent.value, batch.column("text"))[0]] = False
            yield batch.filter(pa.array(stays))

    names = [n for n in docs.columns if n != "text"]
    rows = small_batches(docs).select(packed(names), "text")
    kept = rows.mapInArrow(clean, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return kept.select(*unpacked(names), "text").select(*[f"`{n}`" for n in docs.columns])
