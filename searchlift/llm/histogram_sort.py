"""Sharding by histogram sort: shards of near equal bytes in the order of a key, found by counting, dealt once.

The key is (64-bit hash of the text, doc_id), so equal texts lie side by side and only a boundary can part them. Rows
equal in both are one unit; where a unit is larger than a boundary may miss its place, rows are written once with a number
behind their doc_id, and boundaries may part units too.
Splitters are wanted where the bytes below reach multiples of the total. Each round lays candidate boundaries over the
key ranges that still hold an unsettled splitter and counts the exact bytes and rows of every range between two
candidates; counts combine in the tasks before they are exchanged. A splitter is settled once a candidate lies within
TOLERANCE of a shard of its place, or its range holds a single key. A text that fills whole shards is a range of one
hash; there the rounds go on over doc_id. Then all rows learn their bucket from the settled splitters (a join with at
most 4096 rows, one for each prefix of the hash, that hold the splitters of that prefix) and are exchanged once.

A shard is cut into several buckets in the same way, so that a shard is no limit to the number of tasks. The counts
below each splitter give the first slot of every bucket; slots within it come from the order in the task.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlift.llm.tables import packed, stored, unpacked

#: Share of a bucket's wanted bytes by which a boundary may miss its place.
TOLERANCE = 1e-3
#: Bytes of text that a bucket holds, about.
BUCKET_BYTES = 128 << 20
#: Candidate boundaries that a round lays over one range: 2^12.
ROUND_BITS = 12
_LEAST = -(1 << 63)
#: A doc_id and a row's number make one number of this type: the number takes the lowest places.
_PLACES = 1 << 62
_KEY = "decimal(38,0)"


@dataclass
class _Range:
    """Keys with `hash >> shift == prefix` (shift None: one hash, doc_id in [low, high]) and what lies below them."""

    shift: int | None
    prefix: int
    bytes_below: int
    rows_below: int
    low: int = 0
    high: int = 0


def _histogram(keys: DataFrame, ranges: list[_Range]) -> dict[int, list]:
    """For each range, its non-empty parts in key order: (first key of the part, part's range, bytes, rows)."""
    out: dict[int, list] = {id(r): [] for r in ranges}
    for shift in {r.shift for r in ranges if r.shift is not None}:
        at = {r.prefix: r for r in ranges if r.shift == shift}
        finer = max(0, shift - ROUND_BITS)
        rows = keys if shift == 64 else keys.where(F.shiftright("h", shift).isin([*at]))
        parts = rows.groupBy(F.shiftright("h", finer).alias("p")).agg(*_sums(), F.min("h").alias("h0"), F.max("h").alias("h1"), F.min("d").alias("d0"), F.max("d").alias("d1"))
        for p in sorted(parts.collect(), key=lambda p: p["p"]):  # at most 2^ROUND_BITS rows for each range
            of = at[p["h0"] >> shift if shift < 64 else 0]
            single = p["h0"] == p["h1"]
            part = _Range(None, p["h0"], 0, 0, int(p["d0"]), int(p["d1"])) if single else _Range(finer, p["p"], 0, 0)
            first = (p["h0"], int(p["d0"])) if single else (p["p"] << finer, _LEAST * _PLACES)
            out[id(of)].append((first, part, p["bytes"], p["n"]))
    for r in ranges:
        if r.shift is None:
            width = max(1, -(-(r.high - r.low + 1) // (1 << ROUND_BITS)))
            rows = keys.where((F.col("h") == r.prefix) & F.col("d").between(_number(r.low), _number(r.high)))
            offset = F.col("d") - _number(r.low)
            parts = rows.groupBy(F.floor(offset / _number(width)).alias("p")).agg(*_sums(), F.min("d").alias("d0"), F.max("d").alias("d1"))
            for p in sorted(parts.collect(), key=lambda p: p["d0"]):
                out[id(r)].append(((r.prefix, int(p["d0"])), _Range(None, r.prefix, 0, 0, int(p["d0"]), int(p["d1"])), p["bytes"], p["n"]))
    return out


def _number(value: int) -> Column:
    return F.lit(Decimal(value)).cast(_KEY)


def _sums() -> tuple[Column, Column]:
    return F.sum("size").alias("bytes"), F.count("*").alias("n")


def splitters(keys: DataFrame, buckets: int) -> list[tuple[int, int, int]]:
    """First key (hash, doc_id) of each bucket but the first, with the rows below it, from `keys(h, d, size)`."""
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not total:
        return []
    slack = TOLERANCE * total / buckets
    whole = _Range(64, 0, 0, 0)
    waiting = {j: whole for j in range(1, buckets)}
    settled: dict[int, tuple[int, int, int]] = {}
    while waiting:
        ranges = list({id(r): r for r in waiting.values()}.values())
        parts = _histogram(keys, ranges)
        for r in ranges:
            below, count = r.bytes_below, r.rows_below
            edges = []
            for first, part, size, n in parts[id(r)]:
                part.bytes_below, part.rows_below = below, count
                edges.append((below, count, first, part, below + size, count + n, size, n))
                below, count = below + size, count + n
            overs = [e[4] for e in edges]
            for j in [j for j, of in waiting.items() if of is r]:
                want = total * j / buckets
                k = min(bisect_right(overs, want), len(edges) - 1)
                under, n_under, first, part, over, n_over, _, _ = edges[k]
                lone = part.shift is None and part.low == part.high
                if want - under <= slack or (lone and want - under <= over - want):
                    settled[j] = (*first, n_under)
                elif over - want <= slack or lone:
                    settled[j] = (*_next_key(edges, k), n_over)
                else:
                    waiting[j] = part
                    continue
                del waiting[j]
    return [settled[j] for j in sorted(settled)]


def _next_key(edges: list, k: int) -> tuple[int, int]:
    """The least key after part k: the first one of the next part, or the one after the part's last key."""
    if k + 1 < len(edges):
        return edges[k + 1][2]
    part = edges[k][3]
    if part.shift is None:
        return (part.prefix, part.high + 1)
    return ((part.prefix + 1) << part.shift, _LEAST * _PLACES)


def _largest_unit(keys: DataFrame) -> int:
    """Bytes of the largest unit of several rows."""
    units = keys.groupBy("h", "d").agg(*_sums()).where("n > 1")
    return units.agg(F.coalesce(F.max("bytes"), F.lit(0))).first()[0]


def shard_by_bytes(docs: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` with `size`, `shard` and `slot`; shards hold near equal bytes.

    size is the text's UTF-8 bytes (none for null) plus 1. Slots count from 0 in each shard, in the order of the key. A
    null key sorts first; rows equal in text and key follow in the order they are read in. Columns of `docs` called size,
    shard or slot are replaced, others may bear any name. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    names = [n for n in docs.columns if n not in ("size", "shard", "slot")]
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(_LEAST)).cast(_KEY) * _number(_PLACES)
    rows = docs.select(packed(names), F.xxhash64(body).alias("h"), id_.cast(_KEY).alias("d"), (F.octet_length(body) + 1).cast("long").alias("size"))
    keys = stored(rows.select("h", "d", "size"), "keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-total // (shards * BUCKET_BYTES)), tasks // shards)
    if _largest_unit(keys) > TOLERANCE * total / (shards * each):
        rows = stored(rows.withColumn("d", (F.col("d") + F.monotonically_increasing_id()).cast(_KEY)), "rows")
        keys = rows.select("h", "d", "size")
    found = splitters(keys, shards * each)

    # Splitters by the hash's first bits, each with the count of those before: a lookup of at most 2^12 rows.
    top = 64 - ROUND_BITS
    inside: dict[int, list] = {}
    for h, d, _ in found:
        inside.setdefault(h >> top if h < 1 << 63 else 1 << ROUND_BITS, []).append((h, Decimal(d)))
    table, before = [], 0
    for prefix in range(_LEAST >> top, 1 << (ROUND_BITS - 1)):
        own = inside.get(prefix, [])
        table.append((prefix, before, own))
        before += len(own)
    spark = docs.sparkSession
    lookup = spark.createDataFrame(table, f"p long, before int, own array<struct<h:long,d:{_KEY}>>")
    passed = F.filter("own", lambda s: (s["h"] < F.col("h")) | ((s["h"] == F.col("h")) & (s["d"] <= F.col("d"))))
    placed = rows.withColumn("p", F.shiftright("h", top)).join(F.broadcast(lookup), "p").withColumn("bucket", F.col("before") + F.size(passed))

    below = [0, *[n for _, _, n in found]] + [0] * (shards * each - 1 - len(found))
    first = [(b, below[b] - below[b // each * each]) for b in range(shards * each)]
    starts = spark.createDataFrame(first, "bucket int, first long")  # a row for each bucket, as the splitters
    order = Window.partitionBy("bucket").orderBy("h", "d")
    dealt = placed.repartitionById(shards * each, F.col("bucket")).withColumn("at", F.row_number().over(order) - 1).join(F.broadcast(starts), "bucket")
    return dealt.select(*unpacked(names), "size", F.floor(F.col("bucket") / each).cast("int").alias("shard"), (F.col("first") + F.col("at")).alias("slot"))
