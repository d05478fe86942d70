"""Exact order statistics by counting: no sort, and no list of values that grows with the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

#: Parts into which a range of values is cut in one round.
PARTS = 4096


@dataclass(frozen=True)
class _Range:
    """Values of a group from low to high, with the number of values below them."""

    group: int
    low: int
    high: int
    below: int


def extent(rows: DataFrame, group: str, value: str) -> dict[int, tuple[int, int, int]]:
    """Number of values, least and largest one of each group."""
    found = rows.groupBy(group).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    return {r[group]: (r["n"], r["low"], r["high"]) for r in found.collect() if r["n"]}


def order_statistics(
    rows: DataFrame, group: str, value: str, ranks: dict[int, set[int]], ends: dict[int, tuple[int, int, int]]
) -> dict[tuple[int, int], int]:
    """The values of given ranks (from 0) of each group, for whole numbers, keyed by (group, rank); ``ends`` is the extent.

    Each round cuts the ranges that still hold a wanted rank into PARTS and counts the values of each part, which
    combines before the shuffle; a range with one value left is settled. What reaches the driver is PARTS rows at most
    for each wanted rank, whatever the number of rows or of distinct values.
    """
    whole = {g: _Range(g, ends[g][1], ends[g][2], 0) for g in ranks}
    waiting = {(g, rank): whole[g] for g, wanted in ranks.items() for rank in wanted}
    settled = {}
    while waiting:
        settled |= {key: r.low for key, r in waiting.items() if r.low == r.high}
        waiting = {key: r for key, r in waiting.items() if key not in settled}
        if not waiting:
            break
        ranges = sorted(set(waiting.values()), key=lambda r: (r.group, r.low))
        steps = [max(1, -(-(r.high - r.low + 1) // PARTS)) for r in ranges]
        table = rows.sparkSession.createDataFrame(
            [(k, r.group, r.low, r.high, step) for k, (r, step) in enumerate(zip(ranges, steps))],
            "range_at int, range_group int, range_low long, range_high long, range_step long",
        )
        own = rows.select(F.col(group).alias("of"), F.col(value).alias("value"))
        within = (F.col("of") == F.col("range_group")) & F.col("value").between(F.col("range_low"), F.col("range_high"))
        part = F.call_function("div", F.col("value") - F.col("range_low"), F.col("range_step"))
        counts = own.join(F.broadcast(table), within).groupBy("range_at", part.alias("part"))
        found = counts.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        parts: dict[_Range, list[tuple[_Range, int]]] = {r: [] for r in ranges}
        for r in sorted(found.collect(), key=lambda r: (r["range_at"], r["part"])):
            of = ranges[r["range_at"]]
            below = parts[of][-1][1] if parts[of] else of.below
            parts[of].append((_Range(of.group, r["low"], r["high"], below), below + r["n"]))
        waiting = {(g, rank): next(part for part, up_to in parts[r] if rank < up_to) for (g, rank), r in waiting.items()}
    return settled
