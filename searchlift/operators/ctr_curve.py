"""Fitting the CTR curve from facts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from searchlift.functions.numbers import to_units
from searchlift.operators.dimensions import curve_slot
from searchlift.operators.order_statistics import extent, order_statistics
from searchlift.schemas import CTR, LANDED_CTR

QUARTILES = ("ctr_low", "ctr_mid", "ctr_high")


def _quartile(values: dict[int, int], n: int, quarter: int) -> Decimal:
    """The interpolated quartile at six places, half up; values are counts of 10^-12."""
    at, rest = divmod((n - 1) * quarter, 4)
    four_times = 4 * values[at] + (rest * (values[at + 1] - values[at]) if rest else 0)
    return Decimal((four_times + 2 * 10**6) // (4 * 10**6)).scaleb(-6)


def calibrate_curve(facts: DataFrame, stage: str | None = None) -> DataFrame:
    """Quartiles of the CTR per whole position 1 to 20, interpolated, at six decimals.

    CTRs count with all places they are landed with. Each quartile lies between two order statistics, which are found
    by counting, which reads positions and CTRs a few times; ``stage`` keeps these two columns for that, where the facts
    are not a stored table. The result is a table of at most 20 rows.
    """
    units = to_units(F.col("ctr").cast(LANDED_CTR), 12)
    rows = facts.select(curve_slot(F.col("position")).alias("position"), units.alias("units")).where("position IS NOT NULL AND units IS NOT NULL")
    if stage:
        rows.write.mode("overwrite").parquet(stage)
        rows = facts.sparkSession.read.schema(rows.schema).parquet(stage)
    ends = extent(rows, "position", "units")
    sizes = {position: n for position, (n, _, _) in ends.items()}
    ranks = {p: {at for q in (1, 2, 3) for at in ((n - 1) * q // 4, -(-(n - 1) * q // 4))} for p, n in sizes.items()}
    found = order_statistics(rows, "position", "units", ranks, ends)
    own = {p: {rank: found[p, rank] for rank in wanted} for p, wanted in ranks.items()}
    fitted = [(p, *[_quartile(own[p], n, q) for q in (1, 2, 3)], n) for p, n in sorted(sizes.items())]
    kind = CTR.simpleString()
    return facts.sparkSession.createDataFrame(fitted, "position int, " + ", ".join(f"{name} {kind}" for name in QUARTILES) + ", n long")
