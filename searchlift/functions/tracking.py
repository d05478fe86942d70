"""Expressions of the watch-list view and of the run calendar."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# A change below these is noise.
DELTA_NOISE = Decimal("0.5")
TREND_NOISE = Decimal("0.1")

# Fixed values, in days: how long facts take to settle, and the span of a backfill.
SETTLE_DAYS = 3
BACKFILL_FROM = 60
BACKFILL_TO = 4


def iso_week(date: Column) -> Column:
    """ISO year and week, such as ``2025-W01`` for 2024-12-31."""
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), date), F.weekofyear(date))


def position_delta(current: Column, baseline: Column) -> Column:
    return F.round(current - baseline, 2)


def delta_status(delta: Column) -> Column:
    """Lower is better: a drop of the position number is an improvement."""
    return (
        F.when(delta.isNull(), "nodata")
        .when(delta < -DELTA_NOISE, "improved")
        .when(delta > DELTA_NOISE, "worsened")
        .otherwise("stable")
    )


def trend(first: Column, last: Column, points: Column) -> Column:
    """up, down or flat over a series of at least two points."""
    noise = F.lit(TREND_NOISE)
    return F.when(
        points >= 2,
        F.when(last < first - noise, "up").when(last > first + noise, "down").otherwise("flat"),
    )


def consolidated_date(today: Column, lag: int = SETTLE_DAYS) -> Column:
    """The newest day whose facts have settled."""
    return F.date_sub(today, lag)


def backfill_dates(today: Column, back: int = BACKFILL_FROM, lag: int = BACKFILL_TO) -> Column:
    """Array of the days of a backfill, oldest first."""
    return F.sequence(F.date_sub(today, back), F.date_sub(today, lag))
