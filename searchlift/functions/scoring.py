"""Scoring rules as column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from searchlift.functions.numbers import floor_div, from_units, round_to_long
from searchlift.schemas import BOTH, CONTENT, LANDED_CTR, LINK_BUILDING, NONE, POSITION, SCORE


@dataclass(frozen=True)
class Rules:
    """Fixed values of the scoring rules."""

    min_impressions: int = 200
    deep_impressions: int = 1000
    top_position: int = 5
    mid_position: int = 10
    jumps: dict[str, Decimal] = field(
        default_factory=lambda: {LINK_BUILDING: Decimal("5.5"), BOTH: Decimal("7.5")}
    )
    best_target: Decimal = Decimal("3.0")
    weights: dict[str, Decimal] = field(
        default_factory=lambda: {"top": Decimal("1.0"), "mid": Decimal("0.8"), "deep": Decimal("0.5")}
    )


RULES = Rules()


def position_band(position: Column, rules: Rules = RULES) -> Column:
    """top, mid or deep; a missing position is deep."""
    return (
        F.when(position <= rules.top_position, "top")
        .when(position <= rules.mid_position, "mid")
        .otherwise("deep")
    )


def ctr_gap(expected: Column, actual: Column) -> Column:
    return F.greatest(expected - actual, F.lit(Decimal(0))).cast(LANDED_CTR)


def classify_factor(
    impressions: Column, position: Column, actual: Column, expected: Column, rules: Rules = RULES
) -> Column:
    """The work a keyword needs: demand first, then its band, then whether its CTR falls short."""
    band = position_band(position, rules)
    short = F.coalesce(actual < expected, F.lit(False))
    deep_demand = F.coalesce(impressions > rules.deep_impressions, F.lit(False))
    by_band = (
        F.when(band == "top", F.when(short, CONTENT).otherwise(NONE))
        .when(band == "mid", F.when(short, BOTH).otherwise(LINK_BUILDING))
        .otherwise(F.when(deep_demand, LINK_BUILDING).otherwise(NONE))
    )
    return F.when(impressions < rules.min_impressions, NONE).otherwise(by_band)


def target_position(position: Column, factor: Column, rules: Rules = RULES) -> Column:
    """Where the work should take the keyword; null stays null."""
    target = position
    for name, jump in rules.jumps.items():
        moved = F.greatest(position - F.lit(jump), F.lit(rules.best_target))
        target = F.when((factor == name) & position.isNotNull(), moved).otherwise(target)
    return target.cast(POSITION)


def delta_clicks(impressions: Column, ctr_target_adjusted: Column, actual: Column) -> Column:
    """Extra clicks at the target CTR, never negative."""
    # The change in nine places and what lies behind them apart: no product or sum needs more than 38 digits.
    seen, change = impressions.cast(T.DecimalType(17, 0)), ctr_target_adjusted - actual
    near = F.round(change, 9).cast(T.DecimalType(13, 9))
    rest = (change - near).cast(T.DecimalType(12, 12))
    return F.greatest(round_to_long(seen * near + seen * rest), F.lit(0).cast("bigint"))


def revenue(clicks: Column, conversion_rate: Column, avg_ticket: Column) -> Column:
    """Whole-peso revenue of extra clicks."""
    # Whole and broken part of the rate apart, so that no product or sum needs more than 38 digits.
    worth = (clicks * avg_ticket).cast(T.DecimalType(19, 0))
    whole = F.floor(conversion_rate).cast(T.DecimalType(12, 0))
    broken = (conversion_rate - whole).cast(T.DecimalType(12, 12))
    return round_to_long((worth * whole).cast(T.DecimalType(19, 0)) + (worth * broken).cast(T.DecimalType(31, 12)))


def position_weight(position: Column, rules: Rules = RULES) -> Column:
    band = position_band(position, rules)
    weight = F.when(band == "top", F.lit(rules.weights["top"]))
    weight = weight.when(band == "mid", F.lit(rules.weights["mid"]))
    return weight.otherwise(F.lit(rules.weights["deep"])).cast(T.DecimalType(2, 1))


def raw_score(revenue_final: Column, success_prob: Column, position: Column, rules: Rules = RULES) -> Column:
    score = revenue_final.cast(T.DecimalType(19, 0)) * success_prob * position_weight(position, rules)
    return score.cast(T.DecimalType(29, 4))


def score_of_max(raw: Column, best: Column) -> Column:
    """raw as a share of the best, 0 to 100 at two decimals; unscaled without a positive best."""
    hundredths = floor_div(raw * 20000 + best, best * 2)
    return F.when(best > 0, from_units(hundredths, 2)).otherwise(raw).cast(SCORE)


def whatif_score(raw: Column, best: Column) -> Column:
    """raw as a share of the best, capped at 100; 0 without a positive best."""
    share = raw.cast("double") / best.cast("double") * 100
    return F.when(best > 0, F.least(share, F.lit(100.0))).otherwise(F.lit(0.0))


def target_improves(target: Column, baseline: Column) -> Column:
    return target < baseline - F.lit(Decimal("0.05"))
