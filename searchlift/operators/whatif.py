"""What every kind of work would bring for every keyword."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from searchlift.functions import scoring as S
from searchlift.operators.dimensions import snapshot, with_ctr, with_params
from searchlift.operators.filters import has_revenue
from searchlift.schemas import FACTORS, LANDED_CTR, NONE, RATE, WATCH_POSITION


def max_raw_scores(gaps: DataFrame, params: DataFrame, factors: tuple[str, ...] = FACTORS) -> DataFrame:
    """The largest raw score of each date; dates without a positive revenue are absent."""
    rows = with_params(has_revenue(gaps, positive=True).select(
        "date", "agency_factor", "revenue_final", "avg_position"
    ), params, "inner", factors)
    raw = S.raw_score(F.col("revenue_final"), F.col("success_prob"), F.col("avg_position"))
    return rows.groupBy("date").agg(F.max(raw).alias("max_raw_score"))


def max_raw_score(gaps: DataFrame, params: DataFrame, factors: tuple[str, ...] = FACTORS) -> DataFrame:
    """One row: the largest raw score of the newest date, null without a positive revenue."""
    return max_raw_scores(snapshot(gaps), params, factors).agg(F.max("max_raw_score").alias("max_raw_score"))


def factor_cross(gaps: DataFrame, factors: tuple[str, ...] = FACTORS) -> DataFrame:
    """Every row once per factor, in place of its own factor; no join is needed for a fixed list."""
    each = F.explode(F.array(*[F.lit(f) for f in factors]))
    return gaps.drop("agency_factor").withColumn("agency_factor", each)


def what_if(
    gaps: DataFrame,
    params: DataFrame,
    curve: DataFrame,
    max_raw: DataFrame,
    ctr_source: str = "display",
    factors: tuple[str, ...] = FACTORS,
) -> DataFrame:
    """Target, clicks, revenue and score of every row under every factor.

    ``max_raw`` holds the best raw score: one row for all rows, or with a ``date`` column one row for each date
    (a calendar day each, so it is broadcast). ``factors`` may name factors beyond the four, with params of their own.
    ``ctr_source='display'`` starts from the CTR as the list shows it (percent at two decimals),
    ``'exact'`` from the stored one. A factor without params gains nothing.
    """
    percent = F.round(F.col("ctr_actual") * 100, 2) if ctr_source == "display" else F.col("ctr_actual") * 100
    base = gaps.select(
        "date",
        "query",
        "page_url",
        "impressions",
        "avg_position",
        (percent * F.lit(Decimal("0.01"))).cast(LANDED_CTR).alias("ctr_actual"),
        F.coalesce("conversion_rate", F.lit(0)).cast(RATE).alias("conversion_rate"),
        F.coalesce("avg_ticket", F.lit(0)).cast("bigint").alias("avg_ticket"),
    )
    crossed = with_params(factor_cross(base, factors), params, factors=factors)
    # A factor without params neither boosts nor succeeds.
    known = crossed.withColumns(
        {
            "ctr_boost": F.coalesce("ctr_boost", F.lit(Decimal("1.000"))).cast("decimal(6,3)"),
            "success_prob": F.coalesce("success_prob", F.lit(Decimal("0.000"))).cast("decimal(6,3)"),
            "pos_target": S.target_position(F.col("avg_position"), F.col("agency_factor")),
        }
    )
    targeted = with_ctr(known, curve, "pos_target", "ctr_target")
    clicks = S.delta_clicks(
        F.col("impressions"), F.col("ctr_target") * F.col("ctr_boost"), F.col("ctr_actual")
    )
    idle = F.col("agency_factor") == NONE
    zero = F.lit(0).cast("bigint")
    earned = targeted.withColumn("delta_clicks", F.when(idle, zero).otherwise(clicks)).withColumn(
        "revenue",
        S.revenue(F.col("delta_clicks"), F.col("conversion_rate"), F.col("avg_ticket")),
    )
    raw = S.raw_score(F.col("revenue"), F.col("success_prob"), F.col("avg_position"))
    if "date" in max_raw.columns:
        daily = max_raw.groupBy("date").agg(F.max("max_raw_score").alias("best"))
        earned, best = earned.join(F.broadcast(daily), "date", "left"), F.col("best")
    else:
        best = max_raw.select("max_raw_score").scalar()
    return earned.withColumn("score", F.when(idle, F.lit(0.0)).otherwise(S.whatif_score(raw, best))).select(
        "date", "query", "page_url", "agency_factor", "avg_position",
        "pos_target", "delta_clicks", "revenue", "score",
    )


def to_watch(whatif: DataFrame, as_of) -> DataFrame:
    """Watch-list records of projected rows; doing nothing cannot be watched."""
    return whatif.where(F.col("agency_factor") != NONE).select(
        "query",
        "page_url",
        F.col("agency_factor").alias("agency_factor_aplicado"),
        F.col("avg_position").cast(WATCH_POSITION).alias("baseline_position"),
        F.col("pos_target").cast(WATCH_POSITION).alias("target_position"),
        F.to_date(F.lit(as_of)).alias("baseline_date"),
    )
