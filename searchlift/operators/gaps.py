"""The scoring steps, each a DataFrame to DataFrame function over any number of dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from searchlift.functions import scoring as S
from searchlift.operators.branding import flag_branded
from searchlift.operators.dimensions import with_ctr, with_params
from searchlift.schemas import FACTORS, LANDED_CTR, NONE, POSITION


def seed_rows(facts: DataFrame) -> DataFrame:
    """Facts under the column names of the gap table."""
    return facts.select(
        "date",
        "query",
        F.col("page").alias("page_url"),
        F.col("impressions").cast("bigint").alias("impressions"),
        F.col("position").cast(POSITION).alias("avg_position"),
        F.col("ctr").cast(LANDED_CTR).alias("ctr_actual"),
        F.lit(NONE).alias("agency_factor"),
    )


def diagnose(gaps: DataFrame, curve: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds the brand flag, the expected CTR at the current position and the gap to it."""
    flagged = with_ctr(flag_branded(gaps, terms), curve, "avg_position", "ctr_expected")
    branded = F.col("is_branded")
    gap = S.ctr_gap(F.col("ctr_expected"), F.col("ctr_actual"))
    return flagged.withColumns(
        {
            "ctr_gap": F.when(branded, F.lit(0).cast(LANDED_CTR)).otherwise(gap),
            "ctr_expected": F.when(~branded, F.col("ctr_expected")),
        }
    )


def classify(gaps: DataFrame) -> DataFrame:
    """Sets the factor; branded rows are not actionable."""
    factor = S.classify_factor(
        F.col("impressions"), F.col("avg_position"), F.col("ctr_actual"), F.col("ctr_expected")
    )
    return gaps.withColumn("agency_factor", F.when(F.col("is_branded"), NONE).otherwise(factor))


def project(gaps: DataFrame, curve: DataFrame, params: DataFrame) -> DataFrame:
    """Adds target position, its CTR and the extra clicks, where the factor has params."""
    known = with_params(gaps, params)
    applies = ~F.col("is_branded") & F.col("ctr_boost").isNotNull()
    target = S.target_position(F.col("avg_position"), F.col("agency_factor"))
    targeted = with_ctr(known.withColumn("pos_target", F.when(applies, target)), curve, "pos_target", "ctr_target")
    boosted = F.col("ctr_target") * F.col("ctr_boost")
    projected = targeted.withColumns(
        {
            "ctr_target": F.when(applies, F.col("ctr_target")),
            "ctr_target_adjusted": F.when(applies, boosted),
        }
    )
    clicks = S.delta_clicks(F.col("impressions"), F.col("ctr_target_adjusted"), F.col("ctr_actual"))
    idle = F.col("is_branded") | (F.col("agency_factor") == NONE)
    return projected.withColumn(
        "delta_clicks", F.when(idle, F.lit(0).cast("bigint")).when(applies, clicks)
    )


def price(gaps: DataFrame) -> DataFrame:
    """Adds revenue: null for branded rows and rows without rates, 0 where there is nothing to do."""
    earned = S.revenue(F.col("delta_clicks"), F.col("conversion_rate"), F.col("avg_ticket"))
    revenue = F.when(F.col("agency_factor") == NONE, F.lit(0).cast("bigint")).otherwise(earned)
    return gaps.withColumn("revenue_final", F.when(~F.col("is_branded"), revenue))


def grade(gaps: DataFrame) -> DataFrame:
    """Adds the raw score; null where revenue or params are missing."""
    raw = S.raw_score(F.col("revenue_final"), F.col("success_prob"), F.col("avg_position"))
    return gaps.withColumn("raw_score", raw)


def daily_max_score(gaps: DataFrame) -> DataFrame:
    """Largest positive raw score per date; null for a date without one."""
    best = F.max(F.when(F.col("raw_score") > 0, F.col("raw_score")))
    return gaps.groupBy("date").agg(best.alias("max_raw_score"))


def normalise(gaps: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """Adds the 0 to 100 score: raw over the largest of the date, worked out here unless ``best`` has it.

    A window over the date would put a whole day into one task. The largest score is a partial
    aggregate instead, and its broadcast holds one row per calendar day, so it cannot grow with rows.
    """
    best = daily_max_score(gaps) if best is None else best
    scored = gaps.join(F.broadcast(best), "date", "left")
    score = S.score_of_max(F.col("raw_score"), F.col("max_raw_score"))
    return scored.withColumn("opportunity_score", score).drop("max_raw_score")


def daily_summary(gaps: DataFrame) -> DataFrame:
    """Largest positive raw score per date and the rows touched by each scoring step, from one pass over raw scores."""
    plain = ~F.col("is_branded")
    scored = F.count_if(F.col("raw_score").isNotNull())
    return gaps.groupBy("date").agg(
        F.max(F.when(F.col("raw_score") > 0, F.col("raw_score"))).alias("max_raw_score"),
        F.count_if(F.col("is_branded")).alias("branded"),
        F.count_if(plain).alias("diagnosed"),
        F.count_if(plain & F.col("agency_factor").isin(*FACTORS)).alias("classified"),
        F.count_if(F.col("ctr_target").isNotNull()).alias("projected"),
        scored.alias("scored"),
        F.when(F.max("raw_score") > 0, scored).otherwise(F.lit(0)).alias("normalised"),
    )


def scoring_report(gaps: DataFrame) -> DataFrame:
    """Rows touched by each scoring step, per date; nothing is normalised without a positive score."""
    return daily_summary(gaps).drop("max_raw_score")
