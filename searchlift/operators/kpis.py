"""Summaries of the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from searchlift.operators.dimensions import snapshot
from searchlift.operators.filters import has_revenue
from searchlift.schemas import BOTH, CONTENT, LINK_BUILDING, NONE


def kpis(gaps: DataFrame) -> DataFrame:
    """Per date: rows, rows per factor, and total and actionable revenue."""
    factor = F.col("agency_factor")
    revenue = F.col("revenue_final")
    zero = F.lit(0).cast("bigint")
    return gaps.groupBy("date").agg(
        F.count("*").alias("total_keywords"),
        F.count_if(factor != NONE).alias("with_opportunity"),
        F.count_if(factor == BOTH).alias("factor_both"),
        F.count_if(factor == CONTENT).alias("factor_content"),
        F.count_if(factor == LINK_BUILDING).alias("factor_lb"),
        F.count_if(factor == NONE).alias("factor_none"),
        F.coalesce(F.sum(revenue), zero).alias("total_revenue"),
        F.coalesce(F.sum(F.when(factor != NONE, revenue)), zero).alias("active_revenue"),
    )


def kpis_of(gaps: DataFrame, date=None) -> DataFrame:
    """The KPIs of one date, the newest by default."""
    return kpis(snapshot(gaps, date))


def factor_distribution(gaps: DataFrame) -> DataFrame:
    """Rows per date and factor, most frequent first."""
    counted = gaps.groupBy("date", "agency_factor").agg(F.count("*").alias("n"))
    return counted.orderBy("date", F.desc("n"), "agency_factor")


def actionable_share(gaps: DataFrame) -> DataFrame:
    """Per date: how many of the rows call for work."""
    factor = F.col("agency_factor")
    return gaps.groupBy("date").agg(
        F.count_if(factor.isin(BOTH, CONTENT, LINK_BUILDING)).alias("active"),
        F.count_if(factor.isin(BOTH, CONTENT, LINK_BUILDING, NONE)).alias("total"),
    )


def top_opportunity(gaps: DataFrame) -> DataFrame:
    """The row with the largest revenue; ties go to the first query and page."""
    best = has_revenue(gaps).orderBy(F.desc("revenue_final"), "query", "page_url").limit(1)
    return best.select(
        "date", "query", "page_url", "revenue_final", "opportunity_score", "agency_factor", "avg_position"
    )
