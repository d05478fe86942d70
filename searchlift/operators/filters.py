"""Row filters of the landing step and of the read side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from searchlift.functions.text import is_branded_regex
from searchlift.schemas import FACTORS, HOST_MARKER, LAST_POSITION

# Page fragments that mark pages without a category listing.
EXCLUDED_FRAGMENTS = ("/listas/", "/search", ".html")


def in_section(df: DataFrame, fragment: str, page: str = "page") -> DataFrame:
    """Rows whose page contains a path fragment; the predicate reaches the file scan."""
    return df.where(F.contains(F.col(page), F.lit(fragment)))


def on_site(df: DataFrame, url: str, marker: str = HOST_MARKER) -> DataFrame:
    return df.where(F.contains(F.col(url), F.lit(marker)))


def _has_fragment(page: Column, fragments: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for fragment in fragments:
        hit = hit | F.contains(page, F.lit(fragment))
    return hit


def _malformed() -> Column:
    """A row without a query or a page is no keyword."""
    return F.col("query").isNull() | F.col("page").isNull()


def _too_deep(position: Column, last: int) -> Column:
    return F.coalesce(position > last, F.lit(False))


def exclude_pages(df: DataFrame, fragments: tuple[str, ...] = EXCLUDED_FRAGMENTS) -> DataFrame:
    return df.where(~_has_fragment(F.col("page"), fragments))


def within_rank(df: DataFrame, last: int = LAST_POSITION) -> DataFrame:
    """Drops rows ranked below ``last``; rows without a position stay."""
    return df.where(~_too_deep(F.col("position"), last))


def drop_branded(df: DataFrame) -> DataFrame:
    return df.where(~is_branded_regex(F.col("query")))


def ingest_filter(df: DataFrame, brands: bool = True) -> DataFrame:
    """The landing filters together: the rows ``with_ingest_reason`` calls kept."""
    kept = within_rank(exclude_pages(df.where(~_malformed())))
    return drop_branded(kept) if brands else kept


def with_ingest_reason(df: DataFrame, brands: bool = True) -> DataFrame:
    """Adds why a landed row is left out, or ``kept``."""
    reason = F.when(_malformed(), "malformed").when(_has_fragment(F.col("page"), EXCLUDED_FRAGMENTS), "page")
    reason = reason.when(_too_deep(F.col("position"), LAST_POSITION), "position")
    if brands:
        reason = reason.when(is_branded_regex(F.col("query")), "branded")
    return df.withColumn("reason", reason.otherwise("kept"))


def ingest_report(df: DataFrame, brands: bool = True) -> DataFrame:
    """Rows per date and reason."""
    return with_ingest_reason(df, brands).groupBy("date", "reason").agg(F.count("*").alias("n"))


def active(df: DataFrame) -> DataFrame:
    """Rows with clicks to win."""
    return df.where(F.col("delta_clicks") > 0)


def has_revenue(df: DataFrame, positive: bool = False) -> DataFrame:
    revenue = F.col("revenue_final")
    return df.where(revenue > 0 if positive else revenue.isNotNull())


def trailing(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` and of any later day."""
    return df.where(F.col("date") >= F.date_sub(F.to_date(F.lit(as_of)), days))


def validate_watch(df: DataFrame) -> DataFrame:
    """Adds why a watch-list record is refused; null for a good one."""
    required = (
        "query", "page_url", "agency_factor_aplicado",
        "baseline_position", "target_position", "baseline_date",
    )
    missing = F.lit(False)
    for name in required:
        kind = df.schema[name].dataType.typeName()
        absent = F.col(name).isNull()
        if kind == "string":
            absent = absent | (F.col(name) == "")
        elif kind != "date":
            absent = absent | (F.col(name) == 0)
        missing = missing | absent
    known = F.col("agency_factor_aplicado").isin(*FACTORS)
    reason = F.when(missing, "missing_field").when(~known, "unknown_factor")
    return df.withColumn("rejected_reason", reason)
