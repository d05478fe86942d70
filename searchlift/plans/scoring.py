"""The scoring job: facts in, ranked opportunities out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T

from searchlift.functions.tracking import BACKFILL_FROM, BACKFILL_TO, backfill_dates
from searchlift.operators import bi, gaps
from searchlift.operators.filters import ingest_filter
from searchlift.schemas import GAPS, RAW_GAPS
from searchlift.sources.store import on_days, write_days


@dataclass(frozen=True)
class Dimensions:
    """The small tables of a scoring run.

    Rates come either from the business rows (``business``, as left by ``clean_bi``), worked out from each
    row's URL without a shuffle, or from a stored ``catalog``, joined by page URL.
    """

    curve: DataFrame
    params: DataFrame
    terms: DataFrame
    business: DataFrame | None = None
    catalog: DataFrame | None = None

    def with_rates(self, rows: DataFrame) -> DataFrame:
        if self.catalog is not None:
            return bi.with_rates(rows, self.catalog)
        return bi.with_cascade_rates(rows, self.business)


def score_raw(facts: DataFrame, dims: Dimensions) -> DataFrame:
    """Everything up to the raw score: row by row, with lookups only."""
    diagnosed = gaps.diagnose(gaps.seed_rows(facts), dims.curve, dims.terms)
    projected = gaps.project(gaps.classify(diagnosed), dims.curve, dims.params)
    return gaps.grade(gaps.price(dims.with_rates(projected)))


def _columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def finish(raw: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """Ranks raw scores within their date."""
    return _columns(gaps.normalise(raw, best), GAPS)


def stage_raw(raw: DataFrame, stage: str, gather: bool = False) -> DataFrame:
    """Raw scores written by date and read back.

    Facts read from a table laid out by day are written where they are read, without an exchange. ``gather`` is for
    facts in another layout, where every task would otherwise write a file for every day.

    The largest score of a date is needed before any row can be finished. From the stage it is a scan of
    one column; within a single plan everything before it would run twice.
    """
    write_days(_columns(raw, RAW_GAPS), stage, gather)
    return raw.sparkSession.read.schema(RAW_GAPS).parquet(stage)


def score(facts: DataFrame, dims: Dimensions, stage: str | None = None, gather: bool = False) -> DataFrame:
    """Scored gap rows of every date in the facts; each date is ranked on its own.

    Without a ``stage`` folder the result is one lazy plan, which reads the facts twice. That is the
    better choice when the facts are a stored table and the lookups are all broadcast.
    """
    raw = score_raw(facts, dims)
    return finish(stage_raw(raw, stage, gather) if stage else raw)


def score_day(
    facts: DataFrame, dims: Dimensions, date=None, brands: bool = True, stage: str | None = None, gather: bool = False
) -> DataFrame:
    """Filters and scores the landed facts of one date, or of all of them."""
    rows = facts if date is None else facts.where(F.col("date") == F.to_date(F.lit(date)))
    return score(ingest_filter(rows, brands), dims, stage, gather)


def backfill_calendar(spark: SparkSession, today, back: int = BACKFILL_FROM, lag: int = BACKFILL_TO) -> DataFrame:
    """One row per day of a backfill."""
    days = backfill_dates(F.to_date(F.lit(today)), back, lag)
    return spark.range(1).select(F.explode(days).alias("date"))


def score_backfill(
    facts: DataFrame,
    dims: Dimensions,
    today,
    back: int = BACKFILL_FROM,
    lag: int = BACKFILL_TO,
    stage: str | None = None,
    gather: bool = False,
) -> DataFrame:
    """Scores every day of the backfill span in one job: the span is a filter, not a loop."""
    day = F.to_date(F.lit(today))
    span = facts.where(F.col("date").between(F.date_sub(day, back), F.date_sub(day, lag)))
    return score_day(span, dims, stage=stage, gather=gather)


def score_staged(facts: DataFrame, dims: Dimensions, stage: str) -> tuple[DataFrame, list[Row]]:
    """Scored rows and, for each date, the rows touched by each step.

    Both come from one pass over the staged raw scores: the one that finds each date's largest.
    """
    raw = stage_raw(score_raw(facts, dims), stage)
    report = gaps.daily_summary(raw).collect()  # a row for each date
    best = raw.sparkSession.createDataFrame([(r["date"], r["max_raw_score"]) for r in report], f"date date, max_raw_score {RAW_GAPS['raw_score'].dataType.simpleString()}")
    return finish(raw, best), report


def score_to_table(facts: DataFrame, dims: Dimensions, path: str, stage: str, days: list) -> None:
    """Scores days into the gap table, replacing exactly those days."""
    raw = stage_raw(score_raw(facts, dims), stage)
    write_days(finish(on_days(raw, days)), path, gather=False)
