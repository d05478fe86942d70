"""The watch-list: position history of watched (query, page) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from searchlift.functions.numbers import from_units, half_up_div, mean_half_up, to_units
from searchlift.functions.tracking import delta_status, iso_week, position_delta, trend
from searchlift.operators.filters import trailing
from searchlift.schemas import POSITION, POSITION_PLACES

PAIR = ["query", "page"]


def watched_facts(facts: DataFrame, watch: DataFrame) -> DataFrame:
    """Facts of watched pairs."""
    pairs = watch.select("query", F.col("page_url").alias("page"))
    return facts.join(pairs, PAIR, "left_semi")


def _week(date):
    return F.date_trunc("week", date).cast("date")


def weekly_position(facts: DataFrame) -> DataFrame:
    """Mean position per pair and ISO week, two decimals, every day counting the same."""
    mean = mean_half_up(F.col("position").cast(POSITION), POSITION_PLACES, 2).cast(POSITION)
    weekly = facts.groupBy(*PAIR, _week(F.col("date")).alias("week_start"))
    return weekly.agg(mean.alias("avg_position"))


def current_position(facts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Mean position per pair over the trailing days."""
    mean = mean_half_up(F.col("position").cast(POSITION), POSITION_PLACES, 2).cast(POSITION)
    return trailing(facts, as_of, days).groupBy(*PAIR).agg(mean.alias("current_position"))


def _series():
    # One entry per ISO week, so the list is as long as the calendar, whatever the number of facts.
    points = F.sort_array(F.collect_list(F.struct("week_start", "avg_position")))
    return F.transform(
        points,
        lambda p: F.struct(iso_week(p["week_start"]).alias("week"), p["avg_position"].alias("avg_position")),
    )


def weekly_series(weekly: DataFrame) -> DataFrame:
    """Per pair: array of (week, avg_position) in week order."""
    return weekly.groupBy(*PAIR).agg(_series().alias("weekly_series"))


def series_trend(weekly: DataFrame) -> DataFrame:
    """Per pair: first, last, lowest and highest weekly mean, and where it is heading."""
    position = F.col("avg_position")
    points = weekly.groupBy(*PAIR).agg(
        F.min_by(position, "week_start").alias("first_position"),
        F.max_by(position, "week_start").alias("last_position"),
        F.min(position).alias("min_position"),
        F.max(position).alias("max_position"),
        F.count("*").alias("points"),
    )
    return points.withColumn(
        "trend", trend(F.col("first_position"), F.col("last_position"), F.col("points"))
    )


def position_history(facts: DataFrame, watch: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Per watched pair: weekly series, trend and trailing mean, in one pass over the facts."""
    recent = F.col("date") >= F.date_sub(F.to_date(F.lit(as_of)), days)
    units = to_units(F.col("position").cast(POSITION), POSITION_PLACES)
    weekly = (
        watched_facts(facts, watch)
        .groupBy(*PAIR, _week(F.col("date")).alias("week_start"))
        .agg(
            mean_half_up(F.col("position").cast(POSITION), POSITION_PLACES, 2).cast(POSITION).alias("avg_position"),
            F.sum(F.when(recent, units)).alias("recent_units"),
            F.count(F.when(recent, units)).alias("recent_n"),
        )
    )
    position = F.col("avg_position")
    n = F.sum("recent_n")
    shrunk = n * F.lit(10 ** (POSITION_PLACES - 2)).cast("bigint")
    mean = F.when(n > 0, from_units(half_up_div(F.sum("recent_units"), shrunk), 2)).cast(POSITION)
    return weekly.groupBy(*PAIR).agg(
        _series().alias("weekly_series"),
        trend(
            F.min_by(position, "week_start"), F.max_by(position, "week_start"), F.count("*")
        ).alias("trend"),
        mean.alias("current_position"),
    )


#: Mergeable sums of positions per pair and week; the date is the week's first day.
WEEKS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("units", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)


def weekly_sums(facts: DataFrame) -> DataFrame:
    """Sums and counts of positions per pair and ISO week, from which means follow without the facts."""
    units = to_units(F.col("position").cast(POSITION), POSITION_PLACES)
    weekly = facts.groupBy(*PAIR, _week(F.col("date")).alias("date"))
    sums = weekly.agg(F.coalesce(F.sum(units), F.lit(0)).alias("units"), F.count(units).alias("n"))
    return sums.select(*WEEKS.fieldNames())


def merged_sums(*parts: DataFrame) -> DataFrame:
    """One table of sums from several, for instance of parts of a week."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy(*PAIR, "date").agg(F.sum("units").alias("units"), F.sum("n").alias("n"))
    return merged.select(*WEEKS.fieldNames())


def weekly_position_of(sums: DataFrame) -> DataFrame:
    """``weekly_position`` from a table of sums."""
    shrunk = F.col("n") * F.lit(10 ** (POSITION_PLACES - 2)).cast("bigint")
    mean = F.when(F.col("n") > 0, from_units(half_up_div(F.col("units"), shrunk), 2)).cast(POSITION)
    return sums.select(*PAIR, F.col("date").alias("week_start"), mean.alias("avg_position"))


def position_history_of(sums: DataFrame, facts: DataFrame, watch: DataFrame, as_of, days: int = 7) -> DataFrame:
    """``position_history`` with the weeks from a table of sums; of the facts only the trailing days are read."""
    position = F.col("avg_position")
    weekly = weekly_position_of(watched_facts(sums, watch)).groupBy(*PAIR).agg(
        _series().alias("weekly_series"),
        trend(F.min_by(position, "week_start"), F.max_by(position, "week_start"), F.count("*")).alias("trend"),
    )
    return weekly.join(current_position(watched_facts(facts, watch), as_of, days), PAIR, "left")


POINT = T.ArrayType(
    T.StructType([T.StructField("week", T.StringType()), T.StructField("avg_position", POSITION)])
)


def watch_report(watch: DataFrame, facts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The watch-list with current position, change, status and weekly series, newest first."""
    return _report(watch, position_history(facts, watch, as_of, days))


def watch_report_of(watch: DataFrame, sums: DataFrame, facts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """``watch_report`` from a table of weekly sums and the facts of the trailing days."""
    return _report(watch, position_history_of(sums, facts, watch, as_of, days))


def _report(watch: DataFrame, history: DataFrame) -> DataFrame:
    history = history.withColumnRenamed("page", "page_url")
    joined = watch.join(history, ["query", "page_url"], "left")
    delta = position_delta(F.col("current_position"), F.col("baseline_position"))
    return joined.select(
        *watch.columns,
        "current_position",
        delta.alias("delta"),
        delta_status(delta).alias("status"),
        F.coalesce("weekly_series", F.array().cast(POINT)).alias("weekly_series"),
        "trend",
    ).orderBy(F.desc("created_at"), "query", "page_url")
