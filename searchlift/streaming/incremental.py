"""Newly landed days: filter, upsert, score again. A stream over files replaces the daily run."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from searchlift.operators.filters import with_ingest_reason
from searchlift.operators.watchlist import WEEKS, weekly_sums
from searchlift.plans.scoring import Dimensions, score_staged
from searchlift.schemas import FACT_KEYS, FACTS, GAPS
from searchlift.session import scratch_folder
from searchlift.sources.readers import numbered, stream_search_facts
from searchlift.sources.store import put, read_table, write_days
from searchlift.streaming import ledger

#: Reasons under which landed rows are counted.
REASONS = ("kept", "malformed", "page", "position", "branded")


@dataclass(frozen=True)
class Tables:
    """Folders of the tables a run maintains, all on shared storage."""

    facts: str
    gaps: str
    weeks: str
    ledger: str

    @classmethod
    def below(cls, folder: str) -> Tables:
        return cls(*[f"{folder}/{name}" for name in ("facts", "gaps", "weeks", "ledger")])


def read_facts(spark: SparkSession, tables: Tables, days: list | None = None) -> DataFrame:
    return ledger.read_published(spark, tables.facts, FACTS, tables.ledger, "facts", days)


def read_gaps(spark: SparkSession, tables: Tables, days: list | None = None) -> DataFrame:
    return ledger.read_published(spark, tables.gaps, GAPS, tables.ledger, "gaps", days)


def read_weeks(spark: SparkSession, tables: Tables) -> DataFrame:
    """Sums of positions per pair and week, the week's first day as date."""
    return ledger.read_published(spark, tables.weeks, WEEKS, tables.ledger, "weeks")


def reduced_with_reasons(landed: DataFrame, order_col: str) -> DataFrame:
    """The last row of each kept key, and one row for each day and reason of the others; ``copies`` counts landed rows.

    One aggregate, combined before the shuffle: what is left out takes part as a count.
    """
    judged = with_ingest_reason(landed)
    kept = F.col("reason") == "kept"
    keyed = judged.withColumns({"query": F.when(kept, F.col("query")), "page": F.when(kept, F.col("page"))})
    values = [f.name for f in FACTS.fields if f.name not in FACT_KEYS]
    last = F.max_by(F.struct(*values), F.col(order_col)).alias("last")
    rows = keyed.groupBy("reason", *FACT_KEYS).agg(last, F.count("*").alias("copies"))
    return rows.select("reason", "copies", "query", "page", *[F.col("last")[v].alias(v) for v in values], "date")


_STAGED = T.StructType([T.StructField("reason", T.StringType()), T.StructField("copies", T.LongType()), *FACTS.fields])


def _monday(day: datetime.date) -> datetime.date:
    return day - datetime.timedelta(days=day.weekday())


def process_batch(batch: DataFrame, tables: Tables, dims: Dimensions, source: str = "", batch_id: int | None = None) -> None:
    """Lands one batch, scores the days it touches and sums up their weeks; a finished batch is skipped.

    The batch is parsed, filtered, counted and reduced in one job, into a stage of its own. All tables are written under a
    version nobody reads before the ledger names it.
    """
    spark = batch.sparkSession
    if batch_id is not None and ledger.is_finished(spark, tables.ledger, source, batch_id):
        return
    stage = scratch_folder(spark, "batch")
    write_days(reduced_with_reasons(numbered(batch), "landing_order"), stage)
    staged = read_table(spark, stage, _STAGED)
    landed: dict = {}
    for r in staged.groupBy("date", "reason").agg(F.sum("copies").alias("n")).collect():  # five rows a day at most
        landed.setdefault(r["date"], {})[r["reason"]] = r["n"]
    days = sorted(day for day, n in landed.items() if "kept" in n and day is not None)
    rows = [("landed", day, None, n) for day, n in landed.items()]
    if days:
        rows += _write_days(spark, staged.where("reason = 'kept'").select(*FACTS.fieldNames()), tables, dims, days)
    if rows:
        ledger.publish(spark, tables.ledger, [(source, batch_id, *row) for row in rows])


def _write_days(spark: SparkSession, fresh: DataFrame, tables: Tables, dims: Dimensions, days: list) -> list[tuple]:
    """Writes touched days and weeks under a new version: the ledger's entries (table, date, version, counts)."""
    version = ledger.next_version(spark, tables.ledger)
    by = ("date", "version")
    number = F.lit(version).cast("bigint")
    write_days(put(read_facts(spark, tables, days), fresh, FACT_KEYS).withColumn("version", number), tables.facts, by=by)

    new = dict.fromkeys(days, version)
    facts = ledger.read_versions(spark, tables.facts, FACTS, new)
    scored, report = score_staged(facts, dims, scratch_folder(spark, "raw"))
    write_days(scored.withColumn("version", number), tables.gaps, gather=False, by=by)

    weeks = sorted({_monday(day) for day in days})
    span = [week + datetime.timedelta(days=k) for week in weeks for k in range(7)]
    whole = ledger.read_versions(spark, tables.facts, FACTS, {**ledger.versions(spark, tables.ledger, "facts"), **new}, span)
    write_days(weekly_sums(whole).withColumn("version", number), tables.weeks, by=by)

    counts = {r["date"]: {name: r[name] for name in r.asDict() if name not in ("date", "max_raw_score")} for r in report}
    entries = [("facts", day, version, {}) for day in days] + [("gaps", day, version, counts[day]) for day in days]
    return entries + [("weeks", week, version, {}) for week in weeks]


def accounting(spark: SparkSession, tables: Tables, source: str | None = None) -> DataFrame:
    """``source, batch_id, table, date, counts`` of finished batches: landed rows by reason, scored rows by step.

    Both were counted while rows were landed and scored; no row is read for it.
    """
    rows = ledger.entries(spark, tables.ledger).where(F.size("counts") > 0)
    own = rows if source is None else rows.where(F.col("source") == source)
    return own.select("source", "batch_id", F.col("table"), "date", "counts")


def run_incremental(
    spark: SparkSession,
    landing: str,
    tables: Tables,
    dims: Dimensions,
    checkpoint: str,
    max_files: int | None = None,
) -> DataFrame:
    """Processes every file landed since the last run, then stops: the accounting of this run's batches.

    Batches are told apart by the stream's checkpoint and their id. One that is repeated after a failure is skipped if it
    was finished, and else written whole again.
    """
    done: list[int] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, tables, dims, checkpoint, batch_id)
        done.append(batch_id)

    query = (
        stream_search_facts(spark, landing, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return accounting(spark, tables, checkpoint).where(F.col("batch_id").isin(done))
