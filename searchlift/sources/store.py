"""Table maintenance on plain Parquet: keyed upserts, date-wise rewrites, versioned snapshots."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from searchlift.schemas import FACT_KEYS, FACTS, GAP_KEYS, WATCH_KEYS, WATCHLIST
from searchlift.session import scratch_folder


def last_wins(df: DataFrame, keys: tuple[str, ...], order_col: str) -> DataFrame:
    """One row per key: the last by ``order_col``, which is dropped.

    An aggregate rather than a window: copies of a hot key are combined before the shuffle.
    """
    values = [c for c in df.columns if c not in keys and c != order_col]
    order = F.col(order_col)
    if isinstance(df.schema[order_col].dataType, (T.NumericType, T.DatetimeType)):
        # Every column follows the same comparisons, so all come from one row, and plain buffers hash.
        return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])
    last = F.max_by(F.struct(*values), order).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col("last")[v].alias(v) for v in values])


def reduced(updates: DataFrame, keys: tuple[str, ...], order_col: str | None) -> DataFrame:
    """One update for each key. Without an order the copies must be equal: differing ones are refused as they are read."""
    if order_col:
        return last_wins(updates, keys, order_col)
    values = [c for c in updates.columns if c not in keys]
    row = F.struct(*values)
    one = updates.groupBy(*keys).agg(F.min(row).alias("row"), F.max(row).alias("other"))
    same = F.when(F.col("row") == F.col("other"), F.col("row")).otherwise(F.raise_error(F.lit("updates of one key differ: name an order")))
    return one.select(*keys, same.alias("row")).select(*keys, *[F.col("row")[v].alias(v) for v in values])


def upsert(target: DataFrame, updates: DataFrame, keys: tuple[str, ...], order_col: str | None = None) -> DataFrame:
    """Target rows with the updates inserted or overwriting by key; the last update of a key wins.

    The updates are used twice, for their keys and for their rows: ``stage_updates`` works them out once.
    The target meets only the updates' keys. Where Spark's size estimate shows a few corrections they are
    broadcast and the target stays unshuffled; else both sides meet on the keys the updates were reduced by.
    """
    return put(target, reduced(updates, keys, order_col), keys)


def put(target: DataFrame, fresh: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``upsert`` of updates that hold each key once."""
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


def stage_updates(updates: DataFrame, keys: tuple[str, ...], order_col: str | None, stage: str) -> DataFrame:
    """The reduced updates, written by date and read back: days, keys and rows then come from files."""
    fresh = reduced(updates, keys, order_col)
    write_days(fresh, stage)
    return read_table(fresh.sparkSession, stage, fresh.schema)


def seed_gaps(gaps: DataFrame, seeds: DataFrame, keys: tuple[str, ...] = GAP_KEYS) -> DataFrame:
    """Gap rows with the absent seeds appended; rows already there are not touched."""
    absent = seeds.join(gaps.select(*keys), list(keys), "left_anti")
    return gaps.unionByName(absent, allowMissingColumns=True)


def numbered_parts(rows: DataFrame, part: str, order: list[Column], out: str, start: Column | None = None) -> DataFrame:
    """Numbers rows from ``start`` (0 by default) in the order of their part, and within a part by ``order``.

    Parts are counted, and the counts before each part added up: a row for each part. No window spans more than one part.
    """
    counts = rows.groupBy(part).agg(F.count("*").alias("rows"))
    before = counts.select(part, (F.sum("rows").over(Window.orderBy(part)) - F.col("rows")).alias("rows_before"))
    within = rows.withColumn(out, F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1)
    first = F.lit(0).cast("bigint") if start is None else start
    return within.join(F.broadcast(before), part).withColumn(out, F.col(out) + F.col("rows_before") + first).drop("rows_before")


def numbered(rows: DataFrame, order: list[str], stage: str, out: str, start: Column | None = None) -> DataFrame:
    """Numbers rows from ``start`` in the order of some columns, whose ranges become the parts.

    The ranges are written to ``stage`` first, so that counts and numbers are those of the same parts.
    """
    rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(stage)
    staged = rows.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType())])).parquet(stage)
    return numbered_parts(staged, "part", [F.col(c) for c in order], out, start).drop("part")


def upsert_watchlist(watch: DataFrame, updates: DataFrame, now, order_col: str | None = None, stage: str | None = None) -> DataFrame:
    """Inserts or replaces watched pairs; a replaced row keeps its id and its note.

    New rows are numbered on from the largest id, in the order of query and page.
    """
    spark = watch.sparkSession
    fresh = reduced(updates, WATCH_KEYS, order_col)
    replaced = ("agency_factor_aplicado", "baseline_position", "target_position", "baseline_date")
    renamed = fresh.select(*WATCH_KEYS, *[F.col(c).alias(f"new_{c}") for c in replaced], F.lit(True).alias("hit"))
    joined = watch.join(renamed, list(WATCH_KEYS), "left")
    stamp = F.to_timestamp(F.lit(now))
    columns = {c: F.when(F.col("hit"), F.col(f"new_{c}")).otherwise(F.col(c)) for c in replaced}
    columns["created_at"] = F.when(F.col("hit"), stamp).otherwise(F.col("created_at"))
    largest = watch.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    absent = fresh.join(watch.select(*WATCH_KEYS), list(WATCH_KEYS), "left_anti")
    added = numbered(absent, list(WATCH_KEYS), stage or scratch_folder(spark, "watch"), "id", largest + 1)
    added = added.withColumns({"notas": F.lit(None), "created_at": stamp})
    return _watch_rows(joined.withColumns(columns)).unionByName(_watch_rows(added))


def _watch_rows(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WATCHLIST.fields])


def delete_by_id(watch: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows left, and the ids that were there to delete."""
    wanted = ids.select("id")
    return watch.join(wanted, "id", "left_anti"), watch.join(wanted, "id", "left_semi").select("id")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with a known schema; empty before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def on_days(df: DataFrame, days: list) -> DataFrame:
    """Rows of the listed days, as a partition filter."""
    return df.where(F.col("date").isin(days))


def touched_days(df: DataFrame) -> list:
    """The distinct days of a frame: one value per calendar day, so the list stays small."""
    return sorted(row["date"] for row in df.select("date").distinct().collect())


def write_days(df: DataFrame, path: str, gather: bool = True, by: tuple[str, ...] = ("date",)) -> None:
    """Rewrites exactly the days in the frame, or what else ``by`` names.

    REBALANCE gathers a day's rows into few files and splits a day too large for one task. Rows read
    from a table laid out by day need no gathering.
    """
    laid_out = df.hint("rebalance", "date") if gather else df
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def upsert_days(spark: SparkSession, path: str, fresh: DataFrame, days: list) -> None:
    """Upserts staged updates into facts on disk, reading and rewriting only the touched days."""
    target = on_days(read_table(spark, path, FACTS), days)
    write_days(put(target, fresh, FACT_KEYS), path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newest version of a table that is always rewritten whole."""
    versions = read_table(spark, path, T.StructType([*schema.fields, T.StructField("version", T.LongType())]))
    newest = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == F.lit(newest)).drop("version")


def write_snapshot(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Adds the next version, so the one being read is never overwritten."""
    versions = read_table(
        df.sparkSession, path, T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    )
    newest = versions.agg(F.max("version")).first()[0] or 0
    numbered = df.select(*schema.fieldNames()).withColumn("version", F.lit(newest + 1).cast("bigint"))
    numbered.write.mode("append").partitionBy("version").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Writes a frame as CSV with a header, quoting where needed; a sorted frame lies in order over the parts by name."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_exported(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of an export with ``row_index``, their place over all parts by name, from 1."""
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = spark.read.schema(schema).option("header", True).csv(path)
    placed = rows.select("*", place.alias("part"), F.monotonically_increasing_id().alias("line"))
    return numbered_parts(placed, "part", [F.col("line")], "row_index", F.lit(1).cast("bigint")).drop("part", "line")
