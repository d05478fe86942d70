"""Facts as a table of the session's catalog, bucketed by query and page inside each day.

Updates are staged in the same buckets, so target and updates meet where they lie: an upsert exchanges the updates once and
no row of the target, however much of a day it touches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from searchlift.schemas import FACT_KEYS, FACTS
from searchlift.session import scratch_folder
from searchlift.sources.store import on_days, put, reduced, touched_days

BUCKET_KEYS = ("query", "page")
#: Lets both sides meet on their buckets, which know the keys but the date; needed where upserts are planned.
CO_LOCATED = "spark.sql.requireAllClusterKeysForCoPartition"


def create_facts_table(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """A facts table over a folder; the folder may hold the days of an earlier session with the same number of buckets."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACTS.fields)
    keys = ", ".join(BUCKET_KEYS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY (date) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def buckets_of(spark: SparkSession, name: str) -> int:
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(described["Num Buckets"])


def write_bucketed(rows: DataFrame, name: str, gather: bool = True) -> None:
    """Replaces the days of the rows; ``gather`` brings each bucket's rows into one task, which rows in buckets need not."""
    dealt = rows.repartition(buckets_of(rows.sparkSession, name), *BUCKET_KEYS) if gather else rows
    dealt.select(*FACTS.fieldNames()).write.mode("overwrite").insertInto(name)


def upserted(spark: SparkSession, name: str, stage: str, days: list) -> DataFrame:
    """The touched days of a table with the staged updates in place; the target is read bucket by bucket."""
    return put(on_days(spark.table(name), days), spark.table(stage), FACT_KEYS)


def upsert_table(spark: SparkSession, name: str, updates: DataFrame, order_col: str | None = None) -> None:
    """Inserts or overwrites facts by key, rewriting only the touched days; the last update of a key wins."""
    stage = f"{name}_{uuid.uuid4().hex}"
    create_facts_table(spark, stage, scratch_folder(spark, "updates"), buckets_of(spark, name))
    before = spark.conf.get(CO_LOCATED)
    try:
        write_bucketed(reduced(updates, FACT_KEYS, order_col), stage)
        days = touched_days(spark.table(stage))
        spark.conf.set(CO_LOCATED, "false")
        if days:
            write_bucketed(upserted(spark, name, stage, days), name, gather=False)
    finally:
        spark.conf.set(CO_LOCATED, before)
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
