"""What finished batches have published: days of tables under a version, and what was counted on the way.

A batch writes whole days below a version of its own, where nobody reads them yet, and then appends one file to the
ledger. That file is what publishes the batch, all its tables at once; a reader takes for each day the newest version
that the ledger names. A batch that fails before has changed nothing, and its repetition writes the same version again.
One writer at a time is assumed.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from searchlift.sources.store import read_table

LEDGER = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("version", T.LongType()),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
    ]
)
VERSION = T.StructField("version", T.LongType())

Versions = dict[datetime.date, int]


def entries(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, LEDGER)


def is_finished(spark: SparkSession, path: str, source: str, batch_id: int) -> bool:
    """Whether the ledger has a batch; ids count for each source on its own."""
    own = entries(spark, path).where((F.col("source") == source) & (F.col("batch_id") == batch_id))
    return bool(own.take(1))


def next_version(spark: SparkSession, path: str) -> int:
    return (entries(spark, path).agg(F.max("version")).first()[0] or 0) + 1


def versions(spark: SparkSession, path: str, table: str) -> Versions:
    """The newest version of each published day of a table: one entry for each calendar day."""
    own = entries(spark, path).where((F.col("table") == table) & F.col("version").isNotNull())
    return {r["date"]: r["version"] for r in own.groupBy("date").agg(F.max("version").alias("version")).collect()}


def publish(spark: SparkSession, path: str, rows: Iterable[tuple]) -> None:
    """Appends the entries of a batch as one file, which appears whole or not at all."""
    spark.createDataFrame(list(rows), LEDGER).coalesce(1).write.mode("append").parquet(path)


def read_versions(spark: SparkSession, path: str, schema: T.StructType, named: Versions, days: list | None = None) -> DataFrame:
    """The rows of these versions of a table, on the listed days or on all; only their folders are read."""
    chosen = [(day, version) for day, version in named.items() if days is None or day in days]
    rows = read_table(spark, path, T.StructType([*schema.fields, VERSION]))
    # A filter of partition columns for the listing, and a row for each day for the pairs.
    listed = rows.where(F.col("date").isin([d for d, _ in chosen]) & F.col("version").isin(sorted({v for _, v in chosen})))
    pairs = spark.createDataFrame(chosen, "date date, version long")
    return listed.join(F.broadcast(pairs), ["date", "version"], "left_semi").select(*schema.fieldNames())


def read_published(spark: SparkSession, path: str, schema: T.StructType, ledger: str, table: str, days: list | None = None) -> DataFrame:
    return read_versions(spark, path, schema, versions(spark, ledger, table), days)


def drop_superseded(spark: SparkSession, path: str, ledger: str, table: str) -> int:
    """Deletes the folders of versions that newer ones replace; for times without readers of older plans."""
    jvm, gone = spark.sparkContext._jvm, 0
    for day, newest in versions(spark, ledger, table).items():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/date={day.isoformat()}")
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("version=") and int(name.removeprefix("version=")) < newest:
                gone += fs.delete(status.getPath(), True)
    return gone
