"""Tables that cut a job's lineage, kept in the shared folder that the session names."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlift.session import scratch_folder


def stored(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> DataFrame:
    """Writes a frame as Parquet below the shared scratch folder and reads it back.

    The files go when the driver ends. Once the table is written, the shuffles that led to it are of no use; they are
    freed as soon as the driver's garbage is collected, which is asked for here so that steps don't pile up on disk.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.options(**(options or {})).partitionBy(*partition_by).parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


#: Rows and bytes of a batch that goes to a Python worker, at most.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
#: What Spark takes where the session says nothing.
_DEFAULT_BYTES = "67108864b"


def small_batches(docs: DataFrame) -> DataFrame:
    """The frame, its session set to hand texts to Python in small batches: they may be long, and a worker holds one whole."""
    conf, rows, size = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(rows)) <= BATCH_ROWS:
        conf.set(rows, BATCH_ROWS)
    if conf.get(size) == _DEFAULT_BYTES:
        conf.set(size, BATCH_BYTES)
    return docs


def packed(names: list[str]) -> Column:
    """Columns of any names as one struct `row`, whose fields go by their place."""
    fields = [F.col(f"`{name.replace('`', '``')}`").alias(f"c{k}") for k, name in enumerate(names)]
    return F.struct(*fields, F.lit(0).alias("end")).alias("row")


def unpacked(names: list[str]) -> list[Column]:
    """The columns that `packed` put away."""
    return [F.col("row")[f"c{k}"].alias(name) for k, name in enumerate(names)]


def documents_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
