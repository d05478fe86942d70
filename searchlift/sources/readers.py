"""Readers of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from searchlift.functions.numbers import loose_number
from searchlift.schemas import LANDED_CTR, POSITION, SEARCH_ROW

# The columns of the business file.
BI_COLUMNS = ("group_.one", "group_.two", "tasa_conversion", "Ticket Promedio")

_DATED_ROW = T.StructType([*SEARCH_ROW.fields, T.StructField("date", T.DateType())])
_RESPONSE = T.StructType(
    [T.StructField("rows", T.ArrayType(SEARCH_ROW)), T.StructField("date", T.DateType())]
)


def _landing_order(ordinal, batch, row):
    """Sorts rows by arrival: batch, file time and name, given row number, then place in the file.

    ``row`` is the offset of the split a row stands in and an id that grows along a split, which one task reads
    from start to end; it decides where files carry no row numbers.
    """
    return F.struct(
        F.coalesce(batch, F.lit(0)).cast("bigint").alias("batch"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(ordinal, F.lit(0)).cast("bigint").alias("ord"),
        row.alias("row"),
    ).alias("landing_order")


def _place_in_file():
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))


def _facts(rows: DataFrame, date) -> DataFrame:
    return rows.select(
        date.alias("date"),
        F.get("keys", F.lit(0)).alias("query"),
        F.get("keys", F.lit(1)).alias("page"),
        "clicks",
        "impressions",
        F.col("ctr").cast(LANDED_CTR).alias("ctr"),
        F.col("position").cast(POSITION).alias("position"),
        "landing_order",
    )


def read_search_facts(spark: SparkSession, path: str, date=None) -> DataFrame:
    """Landed rows as facts, one JSON object per line.

    ``date`` stamps a one-day file; without it the day comes from ``date=`` folders. A row's ``batch`` and ``ord``,
    where landed, go before file time and place in the file.
    """
    schema = _DATED_ROW if date is None else SEARCH_ROW
    rows = spark.read.schema(schema).json(path).select("*", _landing_order(F.col("ord"), F.col("batch"), _place_in_file()))
    return _facts(rows, F.col("date") if date is None else F.to_date(F.lit(date)))


def stream_search_facts(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same over ``date=`` folders as a stream of newly landed files."""
    reader = spark.readStream.schema(_DATED_ROW)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A stream can't number rows; who handles its batches adds the id (``numbered``).
    place = F.struct(F.col("_metadata.file_block_start").alias("block"))
    rows = reader.json(path).select("*", _landing_order(F.col("ord"), F.col("batch"), place))
    return _facts(rows, F.col("date"))


def numbered(batch: DataFrame) -> DataFrame:
    """A batch of a stream with the place of each row behind its landing order, taken before any shuffle."""
    return batch.withColumn("landing_order", F.struct("landing_order", F.monotonically_increasing_id().alias("id")))


def read_search_responses(spark: SparkSession, path: str, date=None) -> DataFrame:
    """Landed whole responses, one JSON document per file with its rows in one array."""
    docs = spark.read.schema(_RESPONSE).option("multiLine", True).json(path)
    stamped = docs if date is None else docs.withColumn("date", F.to_date(F.lit(date)))
    rows = stamped.select("date", "_metadata", F.posexplode("rows").alias("pos", "row"))
    place = F.struct(F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("id"))
    return _facts(rows.select("date", "row.*", _landing_order(F.col("row.ord"), F.col("row.batch"), place)), F.col("date"))


def read_bi(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The business file: columns bound by the header's names, blank lines skipped, numbers read leniently, order kept.

    Columns may stand in any order and others beside them; a missing one is an error, and so is a file whose header
    differs from the first file's. ``multi_line`` allows line breaks inside quotes and makes a file one task.

    File order is file, then byte offset of the split, then an id that grows along a split, which one
    task reads from start to end. The id is taken on the scan itself, before any shuffle.
    """
    header = spark.read.option("header", True).option("multiLine", multi_line).csv(path).columns
    missing = [name for name in BI_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"business file without column {', '.join(missing)}: {', '.join(header)}")
    raw = (
        spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return raw.select(
        F.col("`group_.one`").alias("dept"),
        F.col("`group_.two`").alias("sub"),
        loose_number(F.col("tasa_conversion")).alias("tasa_conversion"),
        loose_number(F.col("`Ticket Promedio`")).alias("ticket_promedio"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
    )
