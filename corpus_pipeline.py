"""The corpus pipeline: five stages over `documents`, each a training-data operator whose decisions take effect.

run(spark, sf_dir) applies STAGES in order. Every stage's rows are written as Parquet to the shared folder and read
again as the next one's documents. All stages but the last return the columns of documents; rows with null or empty
texts are judged like others, extra columns pass through, and an empty table stays empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from searchlift.llm import decontaminate, ngram_join, quality_rules, secret_scan, sentence_pieces  # noqa: E402
from searchlift.llm.tables import documents_of, stored  # noqa: E402

#: What stands in a text where a secret was.
SECRET_MARK = "[SECRET]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that break a quality rule."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links join: a row with its least doc_id."""
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text contains a benchmark item; rows that share a doc_id are judged each by its text."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts SECRET_MARK where a secret stands; n_chars follows the text."""
    return secret_scan.redact_secrets(docs, SECRET_MARK).withColumn(
        "n_chars", F.when(F.col("n_chars").isNotNull(), F.length(F.coalesce("text", F.lit(""))).cast("long"))
    ).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text: doc_id, lang, source, n_tokens, ids and ids_crc32."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(docs, model)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "ids_crc32")


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secrets),
    ("sentence_pieces", pieces),
]

#: SQL can't express the piece encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_of(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
