"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlift.llm import context_mixing, neighbour_vote, pii, repair_tokens, secret_scan, sentence_pieces, spans, whitening
from searchlift.llm.decontaminate import find_contained
from searchlift.llm.hard_negatives import mine
from searchlift.llm.histogram_sort import shard_by_bytes
from searchlift.llm.ngram_join import jaccard_join
from searchlift.llm.oracles import ORACLES  # noqa: F401  (registered beside the queries)
from searchlift.llm.quality_rules import judged
from searchlift.llm.substring_dedup import remove_repeats
from searchlift.llm.tables import documents_of


def _public(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repair_tokens(spark: SparkSession, folder: str) -> DataFrame:
    blocks = repair_tokens.write_tokens(documents_of(spark, folder), _public("byte_bpe_50k.json"))
    return repair_tokens.read_tokens(blocks, with_ids=False)


def op2_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    dealt = shard_by_bytes(documents_of(spark, folder).select("doc_id", "text"), shards=8)
    return dealt.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(documents_of(spark, folder))


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    counts = [spans.count_of(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, spans.digest(F.col("base_spans")).alias("base_sha256"), spans.joined(F.col("spans")).alias("spans"))


def op4_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = _public("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(documents_of(spark, folder).select("doc_id", "text"), model)
    decoded = sentence_pieces.decode(encoded.withColumn("n_tokens", F.size("ids").cast("long")), model)
    source = F.translate(F.coalesce("text", F.lit("")), sentence_pieces.MARK, " ")
    return decoded.select("doc_id", "n_tokens", "ids_crc32", F.col("decoded").eqNullSafe(source).alias("round_trip"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _span_digest(secret_scan.scan_secrets(documents_of(spark, folder).select("doc_id", "text")), secret_scan.BASE_KINDS)


def op6_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.train_and_score(documents_of(spark, folder), neighbour_vote.fold(F.col("doc_id"), 7) == 2)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_contained(documents_of(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op8_neighbour_vote(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents_of(spark, folder)
    held_out = F.coalesce(neighbour_vote.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    known = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = neighbour_vote.vote(docs, neighbour_vote.train(docs, known))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = judged(documents_of(spark, folder).select("doc_id", "text"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *[F.col("measures")[m].alias(m) for m in measures], "verdict.base_failed", "verdict.kept")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return _span_digest(pii.find_pii(documents_of(spark, folder).select("doc_id", "text")), pii.KINDS)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    model = whitening.fit(rows)
    explained = [float(e) for e in model.explained] if model else []
    each = whitening.whiten(rows, model).select("key", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        F.col("key").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(e) for e in explained]).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeats(documents_of(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    # Some labels are moved on, so that near rows of another label exist.
    labels = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", labels.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repair_tokens": op1_repair_tokens,
    "op2_histogram_sort": op2_histogram_sort,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_secret_scan": op5_secret_scan,
    "op6_context_mixing": op6_context_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_neighbour_vote": op8_neighbour_vote,
    "op9_quality_rules": op9_quality_rules,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
