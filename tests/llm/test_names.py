"""Every operator on documents whose other columns bear the names that operators use inside."""

import pytest
from pyspark.sql import functions as F

from searchlift.llm import context_mixing, decontaminate, histogram_sort, ngram_join, pii, quality_rules, repair_tokens, secret_scan, sentence_pieces, substring_dedup
from searchlift.llm import neighbour_vote

public_tokenizers = pytest.importorskip("public_tokenizers")

NAMES = (
    "__ __h __d __p __row __words __windows __lines __found __gone __id row body h d p own before bucket at first start end n key kind part bundle ids flags "
    "sizes body2 n_bytes told text_key set_key least rows gone component component_id n_shingles hash hashes doc item flag held_out bits known logs base runs "
    "every flagged whole measures words windows lines label c0 c1 spread has_rare vector x anchor leaf i j lo hi total"
).split()
TEXT = "the house of the man is on the hill and it was in the town with a garden by the sea of the south"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, TEXT + " one"), (2, TEXT + " one"), (3, "mail a.b@example.org token = abcdef0123456789ab"), (None, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(f"is {name}").alias(name) for name in NAMES])


KEEPING = {
    "op2": lambda d: histogram_sort.shard_by_bytes(d, 2),
    "op4": lambda d: sentence_pieces.encode(d.drop("ids"), public_tokenizers.path("piece_bpe_32k.model")),
    "op5": secret_scan.scan_secrets,
    "op5 redacted": lambda d: secret_scan.redact_secrets(d, "[S]"),
    "op7 clean": lambda d: decontaminate.clean_rows(d, items(d)),
    "op7 clean by join": lambda d: decontaminate.clean_rows(d, items(d), broadcast_shingles=0),
    "op7 without": lambda d: decontaminate.without_contained(d, items(d)),
    "op9": lambda d: quality_rules.judged(d.drop("measures")),
    "op9 kept": quality_rules.keep_good,
    "op10": pii.find_pii,
    "op3 kept": ngram_join.keep_one,
}
ANSWERING = {
    "op1": lambda d: repair_tokens.read_tokens(repair_tokens.write_tokens(d, public_tokenizers.path("byte_bpe_50k.json"))),
    "op3": ngram_join.jaccard_join,
    "op6": lambda d: context_mixing.train_and_score(d, F.col("doc_id") == 1),
    "op7": lambda d: decontaminate.find_contained(d, items(d)),
    "op8": lambda d: neighbour_vote.vote(d, neighbour_vote.train(d, d.where("doc_id < 4").select("doc_id", (F.col("doc_id") % 2).alias("label")))),
    "op12": substring_dedup.remove_repeats,
}


def items(d):
    return d.sparkSession.createDataFrame([(1, "no such words in any of the documents here")], "item_id long, text string")


@pytest.mark.parametrize("name", KEEPING)
def test_other_columns_stay(docs, name):
    got = KEEPING[name](docs).collect()
    assert got
    for row in got:
        for column in set(NAMES) & set(row.asDict()):
            if row[column] is not None and column not in ("ids", "measures"):
                assert row[column] == f"is {column}", column
        assert len(set(NAMES) - set(row.asDict())) <= 2


@pytest.mark.parametrize("name", ANSWERING)
def test_other_columns_do_no_harm(docs, name):
    bare = sorted(map(str, ANSWERING[name](docs.select("doc_id", "text")).collect()))
    assert sorted(map(str, ANSWERING[name](docs).collect())) == bare
