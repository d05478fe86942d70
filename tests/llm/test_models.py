"""Tokens, pieces, language-model scores, neighbour votes and the pipeline."""

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from searchlift.llm import context_mixing, neighbour_vote, repair_tokens, sentence_pieces, stretches

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "", " ", "\n", "plain words, and more.", "  a  b   c\n\n d ", "x  y    z", "it's we'll I'M don't '", "a\xa0 b\xa0  c \xa0 d", "a\x85 b  \t\tc\r\n d\x0b\x0c e",
    "日本語 text 🎉🎉 ok\x00\x01 !\x1c a\x1c\x1d", "é" * 50 + " été ñandú", "ｆｕｌｌ　width　 　x", "1234 5,6.7-8 é1 ²³ Ǆ ⅷ ٣٤", "word " * 3000, "▁ mark▁", "<|endoftext|> </s> <0x0A>",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BPE)
    own.encode_special_tokens = True
    return own


def test_stretches_encode_like_whole_texts(tokenizer):
    with open(BPE, encoding="utf-8") as file:
        encoder = repair_tokens.ByteLevelEncoder(file.read(), repair_tokens.PATTERN)
    data, offsets = repair_tokens.text_bytes(pa.array(TEXTS))
    for _ in range(2):  # the second time from memory
        ids, begin = encoder.coder.code(data, offsets)
        for k, text in enumerate(TEXTS):
            assert ids[begin[k] : begin[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(stretches, "REMEMBERED", 3)
    with open(BPE, encoding="utf-8") as file:
        encoder = repair_tokens.ByteLevelEncoder(file.read(), repair_tokens.PATTERN)
    one = encoder.coder.code(*repair_tokens.text_bytes(pa.array(["a b c d e f", "f e d"])))
    again = encoder.coder.code(*repair_tokens.text_bytes(pa.array(["a b c d e f", "f e d"])))
    assert all((x == y).all() for x, y in zip(one, again))


@pytest.mark.parametrize("limit", [1 << 16, 80_000])
def test_repair_round_trip(limit):
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 50_000, 7) for _ in range(30)]
    ids = np.concatenate([phrases[k] for k in rng.integers(0, 30, 3000)] + [np.zeros(501, int)])
    ends = np.zeros(len(ids), dtype=bool)
    ends[rng.integers(0, len(ids), 200)] = True
    ends[-1] = True
    block, at = repair_tokens.repair(ids, ends, 50_257, limit)
    assert (block.expand(block.sequence) == ids).all()
    assert len(block.sequence) < len(ids) / 3
    assert (block.ids_between(1234, 2345) == ids[1234:2345]).all() and len(block.ids_between(5, 5)) == 0
    first = np.r_[0, np.flatnonzero(ends) + 1][:-1]
    symbols = np.r_[at, len(block.sequence)]
    for k in range(0, len(first), 17):
        assert (block.expand(block.sequence[symbols[k] : symbols[k + 1]]) == ids[first[k] : (np.r_[first, len(ids)])[k + 1]]).all()
    assert all(len(block.expand(np.array([block.base + k]))) == n for k, n in enumerate(block.lengths[:50]))


def test_rules_are_made_until_no_pair_is_frequent():
    ids = np.tile(np.arange(1000), 64)
    ends = np.zeros(len(ids), dtype=bool)
    ends[-1] = True
    block, _ = repair_tokens.repair(ids, ends, 50_257, 1 << 16)
    pairs = Counter(zip(block.sequence[:-1].tolist(), block.sequence[1:].tolist()))
    assert max(pairs.values()) < repair_tokens.LEAST and block.lengths.max() > 256
    assert (block.expand(block.sequence) == ids).all()


def test_token_files(spark, docs_of, odd, tokenizer, monkeypatch):
    monkeypatch.setattr(repair_tokens, "BLOCK_IDS", 4000)
    rows = odd + [(1000 - k, t) for k, t in enumerate(TEXTS)]
    blocks = repair_tokens.write_tokens(docs_of(rows).repartition(5), BPE)
    got = sorted(repair_tokens.read_tokens(blocks).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids)) and r.ids[-1] == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        start += r.n_tokens
    want = Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    row = blocks.where("size(doc_ids) > 2").first().asDict()
    assert tuple(repair_tokens.document_ids(row, 1)) in {ids for _, ids in want}
    assert repair_tokens.read_tokens(repair_tokens.write_tokens(docs_of([]), BPE)).collect() == []


def best_by_rule(model, unknown_score, text):
    """The plain dynamic programme over all pieces; ties go to the longer last piece."""
    table = {}
    for k, body in enumerate(model.bytes):
        if model.plain[k] and body and (body.decode() not in table or model.scores[k] > model.scores[table[body.decode()]]):
            table[body.decode()] = k
    longest = max(map(len, table))
    body = " " + text.replace("▁", " ") if text else ""
    best, back = [0.0] + [-math.inf] * len(body), [None] * (len(body) + 1)
    for end in range(1, len(body) + 1):
        for size in range(min(end, longest), 0, -1):
            k = table.get(body[end - size : end])
            if k is not None and best[end - size] + model.scores[k] > best[end]:
                best[end], back[end] = best[end - size] + model.scores[k], (size, [k])
        if body[end - 1] not in table and best[end - 1] + unknown_score > best[end]:
            best[end], back[end] = best[end - 1] + unknown_score, (1, [model.byte_ids[b] for b in body[end - 1].encode()])
    out, end = [], len(body)
    while end:
        size, ids = back[end]
        out, end = ids + out, end - size
    return out


def test_pieces_by_rule_and_back(spark, docs_of, odd):
    model = sentence_pieces.Pieces.load(PIECES)
    unknown = sentence_pieces.Automaton(model).unknown_score
    rows = [*[(i, t) for i, t in odd if i not in (9, 10)], *[(100 + k, t) for k, t in enumerate(TEXTS)]]
    encoded = sentence_pieces.encode(docs_of(rows), PIECES)
    for r in encoded.collect():
        assert r.ids == best_by_rule(model, unknown, r.text or "")
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    assert encoded.columns == ["doc_id", "lang", "row", "size", "measures", "text", "ids", "ids_crc32"]  # ids was there before
    back = sentence_pieces.decode(encoded.withColumn("was", F.col("text")), PIECES)
    assert all(r.decoded == (r.was or "").replace("▁", " ") for r in back.collect()) and back.count() == len(rows)
    assert sentence_pieces.encode(docs_of([]), PIECES).collect() == []
    stray = spark.createDataFrame([(1, [model.byte_ids[0xFF], 1, 2]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in sentence_pieces.decode(stray, PIECES).collect()} == {1: "�", 2: "", 3: ""}


def test_long_texts_make_the_round_trip(docs_of, odd):
    rows = [(i, t) for i, t in odd if i in (9, 10)] + [(1, "longwordwithoutbreak" * 500)]
    encoded = sentence_pieces.encode(docs_of(rows), PIECES).withColumn("was", F.col("text"))
    assert all(r.decoded == r.was for r in sentence_pieces.decode(encoded, PIECES).collect())


def scored(docs):
    held = neighbour_vote.fold(F.col("doc_id"), 7) == 2
    return {r.doc_id: r for r in context_mixing.train_and_score(docs, held).collect()}


def test_scores_on_small_tables(spark, folder, monkeypatch):
    monkeypatch.setattr(context_mixing, "BUNDLE_BYTES", 20_000)  # words and runs come from many bundles
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, brute.words(r.text)) for r in docs.select("doc_id", "text").collect()]
    train = [(i, w) for i, w in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(x for _, w in train for x in w)
    counts[None] = len(train)
    total, distinct = sum(counts.values()), len(counts)
    got = scored(docs)
    for i, w in rows:
        r, tokens = got[i], [*w, None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(tokens), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens))
    held = [r for r in got.values() if r.held_out]
    bits = -sum(r.score for r in held) / math.log10(2) / sum(r.n_bytes for r in held)
    assert 0.5 < bits < 3.2  # order-0 statistics alone need over 4


def counted_runs(texts):
    data = [t.encode() for t in texts]
    flat = np.frombuffer(b"".join(data), dtype=np.uint8)
    return Counter(context_mixing.blocks(flat, np.r_[0, np.cumsum([len(d) for d in data])])[0].tolist())


def test_a_byte_has_probability_one():
    rng = np.random.default_rng(1)
    text = "the cat sat on the mat and the rat sat on the cat " * 40
    own = counted_runs([text])
    some = [c & ~0xFF for c in rng.choice(list(own), 5).tolist()]
    every = Counter({c | b: 0 for c in some for b in range(256)})
    every.update(own)
    code = np.array(sorted(every), dtype=np.uint64)
    counts = context_mixing.Counts(code, np.array([every[c] for c in code.tolist()]))
    model = context_mixing.Model(context_mixing.learned_weights(counts), context_mixing.untrained())
    bits = dict(zip(code.tolist(), model.bits_of(counts), strict=True))
    for c in some:
        assert sum(2.0 ** -bits[c | b] for b in range(256)) == pytest.approx(1)
    assert sum(bits[c] * n for c, n in own.items()) / len(text) < 1  # and this text is easy


def plain_counts(own, code, order, j):
    """Zeros and ones after the context of a run and the first j bits of its byte, counted one by one."""
    shift = 8 * (6 - order)
    sums = [0, 0]
    for other, n in own.items():
        if other >> shift == code >> shift and (other & 255) >> (8 - j) == (code & 255) >> (8 - j):
            sums[(other >> (7 - j)) & 1] += n
    return sums


def test_every_context_is_counted_over_all_parts(spark, docs_of, monkeypatch):
    """The whole model by a plain reading: counts of every context, weights, refinement, and the score of every text."""
    monkeypatch.setattr(context_mixing, "BUNDLE_BYTES", 60)
    monkeypatch.setattr(context_mixing, "PARTS", 6)
    monkeypatch.setattr(context_mixing, "SAMPLE_BITS", 2)
    texts = ["abc abd abe", "abc abc", "bcd bca abd é", "", "xyz xya", "aaaa abab"]
    rows = [(k, t) for k, t in enumerate(texts)]
    kept = {}
    original = context_mixing.train

    def train(parts):
        kept["parts"] = list(context_mixing._opened_parts(parts.toArrow().to_batches()))
        kept["model"] = original(parts)
        return kept["model"]

    monkeypatch.setattr(context_mixing, "train", train)
    got = {r.doc_id: r.score for r in context_mixing.train_and_score(docs_of(rows), F.col("doc_id") == 4).collect()}
    own = counted_runs([t for k, t in rows if k != 4])
    assert len(kept["parts"]) > 3 and any(counts.shared for _, counts in kept["parts"])
    weights = sum(context_mixing.learned_weights(c) * c.n.sum() for _, c in kept["parts"] if c.n.any()) / sum(own.values())
    assert np.allclose(weights, kept["model"].weights)
    hits = sum(context_mixing.refinement_counts(c, weights) for _, c in kept["parts"])
    assert np.allclose(kept["model"].refined, (hits[1] + 8 * context_mixing.untrained()) / (hits.sum(axis=0) + 8))
    bits = {}
    for _, counts in kept["parts"]:
        for j in range(8):
            for order, (zeros, ones) in zip(context_mixing.ORDERS, counts.of_bit(j)[2], strict=True):
                for code, *sums in zip(counts.code.tolist(), zeros, ones, strict=True):
                    assert sums == plain_counts(own, code, order, j)
        bits.update(zip(counts.code.tolist(), kept["model"].bits_of(counts), strict=True))
    for k, t in rows:
        assert got[k] == pytest.approx(-math.log10(2) * sum(bits[c] * n for c, n in counted_runs([t]).items()), rel=1e-4)


def test_scores_of_odd_rows(docs_of, odd):
    rows = [(i, t) for i, t in odd if i != 10]
    got = context_mixing.train_and_score(docs_of(rows), F.col("doc_id") == 12).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].score == by_id[2].score < 0 and (by_id[1].n_tokens, by_id[1].n_known, by_id[1].n_bytes) == (1, 1, 0)
    assert by_id[12].held_out and not by_id[None].held_out
    assert [r.score for r in got if r.doc_id == 8][0] == by_id[7].score
    assert context_mixing.train_and_score(docs_of([]), F.lit(False)).collect() == []
    none = context_mixing.train_and_score(docs_of([(1, "ab")]), F.lit(True)).first()
    assert (none.train_tokens, none.n_known, none.n_tokens) == (0, 0, 2)
    assert none.score == pytest.approx(-3 * 8 * math.log10(2)) and none.base_score == 0


def test_votes_tell_junk_from_text(spark, docs_of):
    rows, labels = [], []
    for k in range(300):
        junk = k % 3 == 0
        word = [f"{'wh' * (j % 3)}{chr(97 + (j * k) % 26)}ond" for j in range(30 + k % 40)]
        rows.append((k, " ".join(w + "***" for w in word) if junk else " ".join(word) + "."))
        if k < 200:
            labels.append((k, 0 if junk else 1))
    known = spark.createDataFrame([*labels, (None, 1), (5, None), (9999, 1)], "doc_id long, label int")
    model = neighbour_vote.train(docs_of(rows), known)
    got = {r.doc_id: r.score for r in neighbour_vote.vote(docs_of([*rows, (500, None), (501, "")]), model).collect()}
    assert all((got[k] >= 0.3) == (k % 3 != 0) for k in range(200, 300))
    assert got[500] == got[501] == pytest.approx(model.prior) and all(0 <= s <= 1 for s in got.values())
    small = neighbour_vote.train(docs_of(rows), known, sample=20)
    assert len(small.labels) <= 20


def test_votes_without_labels_or_rows(spark, docs_of, odd):
    none = neighbour_vote.train(docs_of(odd), spark.createDataFrame([], "doc_id long, label int"))
    assert {r.score for r in neighbour_vote.vote(docs_of(odd), none).collect()} == {0.5}
    one = neighbour_vote.train(docs_of(odd), spark.createDataFrame([(7, 1)], "doc_id long, label int"))
    got = neighbour_vote.vote(docs_of(odd), one).collect()
    assert len(got) == len(odd) and {r.score for r in got} == {1.0}
    assert neighbour_vote.vote(docs_of([]), one).collect() == []


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    by_stage = dict(corpus_pipeline.STAGES)
    good = by_stage["quality_rules"](spark, docs, folder).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    rest = by_stage["ngram_jaccard_join"](spark, good, folder).cache()
    comp = brute.components({r.doc_id: brute.shingle_set(r.text) for r in good.collect()})
    assert sorted(r.doc_id for r in rest.collect()) == sorted(set(comp.values())) and rest.columns == docs.columns
    items = [brute.shingle_set(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = by_stage["benchmark_decontamination"](spark, rest, folder).cache()
    held = {r.doc_id: brute.shingle_set(r.text) for r in rest.collect()}
    want = [i for i, own in held.items() if not any(100 * len(s & own) >= 80 * len(s) for s in items)]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(want) and clean.columns == docs.columns
    safe = by_stage["secret_scan"](spark, clean, folder)
    assert safe.columns == docs.columns and safe.count() == clean.count() and safe.dtypes == docs.dtypes
    assert all(r.n_chars == len(r.text) for r in safe.collect())
    done = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in done.collect()) == sorted(want)


def test_pipeline_of_odd_rows(spark, docs_of, odd, folder):
    rows = [*odd, (50, None), (51, "token = abcdef0123456789 " + "the house of the man " * 6)]
    docs = docs_of(rows).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1).cast("long"))
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, folder)
    got = docs.collect()
    assert sorted(r.doc_id for r in got if r.doc_id) == [1, 2, 3, 4, 5, 7, 9, 12, 50, 51]
    empty = docs_of([]).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1).cast("long"))
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.collect() == []
