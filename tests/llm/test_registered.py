"""The registered queries on the small table: names, types, and every column of the contract by a plain reading."""

import hashlib
import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest

from searchlift.llm import neighbour_vote, pii, registry

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def result(spark, folder, key, **types):
    df = registry.QUERIES[key](spark, folder)
    kinds = dict(df.dtypes)
    assert {name: kinds.get(name) for name in types} == types
    return df.collect()


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_op1(spark, folder, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = result(spark, folder, "op1_repair_tokens", doc_id="bigint", start="bigint", n_tokens="bigint", ids_crc32="bigint")
    want, start = set(), 0
    for i in sorted(texts):
        ids = [*own.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        want.add((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows} == want and len(rows) == len(texts)


def test_op2(spark, folder, texts):
    rows = result(spark, folder, "op2_histogram_sort", doc_id="bigint", size="bigint", text_crc32="bigint", law="string", shard="int", slot="bigint", grown_shard="int")
    assert len(rows) == len(texts)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(sizes) <= set(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    largest = max(r["size"] for r in rows)
    assert all(abs(sizes[k] - sum(sizes.values()) / 8) <= 0.01 * sum(sizes.values()) / 8 + largest for k in range(8))


def test_op3(spark, folder, texts):
    rows = result(spark, folder, "op3_ngram_jaccard_join", doc_id="bigint", n_shingles="bigint", component_id="bigint")
    sets = {i: brute.shingle_set(t) for i, t in texts.items()}
    components = brute.components(sets)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows} == {(i, len(s), components[i]) for i, s in sets.items()} and len(rows) == len(texts)


ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SECRETS = {
    "assign": (ASSIGN, lambda m: len(m.group(2)) >= 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16),
}
DIGITS = re.compile("[^0-9]")
PERSONAL = {
    "email": (pii.EMAIL, lambda m: True),
    "ip": (pii.IP, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    "card": (pii.CARD, lambda m: 12 <= len(DIGITS.sub("", m.group())) <= 19 and pii.luhn(DIGITS.sub("", m.group()))),
    "phone": (pii.PHONE, lambda m: 9 <= len(DIGITS.sub("", m.group())) <= 15),
}


@pytest.mark.parametrize("key,kinds", [("op5_secret_scan", SECRETS), ("op10_pii", PERSONAL)])
def test_base_spans(spark, folder, texts, key, kinds):
    types = {"doc_id": "bigint", "base_sha256": "string", "spans": "string", **{f"n_{kind}": "bigint" for kind in kinds}}
    rows = result(spark, folder, key, **types)
    assert len(rows) == len(texts) and sum(r[f"n_{kind}"] for r in rows for kind in kinds)
    order = list(kinds)
    for r in rows:
        found = [(kind, *m.span()) for kind, (pattern, fits) in kinds.items() for m in pattern.finditer(texts[r.doc_id] or "") if fits(m)]
        found.sort(key=lambda s: (s[1], order.index(s[0])))
        assert r.base_sha256 == sha(found)
        assert [r[f"n_{kind}"] for kind in kinds] == [sum(s[0] == kind for s in found) for kind in kinds]
        every = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert set(found) <= set(every) and every == sorted(every, key=lambda s: s[1])
        assert all(0 <= a < b <= len(texts[r.doc_id]) for _, a, b in every)


def test_op6(spark, folder, texts):
    types = {"held_out": "boolean", "base_score": "double", "score": "double", **dict.fromkeys(("doc_id", "n_tokens", "n_known", "train_tokens"), "bigint")}
    rows = result(spark, folder, "op6_context_mixing", **types)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.score < 0 for r in rows)


def test_op8(spark, folder, texts):
    rows = result(spark, folder, "op8_neighbour_vote", doc_id="bigint", held_out="boolean", score="double", predicted="int")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_votes_by_a_plain_search(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id", "quality AS label")
    model = neighbour_vote.train(docs, labels)
    model.vectors[1] = model.vectors[0]  # two labelled vectors that tie everywhere
    model.labels[:2] = 0, 1
    got = {r.doc_id: r.score for r in neighbour_vote.vote(docs, model).collect()}
    import pyarrow as pa

    for i in sorted(texts)[:60]:
        (shares,) = neighbour_vote.term_shares(pa.array([texts[i] or ""]))
        vector = model.project(shares)[0]
        near = sorted(((round(float(vector @ v), neighbour_vote.PLACES), label) for v, label in zip(model.vectors, model.labels, strict=True)), reverse=True)
        least = near[neighbour_vote.NEIGHBOURS - 1][0]
        votes = [(max(s, 0) ** neighbour_vote.SHARPNESS, label) for s, label in near if s >= least]
        total = sum(w for w, _ in votes)
        want = sum(w * label for w, label in votes) / total if total else model.prior
        assert got[i] == pytest.approx(want, abs=2e-3)
