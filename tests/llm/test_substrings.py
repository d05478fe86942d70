"""Removal of repeated windows against brute force."""

import hashlib
import random

import brute
import pytest

from searchlift.llm import registry, substring_dedup


def kept(rows):
    """[(doc_id, n_words, n_removed, kept)] by a plain reading of the rule."""
    texts = [(i, brute.words(t, lower=False)) for i, t in rows]
    first = {}
    for i, w in texts:
        for k in range(len(w) - 12):
            if i is not None:
                run = tuple(w[k : k + 13])
                first[run] = min(first.get(run, i), i)
    out = []
    for i, w in texts:
        gone = {k + j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(13)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(df).collect()), key=str)


def test_odd_rows(docs_of, odd):
    rows = [*odd, (None, " ".join(f"a{k}" for k in range(20))), (50, " ".join(f"a{k}" for k in range(20))), (51, "x " + " ".join(f"a{k}" for k in range(13)))]
    rows += [(-5, " ".join(f"a{k}" for k in range(14))), (-(2**62), " ".join(f"a{k}" for k in range(6, 40))), (52, "A" + " ".join(f"a{k}" for k in range(13)))]
    assert found(docs_of(rows)) == kept(rows)
    assert found(docs_of(odd[:0])) == []
    assert found(docs_of(odd[:2])) == kept(odd[:2])


@pytest.mark.parametrize("small", [False, True])
def test_shared_passages(docs_of, monkeypatch, small):
    rng = random.Random(small)
    if small:  # many bundles and parts, and cells that hardly keep windows apart
        for name, value in (("BUNDLE_BYTES", 3000), ("PART_ENTRIES", 50), ("SPARE_BITS", -3)):
            monkeypatch.setattr(substring_dedup, name, value)
    passages = [[f"p{k}w{rng.randrange(50)}" for _ in range(60)] for k in range(6)]
    rows = []
    for k in range(400):
        words = [f"u{rng.randrange(5000)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            p = passages[0] if k % 3 == 0 else rng.choice(passages)  # one is in a third of all documents
            a = rng.randrange(40)
            at = rng.randrange(len(words) + 1)
            words[at:at] = p[a : a + rng.randrange(8, 60)]
        rows.append((rng.randrange(300), rng.choice([" ", "\n", " \t "]).join(words)))
    assert found(docs_of(rows)) == kept(rows)


def test_registered_query(spark, folder):
    df = registry.QUERIES["op12_substring_dedup"](spark, folder)
    assert df.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    digests = [(i, n, gone, hashlib.sha256(text.encode()).hexdigest()) for i, n, gone, text in kept(rows)]
    assert sorted(map(tuple, df.collect())) == sorted(digests) and sum(d[2] for d in digests)
