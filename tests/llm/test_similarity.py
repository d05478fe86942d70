"""N-gram join, decontamination and sharding against brute force."""

import random
import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import pytest

from searchlift.llm import decontaminate, histogram_sort, ngram_join
from searchlift.llm.graph import components


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(df).collect()), key=str)


def expected(rows):
    sets = {i: brute.shingle_set(t) for i, t in rows}
    comp = brute.components(sets)
    return sorted(((i, len(sets[i]), comp[i]) for i, _ in rows), key=str)


def near_copies(seed, groups, size, words=60, edits=3):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits + 1)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**9)}"
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rng.shuffle(rows)
    return rows


def test_join_on_small_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert joined(docs) == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_join_odd_rows(docs_of, odd):
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.jaccard_join(docs_of(odd)).collect()}
    named = [(i, t) for i, t in odd if i is not None]
    assert {r[:3] for r in rows if r[0] is not None} == set(expected(named))
    assert (None, 6, None, 0) in rows
    assert {r[3] for r in rows if r[0] in (9, 10)} == {1}  # two sets that link; copies of one set are no link
    assert joined(docs_of(odd[:0])) == []


@pytest.mark.parametrize("block", [16, 512])
def test_join_of_large_groups(docs_of, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(1, 3, 60) + [(i * 3 + 2, t) for i, t in near_copies(2, 20, 3, words=30, edits=2)]
    rows += [(900_000 + k, " ".join([*(f"u{k}x{j}" for j in range(12)), *(f"shared{j}" for j in range(50))])) for k in range(40)]
    assert joined(docs_of(rows)) == expected(rows)


def test_links_are_counted(docs_of):
    rows = near_copies(3, 2, 25)
    got = {r.doc_id: r.n_links for r in ngram_join.jaccard_join(docs_of(rows)).collect()}
    by_set = {}
    for i, t in sorted(rows):
        by_set.setdefault(frozenset(brute.shingle_set(t)), i)
    reps = {i: set(s) for s, i in by_set.items()}
    want = defaultdict(int)
    for a, b in brute.links(reps):
        want[a] += 1
        want[b] += 1
    assert got == {i: want[by_set[frozenset(brute.shingle_set(t))]] for i, t in rows}


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (200, None), (101, 100)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def contained(docs, items, **options):
    return sorted(tuple(r) for r in decontaminate.find_contained(docs, items, **options).collect())


def test_containment_on_small_tables(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    sets = [(r.item_id, brute.shingle_set(r.text)) for r in items.collect()]
    want = []
    for r in docs.select("doc_id", "text").collect():
        own = brute.shingle_set(r.text)
        want += [(r.doc_id, i, len(s), len(s & own)) for i, s in sets if s and 100 * len(s & own) >= 80 * len(s)]
    assert want and contained(docs, items) == sorted(want)
    assert contained(docs, items, broadcast_shingles=0) == sorted(want)


def test_containment_odd_rows(spark, docs_of, odd):
    passage = " ".join(f"item{k}" for k in range(25))
    edited = passage.replace("item12", "other")  # 16 of 21 shingles are left
    cut = " ".join(passage.split()[:21])  # 17 of 21 are left
    rows = [*odd, (20, f"before {passage} after"), (21, f"x {edited} y"), (22, f"x {cut} y"), (23, passage.upper()), (None, passage)]
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "one two three four"), (4, "one two three four")], "item_id long, text string")
    for bound in (10**6, 0):
        got = decontaminate.find_contained(docs_of(rows), items, broadcast_shingles=bound)
        found = sorted([(r.doc_id, r.item_id, r.n_shared) for r in got.collect()], key=str)
        # A repeated item is found as often as it stands in the list.
        assert found == sorted([(20, 1, 21), (22, 1, 17), (23, 1, 21), (None, 1, 21), *[(5, 4, 1), (6, 4, 1)] * 2], key=str)
    kept = decontaminate.without_contained(docs_of(rows), items)
    assert kept.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 7, 8, 8, 9, 10, 12, 21]
    assert contained(docs_of(rows[:0]), items) == [] == contained(docs_of(rows), items.where("item_id < 0"))


@pytest.mark.parametrize("bound", [10**6, 0])
def test_clean_rows_stay_beside_contaminated_ones(spark, docs_of, bound):
    passage = " ".join(f"item{k}" for k in range(25))
    clean = [(None, "a clean row without an id"), (None, None), (None, "another one"), (7, "the same id with another text"), (8, None), (9, "")]
    held = [(None, f"x {passage} y"), (7, passage), (8, passage.upper()), (7, passage)]
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = docs_of(clean + held)
    kept = decontaminate.clean_rows(docs, items, bound)
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(clean, key=str)


def test_the_pipeline_keeps_clean_rows_without_id(spark, docs_of, folder):
    item = next(r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if len(brute.words(r.text)) > 9)
    docs = docs_of([(None, item), (None, "a clean row without an id"), (3, item), (3, "a clean row with its id")])
    got = corpus_pipeline.benchmark(spark, docs, folder).collect()
    assert sorted(r.text for r in got) == ["a clean row with its id", "a clean row without an id"]


def shards(df, **options):
    out = defaultdict(list)
    for r in histogram_sort.shard_by_bytes(df, **options).collect():
        out[r.shard].append(r)
    return out


def test_shards_are_even_and_gapless(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = shards(docs)
    largest = max(len((r.text or "").encode()) + 1 for rows in out.values() for r in rows)
    sizes = [sum(r["size"] for r in out[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 2 * largest
    for rows in out.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert all(r["size"] == len((r.text or "").encode()) + 1 for r in rows)
    assert sum(map(len, out.values())) == docs.count()


def test_a_hot_text_is_cut_by_id(docs_of):
    rows = [(k, "the same text" if k % 3 else f"text {k}") for k in range(3000)]
    out = shards(docs_of(rows))
    sizes = [sum(r["size"] for r in out[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 30
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in out.values())
    # Equal texts are side by side: the shards that hold the hot one follow each other.
    holding = [k for k in range(8) if any(r.text == "the same text" for r in out[k])]
    assert holding == list(range(holding[0], holding[-1] + 1))


def test_shards_of_odd_rows(docs_of, odd):
    out = shards(docs_of(odd), shards=3)
    got = sorted(zlib.crc32((r.text or "").encode()) for v in out.values() for r in v)
    assert got == sorted(zlib.crc32((t or "").encode()) for _, t in odd)
    assert {r["size"] for v in out.values() for r in v if r.text is None} == {1}
    assert shards(docs_of(odd[:0])) == {}


def test_rows_without_id_and_with_one_text_are_dealt_over_shards(docs_of):
    """Two thirds of the rows are alike in text and have no doc_id; a unit of them is parted like any other rows."""
    rows = [(None, "the same text") if k % 3 else (k, f"text {k} " + "x" * (k % 50)) for k in range(3000)]
    rows += [(7, "a copy")] * 500
    out = shards(docs_of(rows).repartition(5))
    sizes = [sum(r["size"] for r in out[k]) for k in range(8)]
    largest = max(r["size"] for v in out.values() for r in v)
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 8 + 2 * largest
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in out.values())
    assert sorted(str((r.doc_id, r.text)) for v in out.values() for r in v) == sorted(str(r) for r in rows)
