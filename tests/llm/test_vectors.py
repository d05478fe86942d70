"""Whitening and hard negatives of embedding vectors against brute force."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from searchlift.llm import hard_negatives, registry, whitening


def vectors_of(spark, rows):
    """Embeddings from (vec_id, vector, label), with columns named like those the operators use inside."""
    full = [(i, v, label, "x", 7, [1.0], 3) for i, v, label in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, key string, n int, vector array<double>, score int")


def integers(rows):
    good = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [i for i, _ in good], np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good])


def check_whitening(ids, x, found, model):
    """Holds rows {vec_id: (deviation, whitened)} against numpy's own eigenvectors."""
    n = len(x)
    z = x - x.mean(axis=0)
    cov = z.T @ z / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = len(model.eigenvalues)
    assert np.allclose(model.eigenvalues, values[:k], rtol=1e-9)
    assert np.allclose(model.explained, values[:k] / np.trace(cov), rtol=1e-9)
    assert np.allclose(model.components @ model.components.T, np.eye(k), atol=1e-12)
    assert np.allclose(cov @ model.components.T, model.components.T * model.eigenvalues, atol=1e-9 * values[0])
    assert model.identity_error < 1e-9
    sums = [int(s) for s in x.sum(axis=0)]
    for i, row in zip(ids, x, strict=True):
        assert found[i][0] == sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True))
    white = np.array([found[i][1] for i in ids])
    assert np.allclose(white, z @ (model.components.T / np.sqrt(model.eigenvalues)), atol=1e-9)
    assert np.allclose(white.T @ white / n, np.eye(k), atol=1e-9)


def whitened(df):
    model = whitening.fit(df)
    return model, {r.key: (r.deviation, r.whitened) for r in whitening.whiten(df, model).collect()}


def test_whitening_of_small_table(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    model, found = whitened(df)
    assert len(model.eigenvalues) == 32
    check_whitening(*integers(rows), found, model)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 6)) * [5, 1, 1, 0.5, 0, 2]
    base[:, 5] = np.floor(64 * base[:, 0]) / 64  # a dependent dimension beside a constant one
    rows = [(k, v.tolist(), 1) for k, v in enumerate(base)] + [(100 + k, base[0].tolist(), None) for k in range(20)]
    bad = [(200, None, 1), (201, [1.0, None, 2.0, 3.0, 4.0, 5.0], 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] * 6, 1)]
    other = [(204, [], 1), (205, [1.0, 2.0], 1)]
    model, found = whitened(vectors_of(spark, rows + bad + other))
    assert set(found) == {i for i, _, _ in rows}
    assert len(model.eigenvalues) == 4
    check_whitening(*integers(rows), found, model)


def test_whitening_without_directions(spark):
    empty = vectors_of(spark, [])
    assert whitening.fit(empty) is None and whitened(empty)[1] == {}
    model, found = whitened(vectors_of(spark, [(1, [0.5, 0.5], 1), (None, [0.5, 0.5], 1)]))
    assert len(model.eigenvalues) == 0 and found == {1: (0, []), None: (0, [])}


def test_whitening_of_far_values(spark):
    rows = [(k, [1e9 + k / 64, -1e9 * (k % 3)], 1) for k in range(50)]
    model, found = whitened(vectors_of(spark, rows))
    ids, x = integers(rows)
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    for i, row in zip(ids, x, strict=True):
        d = sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True))
        assert found[i][0] == (d if d < 2**63 else None)
    assert any(found[i][0] is None for i in ids)
    assert len(model.eigenvalues) == 1  # the other is below the share that rounding leaves certain


def test_registered_whitening(spark, folder):
    df = registry.QUERIES["op11_whitening"](spark, folder)
    kinds = {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint"}
    assert dict(df.dtypes) == kinds | dict.fromkeys(("whitened", "explained", "identity_error"), "double")
    rows = df.collect()
    n = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    assert len(rows) == 32 * n and {r.n for r in rows} == {n} and {r.component for r in rows} == set(range(1, 33))
    explained = [max(r.explained for r in rows if r.component == k) for k in range(1, 33)]
    assert explained == sorted(explained, reverse=True) and sum(explained) <= 1
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-4


def mined(df, step=5):
    rows = hard_negatives.mine(df, F.col("vec_id") % step == 0).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows)


def expected_negatives(rows, step=5):
    least = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or not all(c is not None and math.isfinite(c) for c in v):
            continue
        x = [math.floor(256 * c) for c in v]
        least[i] = min(least.get(i, (label, x)), (label, x))
    out = []
    for a, (label, x) in least.items():
        if a % step:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other == label) for i, (other, y) in least.items() if i != a)  # shorter ones end early
        for s, p, _ in [r for r in scored if r[2]][:5]:
            fit = [(n, -t) for t, n, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, k + 1, n, -s, t) for k, (n, t) in enumerate(fit[:3])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_negatives_of_clustered_vectors(spark, monkeypatch, small):
    rng = np.random.default_rng(5)
    if small:  # many rounds, deep trees, small blocks and cuts while hits are gathered
        for name, value in (("ROUND", 20), ("LEAF_ROWS", 8), ("SAMPLE", 150), ("FAN", 3), ("BLOCK_SCORES", 64), ("HITS", 30)):
            monkeypatch.setattr(hard_negatives, name, value)
    centres = rng.normal(size=(6, 8))
    rows = [(int(k), (centres[k % 6] + rng.normal(size=8) * 0.2).round(1).tolist(), int(rng.integers(0, 4))) for k in range(400)]
    rows += [(1000 + k, centres[0].round(1).tolist(), k % 2) for k in range(80)]  # a third of them alike, with ties
    assert mined(vectors_of(spark, rows)) == expected_negatives(rows)


def test_negatives_of_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (5, [0.9, 0.1], 1), (6, [0.7, 0.1], 2), (7, [0.7, 0.1], 2), (8, [0.6], 2), (9, [], 2), (10, [-1.0, 0.0], 1),
        (11, None, 1), (12, [None, 1.0], 1), (13, [float("nan"), 1.0], 2), (14, [float("-inf"), 0.0], 2), (None, [1.0, 0.0], 2), (15, [1.0, 0.0], None),
        (6, [0.7, 0.1], 2), (6, [0.8, 0.2], 2), (20, [0.0, 1.0], 3), (25, [], 1),
    ]
    found = mined(vectors_of(spark, rows))
    assert found == expected_negatives(rows) and found
    assert mined(vectors_of(spark, [])) == [] and mined(vectors_of(spark, rows[3:4])) == [] and mined(vectors_of(spark, rows[9:12])) == []
    with pytest.raises(ValueError):
        mined(vectors_of(spark, [(0, [1e15], 1), (1, [1e15], 1)]))
    far = [(k, [2.0**20 + k, -(2.0**19) * (k % 3)], k % 2) for k in range(30)]  # beyond what doubles hold exactly
    assert mined(vectors_of(spark, far)) == expected_negatives(far)


def test_registered_negatives(spark, folder):
    df = registry.QUERIES["op13_hard_negatives"](spark, folder)
    names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
    assert dict(df.dtypes) == dict.fromkeys(names, "bigint") | {"rank": "int"}
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    found = sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())
    assert found == expected_negatives(rows, 50)
