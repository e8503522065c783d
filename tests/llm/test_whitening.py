from __future__ import annotations

import numpy as np
import pytest

from pulsemark.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def matrices():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((40, 40))
    yield a @ a.T
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    yield q @ np.diag([5.0] * 6 + [2.0] * 4 + [2.0 + 1e-13] * 3 + [1.0] * 17) @ q.T
    yield np.diag(np.arange(12.0))
    yield np.eye(9) * 7
    yield np.zeros((5, 5))
    yield np.outer(np.ones(8), np.ones(8))
    yield np.array([[3.0, 1], [1, 3]])
    yield np.array([[4.0]])


@pytest.mark.parametrize("a", list(matrices()), ids=range(8))
def test_eigenvectors_of_separate_and_equal_values(a):
    values, vectors = whitening.eigen(a, 32)
    size = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(a))[::-1][:32], atol=1e-14 * size, rtol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size


def test_sturm_counts():
    d, e = np.array([2.0, 0, -1, 3]), np.array([1.0, 0, 0.5])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-3, 5, 33) + 0.01
    assert whitening.sturm_count(d, e, at).tolist() == [(values < x).sum() for x in at]


def brute(vectors, k=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, s, strict=True)) for row in x]
    return n, dev, c @ q / np.sqrt(e), e / np.trace(v)


def test_whitening_agrees_with_a_direct_solution(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.standard_normal((300, 40)) * np.linspace(3, 0.2, 40)).astype(np.float32)
    vectors[100:200] = vectors[100]  # a third is one vector
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [], 1), (902, [None] + [1.0] * 39, 1), (903, [float("nan")] * 40, 1),
           (904, [float("inf")] + [0.0] * 39, 1), (905, [1.0, 2.0], 1), (906, [3e38] * 40, 1)]
    got = whitening.whiten(spark.createDataFrame(rows + odd, SCHEMA).repartition(7)).toPandas()
    n, dev, white, share = brute(vectors)
    assert len(got) == 300 * 32 and set(got.vec_id) == set(range(300)) and set(got.n) == {n}
    got = got.sort_values(["vec_id", "component"])
    assert got.deviation.tolist() == np.repeat(dev, 32).tolist()
    table = got.whitened.to_numpy().reshape(300, 32)
    sign = np.sign((table * white).sum(axis=0))
    assert np.abs(table - white * sign).max() < 1e-9
    assert np.allclose(got.explained.to_numpy().reshape(300, 32), share, rtol=1e-10)
    error = got.identity_error.iloc[0]
    assert got.identity_error.nunique() == 1 and 0 <= error < 1e-9
    assert abs(error - np.abs(np.cov(table.T, bias=True) - np.eye(32)).max()) < 1e-9


def test_short_and_flat_vectors(spark):
    rows = [(i, [float(i % 5), 1.0, float(i % 5)], None) for i in range(20)] + [(None, [2.0, 1.0, 2.0], 1)] * 2
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert set(got.component) == {1} and len(got) == 22 and got.vec_id.isna().sum() == 2
    assert np.allclose(got.explained, 1) and got.identity_error.max() < 1e-12
    flat = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(4)], SCHEMA)
    assert whitening.whiten(flat).count() == 0
    assert whitening.whiten(flat.limit(0)).count() == 0


def test_extra_columns_and_large_deviations(spark):
    rows = [(i, [float(i) * 1e6, -float(i)], 1, i, "x", 2.0) for i in range(8)] + [(8, [1e9, 0.0], 1, 8, "x", 2.0)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA + ", n int, id string, whitened double")).toPandas()
    assert got.columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, dev, _, _ = brute([r[1] for r in rows])
    want = {i: d if d < 1 << 63 else None for i, d in enumerate(dev)}
    assert None in want.values()
    assert {r.vec_id: None if np.isnan(r.deviation) else True for r in got.itertuples()} == {i: None if d is None else True for i, d in want.items()}


def test_reruns_agree(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.standard_normal(20).tolist(), 1) for i in range(500)], SCHEMA).repartition(9, "vec_id")
    a, b = (whitening.whiten(df).orderBy("vec_id", "component").toPandas() for _ in range(2))
    assert a.equals(b)
