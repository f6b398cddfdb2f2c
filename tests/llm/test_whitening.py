"""Spectrum slicing against a library's eigenvalues, and the query against a plain computation."""

import numpy as np
import pytest

from driftledger.llm import whitening
from driftledger.llm.queries import QUERIES

RNG = np.random.default_rng(11)
MATRICES = {
    "random": np.cov(RNG.standard_normal((500, 64)).T * 8, bias=True),
    "deficient": np.cov(RNG.standard_normal((10, 64)).T * 8, bias=True),
    "equal": np.eye(40) * 3,
    "clusters": np.diag([5.0] * 10 + [5.0 + 1e-10] * 3 + [2.0] * 20 + [0.0] * 7),
    "one": np.array([[4.0]]),
    "zero": np.zeros((3, 3)),
    "rank one": np.ones((6, 6)),
    "spread": np.diag(np.r_[1e12, np.ones(63)]),
    "coupled": np.kron(np.eye(8), np.array([[2.0, 1.0], [1.0, 2.0]])),
}


@pytest.mark.parametrize("name", MATRICES)
def test_spectrum(name):
    v = MATRICES[name]
    values, vectors = whitening.spectrum(v, 32)
    want = np.linalg.eigvalsh(v)[::-1]
    scale = max(want[0], 1e-300)
    assert len(values) == min(32, (want > 64 * 2.3e-16 * len(v) * scale).sum())
    assert np.allclose(values, want[: len(values)], rtol=0, atol=1e-13 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-11 * scale)


def test_inertia_counts():
    for seed in range(40):
        rng = np.random.default_rng(seed)
        a = rng.standard_normal((12, 12))
        a = a + a.T
        if seed % 2:
            np.fill_diagonal(a, 0)  # pivots of two
        for shift in rng.standard_normal(6) * 4:
            assert whitening.inertia(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def expected(vectors, k):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    exact = [[n * int(c) - int(s) for c, s in zip(row, x.sum(axis=0))] for row in x]
    return n, [sum(d * d for d in row) for row in exact], centred @ q / np.sqrt(e), e / (centred**2).sum() * n


def compare(rows, vectors, ids, k):
    n, deviation, white, explained = expected(vectors, k)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by_id) == sorted(ids) and all(sorted(c) == list(range(1, k + 1)) for c in by_id.values())
    got = np.array([[by_id[i][c].whitened for c in range(1, k + 1)] for i in ids])
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got * signs, white, atol=1e-7)
    for i, d in zip(ids, deviation):
        assert {(r.n, r.deviation) for r in by_id[i].values()} == {(n, d)}
        assert np.allclose([by_id[i][c].explained for c in range(1, k + 1)], explained, rtol=1e-9)
    error = {r.identity_error for r in rows}
    assert len(error) == 1 and 0 <= error.pop() < 1e-9


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    good = (rng.standard_normal((60, 5)) @ np.diag([5, 3, 2, 1, 0.5])).astype(np.float32)
    rows = [(k, v.tolist(), "x", 0) for k, v in enumerate(good)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [-inf] * 5, [1.0] * 4, [1.0] * 6]
    rows += [(100 + k, v, "x", 0) for k, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, n int").repartition(4)
    compare(whitening.whitened(table).collect(), good, list(range(60)), 5)
    compare(whitening.whitened(table, 2).collect(), good, list(range(60)), 2)
    none = whitening.whitened(table.limit(0))
    assert none.count() == 0 and none.columns == whitening.whitened(table).columns


def test_copies_and_no_spread(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(k % 3, [0.5, 0.25]) for k in range(9)], schema)
    assert whitening.whitened(same).count() == 0  # no component has any variance
    rows = [(1, [0.5, 0.0]), (1, [0.5, 0.0]), (None, [0.0, 0.0]), (2, [0.0, 1.0])]
    got = whitening.whitened(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 2 and {r.n for r in got} == {4}
    line = whitening.whitened(spark.createDataFrame([(k, [k / 4, k / 2]) for k in range(8)], schema)).collect()
    assert {r.component for r in line} == {1}  # two dimensions, one of them dependent


def test_deviation_beyond_a_long(spark):
    schema = "vec_id long, embedding array<double>"
    got = whitening.whitened(spark.createDataFrame([(1, [1e9]), (2, [-1e9]), (3, [0.0])], schema)).collect()
    assert {(r.vec_id, r.deviation) for r in got} == {(1, None), (2, None), (3, 0)}


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    compare(QUERIES["op13_whitening"](spark, sf_dir).collect(), [r.embedding for r in rows], [r.vec_id for r in rows], 32)
