import numpy as np
import pytest

from supplylake.llm import whitening
from supplylake.llm.whitening import leading_pairs, whiten_embeddings

SCHEMA = "vec_id long, embedding array<double>, component int, n string"


def table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, 7, "clash") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def whole(v):
    return np.floor(np.array(v, float) * 256).astype(np.int64)


def brute(vectors):
    x = np.array([whole(v) for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [i for i in range(min(4, len(values))) if values[i] > 1e-9 * max(values[0], 1e-300)]
    white = (n * x - sums) / n @ vectors[:, kept] / np.sqrt(values[kept])
    return n, ((n * x - sums).astype(object) ** 2).sum(axis=1), white, values[kept] / values.sum()


def compare(spark, vectors, tolerance=1e-9):
    got = whiten_embeddings(table(spark, [list(map(float, v)) for v in vectors])).toPandas()
    n, deviation, white, explained = brute(vectors)
    assert len(got) == len(vectors) * white.shape[1] and (got.n == n).all()
    assert (got.identity_error <= 1e-10).all() and got.identity_error.nunique() == 1
    signs = {}
    for r in got.itertuples():
        c = r.component - 1
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[c], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(white[r.vec_id, c]), rel=1e-6, abs=tolerance)
        if abs(r.whitened) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(r.whitened) == np.sign(white[r.vec_id, c]))
    assert all(len(s) == 1 for s in signs.values())


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((400, 24)) * np.linspace(2, 0.3, 24) + rng.standard_normal(24)
    vectors = np.vstack([vectors, vectors[:150], np.repeat(vectors[:1], 200, axis=0)])
    compare(spark, vectors)


def test_few_rows_and_dimensions(spark):
    compare(spark, [[1.0, 2.0], [3.0, 5.0], [0.5, -1.0], [3.0, 5.0]])
    compare(spark, [[1.0], [2.0]])
    compare(spark, [[1.0, 0, 0, 0, 0, 0], [0, 2.0, 0, 0, 0, 0], [0, 0, 3.5, 0, 0, 0]])


def test_far_mean_and_large_numbers(spark):
    rng = np.random.default_rng(5)
    compare(spark, rng.standard_normal((50, 5)) * np.array([5, 4, 3, 2, 1.0]) + 1e6, 1e-7)
    big = whiten_embeddings(table(spark, [[1e18, 0.0], [-1e18, 1.0], [0.0, float(2 ** 60)], [1e300, 1.0]]))
    assert {r.deviation for r in big.collect()} == {None}


def test_rows_that_do_not_count(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], None, [1.0, None], [nan, 1.0], [inf, 0.0], [], [4.0, 1.0], [2.0, 2.5], [1.0, 2.0, 3.0], [2.0, 2.5]]
    got = whiten_embeddings(table(spark, vectors, [1, 2, 3, 4, 5, 6, None, 8, 9, 8])).collect()
    assert sorted(((r.vec_id, r.component) for r in got), key=str) == sorted(
        [(i, c) for i in (1, None, 8, 8) for c in (1, 2)], key=str)
    assert {r.n for r in got} == {3}


def test_nothing_to_whiten(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for vectors in ([], [None], [[1.0, 2.0]] * 5):
        got = whiten_embeddings(spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate(vectors)], SCHEMA))
        assert got.columns == columns and got.count() == 0


def test_partial_sums_fold_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TO_DRIVER", 2)
    monkeypatch.setattr(whitening, "BLOCK", 16)
    rng = np.random.default_rng(9)
    monkeypatch.setattr(whitening, "scan_tasks", lambda df: 50)
    compare(spark, rng.standard_normal((120, 6)) * np.arange(1, 7))


@pytest.mark.parametrize("values", [
    np.r_[5.0, 4.999999, 4.99, 1.0, np.linspace(0.9, 0.1, 60)], np.r_[3.0, 3.0, 3.0, 3.0, 3.0, np.ones(40)],
    np.r_[1e6, 1.0, 1e-3, 1e-4, np.zeros(20)], np.r_[7.0, np.zeros(30)], np.zeros(12), 1.0 / np.arange(1, 300) ** 0.1])
def test_leading_pairs(values):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = turn * values @ turn.T
    passes = []

    def product(x):
        passes.append(x.shape[1])
        return matrix @ x
    got, vectors = leading_pairs(product, len(values), 4)
    want = np.sort(values)[::-1][:4]
    want = want[want > len(values) * 3e-16 * max(values.max(), 1e-300)]
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-12 * values.max())
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * got).max(initial=0) <= 1e-12 * max(values.max(), 1e-300)
    assert max(passes) <= 40
