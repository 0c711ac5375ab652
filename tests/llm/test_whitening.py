"""Whitening against a library eigensolver, and exact figures against Python integers."""

import numpy as np
import pytest

from tallyweave.llm import whitening as W


@pytest.mark.parametrize("kind", ["random", "pairs", "identity", "low rank", "diagonal", "clustered"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_components_solve_the_eigenproblem(n, kind):
    rng = np.random.default_rng(n)
    b = rng.standard_normal((n, n))
    q = np.linalg.qr(b)[0]
    a = {
        "random": b @ b.T,
        "pairs": q @ np.diag(np.repeat(np.arange(1.0, n // 2 + 2), 2)[:n]) @ q.T,
        "identity": 3.0 * np.eye(n),
        "low rank": b[:, : max(1, n // 3)] @ b[:, : max(1, n // 3)].T,
        "diagonal": np.diag(np.arange(n, dtype=float)),
        "clustered": q @ np.diag(1 + 1e-9 * np.arange(n)) @ q.T,
    }[kind]
    values, vectors = W.spectral_components(a)
    size = max(np.abs(a).max(), 1e-300) * n
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size
    assert np.abs(values - np.linalg.eigvalsh((a + a.T) / 2)[::-1]).max() < 1e-13 * size


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(1)
    b = rng.standard_normal((20, 20))
    a = b + b.T
    w, q = np.linalg.eigh(a)
    least = np.abs(w).min() / np.linalg.norm(a) / 2
    assert np.abs(W.polar_factor(a, least) - (q * np.sign(w)) @ q.T).max() < 1e-12


def expected(rows, components=4):
    usable = [(i, [float(c) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(c * 256)) for c in v] for _, v in usable])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    cov = c.T @ c / n
    w, q = np.linalg.eigh(cov)
    w, q = w[::-1][:components], q[:, ::-1][:, :components]
    white = (x - s / n) @ q / np.sqrt(w)
    far = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return [i for i, _ in usable], n, far, white, w / np.trace(cov)


def test_equals_library_eigenvectors(spark):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((8, 8))
    rows = [(i, (rng.standard_normal(8) @ mix).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(150)]  # a third are copies: they count once in the statistics
    rows += [(900, None), (901, [1.0] * 7 + [None]), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (904, []), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids, n, far, white, share = expected(rows)
    got = sorted(W.whiten_vectors(df.repartition(7)).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"], r["component"]))
    assert [r["vec_id"] for r in got] == [i for i in ids for _ in range(4)]
    assert {r["n"] for r in got} == {n} == {300}
    assert [r["deviation"] for r in got[::4]] == far
    mine = np.array([r["whitened"] for r in got]).reshape(-1, 4)
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * signs - white).max() < 1e-10
    assert np.abs(np.array([r["explained"] for r in got[:4]]) - share).max() < 1e-12
    assert all(r["identity_error"] < 1e-10 for r in got)


def test_short_vectors_and_no_variance(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    got = W.whiten_vectors(df).collect()
    assert len(got) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {
        (1, 0, None, None, None)
    }
    flat = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = W.whiten_vectors(flat).collect()
    assert {(r["component"], r["whitened"] is None, round(r["explained"], 9)) for r in got} == {(1, False, 1.0), (2, True, 0.0)}


def test_rows_of_another_length_and_clashing_columns(spark):
    rows = [(i, [float(i), float(i * i)], i, "c") for i in range(6)] + [(9, [1.0], 9, "c"), (10, [1.0, 2.0, 3.0], 9, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, component string")
    assert {r["vec_id"] for r in W.whiten_vectors(df).collect()} == set(range(6))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    out = W.whiten_vectors(df)
    assert out.collect() == [] and "identity_error" in out.columns


def test_deviation_is_exact_beyond_double_precision():
    x = np.array([[10**9, -(10**9) + 1], [3, 4]])
    sums = (7 * 10**9 + 1, -5)
    assert W.deviations(x, 10**6, sums) == [sum((10**6 * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
