"""Whitening of embeddings by spectral divide and conquer.

The entries of a vector are brought to a grid of whole numbers, so sums are exact and equal vectors are equal. The
statistics are those of the distinct grid vectors: count, sums by dimension, and the covariance, summed in blocks by
the tasks. The driver sees sums alone (as many values as the square of the dimension).

Its eigenvectors come from QDWH polar decompositions: the polar factor U of the shifted matrix A - sI is its matrix
sign, so (U + I) / 2 projects on the invariant subspace of the eigenvalues above s, and I - (U + I) / 2 on the rest.
Both halves are split again until each is one dimension or a multiple of the identity. The components are broadcast
(a few values for each dimension) and every row is projected where it lies.

Handling: rows whose vector is null, empty, or holds a null or non-finite entry are dropped; so are rows whose vector
has another length than most rows (ties: the shorter), as they lie in another space. Repeated rows give equal results;
null ids stay null. An empty table gives no rows. A component without variance (its eigenvalue is not above rounding)
has a null ``whitened``; a trace of zero has null ``explained``. Other columns are passed over unless asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import staged

EPS = float(np.finfo("float64").eps)


def polar_factor(a: np.ndarray, least: float) -> np.ndarray:
    """Orthogonal polar factor of a square matrix by QR-based dynamically weighted Halley steps.

    ``least`` is a lower bound of the smallest singular value over the Frobenius norm. It only sets the weights: each
    step maps the singular values towards one, at most seven steps from 1e-16.
    """
    n = len(a)
    x = a / np.linalg.norm(a)
    low = min(max(least, EPS), 1.0)
    eye = np.eye(n)
    for _ in range(30):
        sq = low * low
        d = (4 * (1 - sq) / (sq * sq)) ** (1 / 3) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - sq) / (sq * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            qs, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * qs[:n] @ qs[n:].T
        else:
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        low = min(1.0, low * (wa + wb * sq) / (1 + wc * sq))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 10 * EPS and moved < 1e-8:
            break
    return x


def _shifts(a: np.ndarray):
    """Values strictly between the least and the largest eigenvalue: the median of the diagonal, its mean, and by them."""
    diagonal = np.diag(a)
    mean, spread = diagonal.mean(), np.linalg.norm(a - diagonal.mean() * np.eye(len(a)))
    median = float(np.median(diagonal))
    if diagonal.min() < median < diagonal.max():
        yield median
    yield mean
    for part in (1e-3, -1e-3, 1e-2, -1e-2, 1e-4, -1e-4, 1e-6, -1e-6):
        yield mean + part * spread / len(a)


def _divide(a: np.ndarray, scale: float, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal eigenvectors (columns) of a symmetric matrix; ``scale`` is the norm of the whole problem."""
    n = len(a)
    if n == 1 or np.linalg.norm(a - np.diag(a).mean() * np.eye(n)) <= 4 * EPS * scale:
        return np.eye(n)
    best = None
    for shift in _shifts(a):
        moved = a - shift * np.eye(n)
        norm = np.linalg.norm(moved)
        # The inverse bounds the smallest singular value; a shift on an eigenvalue is passed over.
        try:
            least = 1 / np.linalg.norm(np.linalg.inv(moved)) / norm
        except np.linalg.LinAlgError:
            continue
        if least < 1e-12:
            continue
        projector = (polar_factor(moved, least) + np.eye(n)) / 2
        k = int(round(float(np.trace(projector))))
        if not 0 < k < n:
            continue
        basis = projector @ rng.standard_normal((n, k))
        for _ in range(2):
            basis = projector @ np.linalg.qr(basis)[0]
        full = np.linalg.qr(basis, mode="complete")[0]
        coupling = np.linalg.norm(full[:, k:].T @ a @ full[:, :k])
        if best is None or coupling < best[0]:
            best = (coupling, full, k)
        if coupling <= 100 * EPS * scale:
            break
    if best is None:  # no shift parts the eigenvalues: they agree to rounding
        return np.eye(n)
    _, full, k = best
    halves = []
    for q in (full[:, :k], full[:, k:]):
        inner = q.T @ a @ q
        halves.append(q @ _divide((inner + inner.T) / 2, scale, rng))
    return np.hstack(halves)


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix, by falling eigenvalue."""
    a = (a + a.T) / 2
    vectors = _divide(a, float(np.linalg.norm(a)), np.random.default_rng(7))
    vectors = np.linalg.qr(vectors)[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Whitener:
    """Fitted statistics: ``sums`` are exact; column c of ``vectors`` is component c + 1."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def scales(self) -> np.ndarray:
        """Standard deviation of each component, NaN where there is no variance."""
        alive = self.values > 4 * EPS * len(self.sums) * self.trace
        return np.sqrt(np.where(alive, self.values, np.nan))


def on_grid(vector: Column, steps: int = 256) -> Column:
    """Whole numbers: each entry, as double, times ``steps`` and rounded down. Null if any entry is null or not finite."""
    entries = vector.cast("array<double>")
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size(entries) > 0)
    return F.when(whole, F.transform(entries, lambda c: F.floor(c * steps)))


def _grid_rows(rows: DataFrame, vector: str, keep: list[str], steps: int) -> tuple[DataFrame, int]:
    """``kept`` and ``x`` of the usable rows, and the dimension."""
    kept = [F.col(f"`{c}`") for c in keep]
    placed = rows.select(
        F.struct(*kept).alias("kept") if kept else F.lit(None).cast("int").alias("kept"), on_grid(F.col(f"`{vector}`"), steps).alias("x")
    ).where("x IS NOT NULL")
    # One row for each length of vector.
    lengths = placed.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    d = lengths["d"] if lengths else 0
    return placed.where(F.size("x") == d), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _summed(fit: DataFrame, d: int, center: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over the fit list of w w' with w = (x - center) weights."""
    k = weights.shape[1]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])

    def products(batches):
        total, seen = np.zeros((k, k)), False
        for batch in batches:
            if batch.num_rows:
                w = (_matrix(batch.column(0), d).astype("float64") - center) @ weights
                total += w.T @ w
                seen = True
        if seen:
            i, j = np.indices((k, k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], schema=schema
            )

    out = np.zeros((k, k))
    for r in fit.mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def fit_whitener(grid: DataFrame, d: int, components: int = 4) -> Whitener | None:
    """Statistics over the distinct vectors of column ``x`` (array of long, each of length ``d``); None without rows."""
    if d == 0:
        return None
    fit = staged(grid.select("x").distinct(), "fit-list")
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")
    )
    by_dimension = {r["i"]: r for r in sums.collect()}
    n, exact = by_dimension[0]["n"], tuple(int(by_dimension[i]["s"]) for i in range(d))
    center = np.array([s / n for s in exact])
    covariance = _summed(fit, d, center, np.eye(d)) / n
    values, vectors = spectral_components(covariance)
    m = min(components, d)
    found = Whitener(n, exact, values[:m], np.ascontiguousarray(vectors[:, :m]), float(np.trace(covariance)), None)
    alive = ~np.isnan(found.scales)
    if not alive.any():
        return found
    weights = found.vectors[:, alive] / found.scales[alive]
    error = np.abs(_summed(fit, d, center, weights) / n - np.eye(int(alive.sum()))).max()
    return Whitener(n, exact, found.values, found.vectors, found.trace, float(error))


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Exact sum over dimensions of (n x - S)^2 for each row, as Python integers."""
    widest = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums))
    if widest * widest * x.shape[1] < 1 << 63:
        moved = n * x - np.array(sums, dtype="int64")
        return np.einsum("ij,ij->i", moved, moved).tolist()
    return [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]


def whiten_vectors(
    rows: DataFrame, vector: str = "embedding", keep: list[str] | None = None, components: int = 4, steps: int = 256
) -> DataFrame:
    """One row for each usable row and component: ``keep`` columns, component, n, deviation, whitened, explained,
    identity_error.

    ``deviation`` is exact; beyond the range of a long it is null.
    """
    keep = ["vec_id"] if keep is None else keep
    grid, d = _grid_rows(rows, vector, keep, steps)
    model = fit_whitener(grid, d, components)
    kind = grid.schema["kept"].dataType.simpleString()
    schema = (
        f"kept {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )

    def project(batches):
        center = np.array([s / model.n for s in model.sums])
        m = len(model.values)
        weights = model.vectors / model.scales
        explained = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            white = (x.astype("float64") - center) @ weights
            far = [v if v < 1 << 63 else None for v in deviations(x, model.n, model.sums)]
            size = len(x) * m
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), m))),
                    pa.array(np.tile(np.arange(1, m + 1), len(x)), pa.int32()),
                    pa.array(np.full(size, model.n), pa.int64()),
                    pa.array([v for v in far for _ in range(m)], pa.int64()),
                    pa.array(white.ravel(), pa.float64(), mask=np.isnan(white.ravel())),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([model.identity_error] * size, pa.float64()),
                ],
                names=["kept", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    if model is None:
        out = grid.sparkSession.createDataFrame([], schema)
    else:
        out = grid.mapInArrow(project, schema)
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], *out.columns[1:])
