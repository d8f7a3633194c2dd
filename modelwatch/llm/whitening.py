"""Whitening of embeddings by spectral divide and conquer.

Spark finds the distinct vectors, their sums and the centred covariance (one small matrix a task, added up by dimension).
The covariance has as many rows as a vector has entries, so it alone reaches the driver. There it is divided, not
diagonalised: the polar factor of the covariance less a shift, found by dynamically weighted Halley steps (QDWH), is a
matrix sign, half of it and the identity the projector on all components above the shift. Bases of the two ranges split
the covariance into two smaller ones, and so on until a component is alone. The components go back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.llm.common import pick, stage_table

#: Entries are kept within these bounds, so that sums of a task fit 64 bits.
MOST = 1 << 40
EPS = float(np.finfo(float).eps)


def polar_sign(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, which is its matrix sign; QDWH with QR steps, no inverses."""
    m = len(a)
    x = a / max(np.abs(a).sum(axis=0).max(), np.finfo(float).tiny)
    low, eye = EPS, np.eye(m)  # a bound from below on the singular values
    for _ in range(12):
        square = low * low
        d = (4 * (1 - square) / (square * square)) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        new = (new + new.T) / 2
        moved, x = np.abs(new - x).max(), new
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if 1 - low < 10 * EPS and moved < 1e-8:  # convergence is cubic
            break
    return x


def _halves(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Orthonormal columns: the first k span the components above some shift, the others those below it."""
    m = len(a)
    diagonal = np.diag(a)
    mean = diagonal.mean()
    spread = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    # The mean lies between the smallest and the largest eigenvalue; steps beside it, in case it is one.
    for shift in [np.median(diagonal), mean, *(mean + spread * t for t in (0.01, -0.01, 0.1, -0.1, 0.3, -0.3))]:
        p = (polar_sign(a - shift * np.eye(m)) + np.eye(m)) / 2
        k = round(float(np.trace(p)))
        if not 0 < k < m or np.abs(p @ p - p).max() > 1e-9:
            continue
        upper, lower = rng.standard_normal((m, k)), rng.standard_normal((m, m - k))
        for _ in range(2):
            upper, lower = np.linalg.qr(p @ upper)[0], np.linalg.qr(lower - p @ lower)[0]
        return np.linalg.qr(np.hstack([upper, lower]))[0], k
    raise ArithmeticError("no shift divides the spectrum")


def spectrum(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix (all, if None), falling, and unit eigenvectors as columns.

    Parts of the spectrum below those wanted are not divided any further. Eigenvalues that rounding cannot tell apart
    keep any orthonormal basis of their subspace.
    """
    a = (a + a.T) / 2
    m, rng = len(a), np.random.default_rng(1)
    most = m if most is None else min(most, m)
    scale = np.linalg.norm(a)
    values, vectors = [], []
    todo = [(a, np.eye(m))] if m else []
    while todo and len(values) < most:
        part, basis = todo.pop()
        k = len(part)
        if k == 1 or np.linalg.norm(part - np.diag(part).mean() * np.eye(k)) <= 4 * EPS * scale:
            order = np.argsort(-np.diag(part), kind="stable")
            values += list(np.diag(part)[order])
            vectors += list(basis[:, order].T)
            continue
        q, k = _halves(part, rng)
        for cut in (slice(k, None), slice(0, k)):  # the upper half is taken first
            inner = q[:, cut].T @ part @ q[:, cut]
            todo.append(((inner + inner.T) / 2, basis @ q[:, cut]))
    values, vectors = np.array(values), np.array(vectors).reshape(-1, m)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[order].T


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _total(rows: DataFrame, d: int, parts: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``parts(rows of a batch)``, a matrix; a task adds its batches up before anything moves."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = parts(_matrix(batch.column(0), d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(total)), pa.int32()), "part": pa.array(list(total))})

    kind, wide = ("bigint", "decimal(38,0)") if parts(np.zeros((0, d), np.int64)).dtype.kind == "i" else ("double", "double")
    width = parts(np.zeros((0, d), np.int64)).shape[1]
    parted = rows.mapInArrow(task, f"i int, part array<{kind}>")
    summed = parted.groupBy("i").agg(F.array(*[F.sum(F.col("part")[j].cast(wide)) for j in range(width)]).alias("total"))
    return np.array([row["total"] for row in sorted(summed.collect(), key=lambda r: r["i"])], dtype=object if wide[1] == "e" else float)


def whiten(rows: DataFrame, *, vec_id: str = "vec_id", vector: str = "vector", components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row, for its first components.

    ``vector`` is an array of integers. n, sums S and covariances (divisor n) are those of the distinct vectors;
    deviation is the exact sum of (n*x - S)^2 over the dimensions, null if 64 bits cannot hold it; whitened is x - S/n
    on the unit eigenvector, over the root of its eigenvalue; identity_error is measured on the distinct vectors.

    Rows whose vector is null or holds a null are dropped; a null vec_id is kept. Vectors must agree in length: those of
    another length than most distinct vectors (the longer, on a tie) are dropped, and so are empty ones. Repeated rows
    return as often as they come. Components without variance cannot be whitened and are left out, so that an empty
    table, or one distinct vector, gives no rows. Entries beyond 2^40 count as 2^40. Other columns are not looked at.
    """
    live = pick(rows, vec_id=vec_id, vector=vector).where(F.coalesce(~F.exists("vector", lambda x: x.isNull()), F.lit(False)))
    bounded = F.transform("vector", lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), x.cast("bigint"))))
    live = live.select("vec_id", bounded.alias("vector"))
    fit = stage_table(live.select("vector").distinct(), "whitening-fit")
    lengths = fit.groupBy(F.size("vector").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    schema = T.StructType(
        [rows.select(rows[vec_id].alias("vec_id")).schema[0]]
        + [T.StructField(name, kind()) for name, kind in (("component", T.IntegerType), ("n", T.LongType), ("deviation", T.LongType), ("whitened", T.DoubleType))]
    )
    if lengths is None:
        return _described(live.sparkSession.createDataFrame([], schema), np.zeros(0), 0.0)
    d, n = lengths["d"], lengths["count"]
    fit, live = fit.where(F.size("vector") == d), live.where(F.size("vector") == d)

    sums = [int(s) for s in _total(fit.select("vector"), d, lambda x: x.sum(axis=0, keepdims=True))[0]]
    base = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = np.array([float(b - Fraction(s, n)) for b, s in zip(base.tolist(), sums, strict=True)])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base) + rest  # the first difference is exact

    def products(x: np.ndarray) -> np.ndarray:
        x = centred(x)
        return x.T @ x

    covariance = _total(fit, d, products) / n
    trace = float(np.trace(covariance))
    values, vectors = spectrum(covariance, components)
    sure = values > trace * d * EPS
    values, vectors = values[sure], vectors[:, sure]
    scaled = vectors / np.sqrt(values)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = np.hstack([centred(x) @ scaled, np.ones((len(x), 1))])
        return w.T @ w

    error = 0.0
    if k:
        second = _total(fit, d, moments) / n
        error = float(np.abs(second[:k, :k] - np.outer(second[k, :k], second[k, :k]) - np.eye(k)).max())
    largest = max(map(abs, sums))

    def deviations(x: np.ndarray) -> pa.Array:
        most = n * int(np.abs(x).max(initial=0)) + largest
        if d * most * most < 1 << 63:
            away = x * n - np.array(sums, np.int64)
            return pa.array((away * away).sum(axis=1))
        away = x.astype(object) * n - np.array(sums, object)
        exact = (away * away).sum(axis=1)
        return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if k else 0, 4096):
                part = batch.slice(start, 4096)
                x = _matrix(part.column(1), d)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, n, np.int64)),
                        deviations(x).take(each),
                        pa.array((centred(x) @ scaled).ravel()),
                    ],
                    names=schema.names,
                )

    return _described(live.mapInArrow(project, schema), values / trace if k else values, error)


def _described(rows: DataFrame, shares: np.ndarray, error: float) -> DataFrame:
    explained = F.array(*[F.lit(float(s)) for s in shares]).cast("array<double>")[F.col("component") - 1]
    return rows.withColumns({"explained": explained, "identity_error": F.lit(error)})
