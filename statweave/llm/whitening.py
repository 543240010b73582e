"""Embedding whitening by principal components.

1. Entries become integers, so that the sums per dimension are exact.
2. Every task centres its vectors at the rounded mean and adds up their
   products, exactly; Spark adds the tasks' matrices.  What the rounding of the
   mean left over is taken off in integers, so the covariance has one rounding
   only and does not depend on the order of the rows.
3. The covariance (dimension x dimension, whatever the number of rows) is
   reduced to tridiagonal form by Householder reflections; its leading
   eigenvalues are found by bisection on Sturm counts and their vectors by
   inverse iteration, reorthogonalised within clusters.
4. The components go to all tasks, which project their vectors.

Defined cases: rows without a vector, or with null or non-finite entries, take
no part and have no result; shorter vectors are filled up with entries 0;
entries beyond +-2^31 after scaling count as that; directions without variance
are no components, so a single row, or copies of one, give no rows, nor does an
empty table; null and repeated ids are carried through, row by row.  A
``deviation`` beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import dense, dimension, finite, scaled_floor

SCALE, OFFSET, LIMIT = 64, 1_000_000, 1 << 31
COMPONENTS = 32
# Rows multiplied at once; products of entries up to 2^20 then add up exactly
# in doubles.
BLOCK = 8192
SMALL = 1 << 20
EPS = np.finfo(float).eps
# Eigenvalues closer than this share of the norm form a cluster.
CLUSTER = 1e-3


# ---- the symmetric eigenproblem ------------------------------------------

def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Householder reduction: diagonal, off-diagonal and the reflections
    (unit vectors with the row they start at)."""
    a = a.copy()
    n = len(a)
    off, reflections = np.zeros(max(n - 1, 0)), []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0 or not np.any(v[1:]):
            off[k] = v[0]
            continue
        alpha = -np.copysign(norm, v[0])
        v[0] -= alpha
        v /= np.linalg.norm(v)
        off[k] = alpha
        # A - v w' - w v' on the trailing block.
        p = a[k + 1:, k + 1:] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
        reflections.append((k + 1, v))
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off, reflections


def sturm_counts(diag: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each ``x``."""
    tiny = EPS * EPS * max(1.0, np.abs(off).max(initial=0.0) ** 2)
    count, q = np.zeros(len(x), int), np.ones(len(x))
    for d, e in zip(diag, [0.0, *off]):
        q = d - x - e * e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection to rounding."""
    n = len(diag)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low = np.full(k, (diag - reach).min())
    high = np.full(k, (diag + reach).max())
    pad = EPS * max(abs(low[0]), abs(high[0])) * n
    low, high = low - pad, high + pad
    below = n - np.arange(1, k + 1)  # eigenvalues under the i-th largest
    while True:
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high)).all():
            return mid
        up = sturm_counts(diag, off, mid) <= below
        low, high = np.where(up, mid, low), np.where(up, high, mid)


def solve_shifted(diag: np.ndarray, off: np.ndarray, values: np.ndarray,
                  rhs: np.ndarray) -> np.ndarray:
    """Solve (T - value I) z = rhs for every value and its column of ``rhs``:
    elimination with row exchanges, all values at once."""
    n, tiny = len(diag), EPS * max(np.abs(diag).max(), np.abs(off).max(initial=0.0))
    tiny = tiny or np.finfo(float).tiny
    rhs = rhs.copy()
    main = np.empty((n, len(values)))  # the upper triangle: three diagonals
    second, third = np.zeros_like(main), np.zeros_like(main)
    p = diag[0] - values
    q = np.full(len(values), off[0] if n > 1 else 0.0)
    for i in range(n - 1):
        below = off[i]
        next_main = diag[i + 1] - values
        next_second = off[i + 1] if i + 2 < n else 0.0
        swap = np.abs(p) < abs(below)
        top = np.where(swap, below, np.where(np.abs(p) < tiny, tiny, p))
        main[i] = top
        second[i] = np.where(swap, next_main, q)
        third[i] = np.where(swap, next_second, 0.0)
        m = np.where(swap, p, below) / top
        b0, b1 = np.where(swap, rhs[i + 1], rhs[i]), np.where(swap, rhs[i], rhs[i + 1])
        rhs[i], rhs[i + 1] = b0, b1 - m * b0
        p = np.where(swap, q, next_main) - m * second[i]
        q = np.where(swap, 0.0, next_second) - m * third[i]
    main[n - 1] = np.where(np.abs(p) < tiny, tiny, p)
    for i in range(n - 1, -1, -1):
        got = rhs[i]
        if i + 1 < n:
            got = got - second[i] * rhs[i + 1]
        if i + 2 < n:
            got = got - third[i] * rhs[i + 2]
        rhs[i] = got / main[i]
    return rhs


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix; those of close
    values are kept orthogonal to each other."""
    n, k = len(diag), len(values)
    norm = max(np.abs(diag).max(), np.abs(off).max(initial=0.0)) or 1.0
    shifts = values.copy()
    first = np.arange(k)  # of each value's cluster
    for i in range(1, k):
        if values[i - 1] - values[i] < CLUSTER * norm:
            first[i] = first[i - 1]
        # Equal values need shifts of their own.
        shifts[i] = min(shifts[i], shifts[i - 1] - 10 * EPS * norm)
    z = np.random.default_rng(7).uniform(-1, 1, (n, k))
    for _ in range(6):
        z = solve_shifted(diag, off, shifts, z / np.abs(z).max(axis=0))
        z /= np.abs(z).max(axis=0)
        for i in range(k):
            for _ in range(2):
                before = z[:, first[i]:i]
                z[:, i] -= before @ (before.T @ z[:, i])
            z[:, i] /= np.linalg.norm(z[:, i])
    return z


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` largest eigenvalues, falling, and unit eigenvectors
    (columns) of a covariance; those without variance are left out."""
    k = min(k, len(v))
    if not k or not np.any(v):
        return np.zeros(0), np.zeros((len(v), 0))
    diag, off, reflections = tridiagonalise(v)
    values = leading_eigenvalues(diag, off, k)
    values = values[values > len(v) * EPS * values[0]]
    z = inverse_iteration(diag, off, values)
    for start, u in reversed(reflections):
        z[start:] -= 2 * np.outer(u, u @ z[start:])
    return values, z


# ---- over the table --------------------------------------------------------

def _sum_by_place(df: DataFrame, partial, kind: str) -> dict[tuple[int, int], object]:
    """Sum of the (i, j, value) that ``partial`` makes of each task's batches;
    one row a place comes back, whatever the number of rows of ``df``."""
    rows = (df.mapInArrow(partial, f"i int, j int, value {kind}")
            .groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow().to_pylist())
    return {(r["i"], r["j"]): r["value"] for r in rows}


def _places(entries: dict[tuple[int, int], object], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in entries], pa.int32()), pa.array([j for _, j in entries], pa.int32()),
         pa.array(list(entries.values()), kind)], names=["i", "j", "value"])


EXACT = pa.decimal128(38, 0)


class Fit:
    """Exact sums, covariance and components of a table's vectors."""

    def __init__(self, vectors: DataFrame, column: str, components: int):
        dim = dimension(vectors, column)
        vectors = vectors.select(column)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(dim, np.int64), 0
            for b in batches:
                total += scaled_floor(dense(b.column(0), dim), SCALE, LIMIT).sum(axis=0)
                n += b.num_rows
            yield _places({(0, -1): Decimal(n)} | {(0, d): Decimal(int(s)) for d, s in enumerate(total)},
                          EXACT)

        got = _sum_by_place(vectors, sums, "decimal(38,0)") if dim else {}
        self.dim, self.n = dim, int(got.get((0, -1), 0))
        if not self.n:
            self.values, self.vectors, self.explained = np.zeros(0), np.zeros((dim, 0)), np.zeros(0)
            return
        plain = [int(got[0, d]) for d in range(dim)]
        n = self.n
        # The rounded mean of the scaled entries, and what is left of the sums.
        self.mean = mean = np.array([(2 * s + n) // (2 * n) for s in plain], np.int64)
        self.rest = [s - n * int(m) for s, m in zip(plain, mean)]

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((dim, dim), object)
            for b in batches:
                x = scaled_floor(dense(b.column(0), dim), SCALE, LIMIT) - mean
                large = np.abs(x).max(axis=1, initial=0) >= SMALL
                if large.any():
                    wide = x[large].astype(object)
                    total = total + wide.T @ wide
                    x = x[~large]
                for at in range(0, len(x), BLOCK):
                    part = x[at:at + BLOCK].astype(np.float64)
                    total = total + (part.T @ part).astype(np.int64)
            yield _places({(i, j): Decimal(int(total[i, j])) for i in range(dim) for j in range(i, dim)},
                          EXACT)

        second = _sum_by_place(vectors, products, "decimal(38,0)")
        v = np.empty((dim, dim))
        for (i, j), value in second.items():
            v[i, j] = v[j, i] = (n * int(value) - self.rest[i] * self.rest[j]) / (n * n)
        self.values, self.vectors = leading_components(v, components)
        self.explained = self.values / np.trace(v) if len(self.values) else self.values

    def projector(self):
        """Function of a list column -> (deviation, whitened matrix)."""
        n, dim, mean = self.n, self.dim, self.mean
        rest = self.rest
        shift = np.array([r / n for r in rest])
        matrix = self.vectors / np.sqrt(self.values)

        def project(column: pa.Array) -> tuple[list, np.ndarray]:
            x = scaled_floor(dense(column, dim), SCALE, LIMIT) - mean
            widest = n * int(np.abs(x).max(initial=0)) + max(map(abs, rest), default=0)
            if widest * widest * dim < 1 << 63:
                far = n * x - np.array(rest, np.int64)
                deviation = np.einsum("ij,ij->i", far, far).tolist()
            else:
                far = n * x.astype(object) - np.array(rest, object)
                deviation = [int(d) if d < 1 << 63 else None for d in (far * far).sum(axis=1)]
            return deviation, (x - shift) @ matrix
        return project


def whiten(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``rows`` with a finite vector, their vector replaced by ``deviation``
    (distance from the mean, times the number of rows, squared) and
    ``whitened`` (array of at most ``components`` doubles), and with the
    figures of the fit: ``n``, ``explained`` and ``identity_error``."""
    spark = rows.sparkSession
    rows = finite(rows, column)
    fit = Fit(rows, column, components)
    others = [c for c in rows.columns if c != column]
    # The fit grows with the dimension only.
    k = len(fit.values)
    kept = rows.select(*[f"`{c}`" for c in others], F.col(f"`{column}`").alias("_vector"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]),
                        "deviation long", "whitened array<double>"])
    if not k:
        empty = spark.createDataFrame([], schema)
        return empty.select("*", F.lit(fit.n).cast("long").alias("n"),
                            F.lit(None).cast("array<double>").alias("explained"),
                            F.lit(None).cast("double").alias("identity_error"))
    project = fit.projector()

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            z = project(b.column(0))[1]
            total += z.T @ z
            first += z.sum(axis=0)
        yield _places({(i, j): total[i, j] for i in range(k) for j in range(k)}
                      | {(-1, j): first[j] for j in range(k)}, pa.float64())

    got = _sum_by_place(kept.select("_vector"), moments, "double")
    mean = np.array([got[-1, j] for j in range(k)]) / fit.n
    cov = np.array([[got[i, j] for j in range(k)] for i in range(k)]) / fit.n - np.outer(mean, mean)
    error = float(np.abs(cov - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            deviation, z = project(b.column(b.num_columns - 1))
            offsets = np.arange(len(z) + 1, dtype=np.int32) * k
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(deviation, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()))],
                names=[*others, "deviation", "whitened"])

    return kept.mapInArrow(run, schema).select(
        "*", F.lit(fit.n).cast("long").alias("n"),
        F.array(*[F.lit(float(x)) for x in fit.explained]).alias("explained"),
        F.lit(error).alias("identity_error"))


def report(rows: DataFrame) -> DataFrame:
    """One row for each vector (vec_id, embedding) and component."""
    at = F.posexplode("whitened").alias("at", "whitened")
    return (whiten(rows.select("vec_id", "embedding")).select("vec_id", "n", "deviation", "explained",
                                                              "identity_error", at)
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                    "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"),
                    "identity_error"))
