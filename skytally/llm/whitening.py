"""Whitening of vectors by their principal components, found by spectral divide and conquer.

Entries are taken on a grid: x = floor(scale * c) + offset, whole numbers.  The fit list is each distinct x
vector once, written once.  Whole-number sums give the mean; a second pass gives the covariance, centred
before multiplying, as sums per task that Spark adds up.  So the driver holds D x D numbers, D the length of
a vector, however many rows there are.

Eigenvectors: the polar factor U of the covariance less a shift, by QR-based dynamically weighted Halley
iterations (QDWH; Nakatsukasa and Higham 2013), gives the projector (U + I) / 2 on the components
above the shift.  Orthonormal bases of it and of its complement split the covariance in two blocks, which
are split again, only as far as the components asked for need it.  A block that is a multiple of the
identity to rounding is not split: any basis of it will do.  Mean and components, 17 x D numbers, go to
every task, which whitens its rows.

Null vectors and vectors with null or non-finite entries are dropped, and so are those with an entry
whose x is beyond 2**52, where a double no longer tells whole numbers apart, and vectors of another length
than most rows have (of equally frequent lengths the greatest).  Repeated rows and ids give repeated result
rows but count once in the fit list, as do vectors that fall on the same x.  Components without variance
(a constant dimension, fewer distinct vectors than dimensions, one vector alone) are not returned, nor are
more than D.  An empty table gives an empty result.  Null ids stay null; other columns are not looked at.
Equal eigenvalues share a subspace, in which the basis is arbitrary but the same for all rows.  A deviation
that no long can hold is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import stored

#: Variance, as a share of the greatest, below which a component is rounding.
LEAST_SHARE = 1e-12


# --- eigenvectors ---------------------------------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QDWH."""
    n = len(a)
    x = a / np.linalg.norm(a)
    # A lower bound of the least singular value of x.
    r = np.linalg.qr(x, mode="r")
    low = np.abs(np.diag(r)).min()
    low = 1 / np.linalg.norm(np.linalg.inv(r)) if low > 1e-300 else 0.0
    low = min(max(low, 1e-16), 1.0)
    eye = np.eye(n)
    for _ in range(30):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        p = np.sqrt(1 + d)
        wa = p + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low**2) / (low**2 * p), 0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        low = min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved < 1e-8 and 1 - low < 1e-8:
            break
    return 1.5 * x - 0.5 * x @ (x.T @ x)


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement."""
    n = len(projector)
    start = np.random.default_rng(1).standard_normal((n, rank))
    q, _ = np.linalg.qr(projector @ start)
    q, _ = np.linalg.qr(projector @ q)
    whole, _ = np.linalg.qr(np.hstack([q, np.eye(n)]))
    rest, _ = np.linalg.qr((np.eye(n) - q @ q.T) @ whole[:, rank:n])
    return q, rest


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the subspaces with greater and with smaller eigenvalues; None if all are equal."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    # The mean lies between the least and the greatest eigenvalue; the median halves the work.
    shifts = [np.median(np.diag(a)), mean, *(mean + spread * f for f in (0.0371, -0.0613, 0.1717, -0.2939, 0.5))]
    for shift in shifts:
        u = polar(a - shift * np.eye(n))
        projector = (u + u.T) / 4 + np.eye(n) / 2
        rank = round(np.trace(projector))
        if not 0 < rank < n:
            continue
        up, down = _bases(projector, rank)
        if np.linalg.norm(up.T @ a @ down) <= 1e-13 * max(np.linalg.norm(a), 1e-300) * n:
            return up, down
    return None


def components(a: np.ndarray, k: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a symmetric matrix, falling, and their eigenvectors as columns."""
    n = len(a)
    k = n if k is None else min(k, n)
    size = np.linalg.norm(a)
    found: list[np.ndarray] = []
    stack = [np.eye(n)]
    while stack and sum(b.shape[1] for b in found) < k:
        basis = stack.pop()
        block = basis.T @ a @ basis
        block = (block + block.T) / 2
        m = len(block)
        flat = np.linalg.norm(block - np.trace(block) / m * np.eye(m)) <= 1e-15 * size * m
        parts = None if m == 1 or flat else _split(block)
        if parts is None:
            found.append(basis)
        else:
            stack += [basis @ parts[1], basis @ parts[0]]
    vectors, _ = np.linalg.qr(np.hstack(found) if found else np.zeros((n, 0)))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], vectors[:, order]


# --- over the rows --------------------------------------------------------------------------------------


def on_grid(rows: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    c = F.transform(F.col(vector), lambda e: e.cast("double"))
    # A comparison with NaN, an infinity or null is not true of what is kept.
    usable = F.forall("c", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e * scale) + abs(offset) < float(1 << 52)), F.lit(False)))
    rows = rows.select(F.col(vec_id).alias("vec_id"), c.alias("c")).filter(F.col("c").isNotNull()).filter(usable)
    x = F.transform("c", lambda e: F.floor(e * scale).cast("long") + F.lit(offset).cast("long"))
    return rows.select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum of ``of``(x vectors) over all rows: added up in each task, then by Spark entry by entry."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = of(_matrix(batch.column(0)))
                total = now if total is None else total + now
        if total is not None:
            place = pa.array(np.arange(total.size))
            yield pa.RecordBatch.from_arrays([place, pa.array(total.reshape(-1))], ["place", "value"])

    sums = rows.select("x").mapInArrow(part, f"place long, value {kind}")
    found = sums.groupBy("place").agg(F.sum("value").alias("value")).toPandas().sort_values("place")
    return found["value"].to_numpy()


def whiten(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component."""
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    grid = on_grid(rows, vec_id, vector, scale, offset)
    lengths = grid.groupBy(F.size("x").alias("d")).count().filter("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    grid = grid.filter(F.size("x") == d)
    fit = stored(grid.select("x").distinct(), "whitening-fit")
    first = _summed(fit, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), "long")
    n, sums = int(first[0]), [int(s) for s in first[1:]]
    mean = np.array([float(Fraction(s, n)) for s in sums])

    def squares(x: np.ndarray) -> np.ndarray:
        y = x - mean
        return y.T @ y

    covariance = _summed(fit, squares, "double").reshape(d, d) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = components(covariance, k)
    kept = values > LEAST_SHARE * max(values.max(initial=0), np.finfo(float).tiny)
    values, vectors = values[kept], vectors[:, kept]
    if not len(values):
        return spark.createDataFrame([], schema)
    explained = values / np.trace(covariance)
    project = vectors / np.sqrt(values)
    # What rounding the mean to doubles leaves of the whitened mean.
    left = np.array([float(Fraction(s, n) - Fraction(m)) for s, m in zip(sums, mean)]) @ project

    def whitened_squares(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ project - left
        return w.T @ w

    identity = _summed(fit, whitened_squares, "double").reshape(len(values), len(values)) / n
    error = float(np.abs(identity - np.eye(len(values))).max())
    m = len(values)
    total = np.array(sums, dtype=object)

    def deviations(x: np.ndarray) -> pa.Array:
        far = max(abs(n * int(x.max()) - min(sums)), abs(n * int(x.min()) - max(sums)))
        if far < (1 << 62) and far * far * d < (1 << 63):
            y = n * x - np.array(sums, np.int64)
            return pa.array((y * y).sum(axis=1))
        exact = ((n * x.astype(object) - total) ** 2).sum(axis=1)
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                ids, x = batch.column(0).slice(at, 4096), _matrix(batch.column(1).slice(at, 4096))
                again = pa.array(np.repeat(np.arange(len(x)), m))
                columns = [
                    ids.take(again),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * m, n)),
                    deviations(x).take(again),
                    pa.array(((x - mean) @ project).reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * m, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return grid.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(apply, schema)
