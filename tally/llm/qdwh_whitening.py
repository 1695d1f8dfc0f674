"""Whitening of embeddings with components from QDWH spectral divide and conquer.

Vectors are quantised to whole numbers, and the fit list is each distinct
vector once. Three passes over it, each a sum that every task makes of its own
rows first: count and sums; the centred second moments; and, at the end, the
moments of the whitened vectors, which say how far they are from white. What
reaches the driver is numbers by dimension (d, and d x d), never rows.

The covariance is split on the driver. A shift between the least and the
largest eigenvalue is taken off it; the orthogonal polar factor of the result
(QDWH: dynamically weighted Halley steps by QR, which converge in six or
seven) has eigenvalues -1 and 1, so (factor + 1) / 2 projects on the
eigenvectors above the shift. Bases of its range and of the rest cut the
matrix into two smaller ones, and so on until each has one dimension or equal
eigenvalues. The components go out to the tasks (d numbers each), and one more
pass over all rows whitens them.

Shuffles: distinct vectors (equal ones are merged before it, so a hot vector
is one row a task), and the sums. Sums of whole numbers are exact.

Defined results: rows whose vector is null, or has null or non-finite entries,
are dropped, and so are rows of another length than most rows have (ties: the
longer; empty vectors always). Null ids and repeated rows stay and are
whitened alike. Components whose eigenvalue is nil (within rounding: fewer
distinct vectors than dimensions, or constant ones) have no direction and are
left out. An empty table gives an empty result; columns other than id and
vector are dropped. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged

SCALE = 256
SLICE_ROWS = 4096
EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix; None where it is singular to working precision."""
    size = len(a)
    norm = np.abs(a).sum(axis=0).max()  # no singular value is larger
    x = a / norm
    r = np.linalg.qr(x, mode="r")
    if np.abs(np.diag(r)).min() < 4 * EPS:
        return None
    low = 1 / np.linalg.norm(np.linalg.inv(r))  # no singular value is smaller
    eye = np.eye(size)
    for _ in range(30):
        d = np.cbrt(4 * (1 - low * low) / low**4) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        low = min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        moved = np.linalg.norm(new - x)
        x = (new + new.T) / 2
        if moved <= EPS ** (1 / 3) and 1 - low <= 10 * EPS:
            return x
    return None


def _split(a: np.ndarray, shift: float) -> tuple[float, np.ndarray, int] | None:
    """(what is left between the parts, basis with the upper part first, its dimension) for a shift."""
    factor = polar(a - shift * np.eye(len(a)))
    if factor is None:
        return None
    up = (factor + np.eye(len(a))) / 2
    k = int(round(np.trace(up)))
    if not 0 < k < len(a):
        return None
    mix = np.random.default_rng(len(a)).standard_normal(a.shape)
    upper, lower = mix[:, :k], mix[:, k:]
    for _ in range(2):  # the second time from an orthonormal start
        upper = np.linalg.qr(up @ upper)[0]
        lower = np.linalg.qr(lower - up @ lower)[0]
    basis = np.linalg.qr(np.hstack([upper, lower]))[0]
    return float(np.linalg.norm(basis[:, :k].T @ a @ basis[:, k:])), basis, k


def spectral_components(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit vectors as rows, by spectral divide and conquer."""
    scale = np.linalg.norm(cov)
    values, vectors = [], []

    def part(a: np.ndarray, basis: np.ndarray) -> None:
        mean = np.trace(a) / len(a)
        spread = np.linalg.norm(a - mean * np.eye(len(a)))
        if len(a) > 1 and spread > 2 * EPS * scale:
            step = spread / np.sqrt(len(a))  # the standard deviation of the eigenvalues
            best = None
            for at in (0, 0.25, -0.25, 0.6, -0.6, 0.1, -0.1):
                cut = _split(a, mean + at * step)
                if cut and (best is None or cut[0] < best[0]):
                    best = cut
                if best and best[0] <= 8 * EPS * scale:
                    break
            if best:
                _, turn, k = best
                for side in (turn[:, :k], turn[:, k:]):
                    block = side.T @ a @ side
                    part((block + block.T) / 2, basis @ side)
                return
        for j in range(len(a)):  # one dimension, or equal eigenvalues: any basis does
            values.append(a[j, j])
            vectors.append(basis[:, j])

    part((cov + cov.T) / 2, np.eye(len(cov)))
    order = np.argsort(-np.array(values), kind="stable")
    rows = np.array(vectors)[order]
    sign = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)])
    return np.array(values)[order], rows * np.where(sign == 0, 1, sign)[:, None]


def quantised(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows with whole, finite vectors; x in 256ths, rounded down."""
    vec = F.transform(vec_col, lambda c: c.cast("double"))
    sound = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).filter(sound)
    return kept.select(F.col(id_col).alias("id"), F.transform(vec, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def _matrix(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.flatten()).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def _slices(batches: Iterator[pa.RecordBatch], col: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(i, SLICE_ROWS)
            yield part, _matrix(part.column(col))


def _moments(rows: DataFrame, mean: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """Sum of outer products of the centred vectors (after ``turn``, if given): a matrix a task, added up by entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _slices(batches, 0):
            y = x - mean
            y = y if turn is None else y @ turn.T
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"])

    parts = rows.select("x").mapInArrow(partial, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    size = len(mean) if turn is None else len(turn)
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        out[r.i, r.j] = r.v
    return out


@dataclass
class Whitening:
    """A fitted whitening: rows of ``turn`` are components over the root of their eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    trace: float
    turn: np.ndarray
    identity_error: float

    def apply(self, rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
        """(id, x, deviation, whitened) of every row that counts; ``whitened`` has a number a component."""
        kind = rows.schema[id_col].dataType.simpleString()
        n, sums, mean, turn = self.n, self.sums, self.sums / max(self.n, 1), self.turn
        x = quantised(rows, id_col, vec_col).filter(F.size("x") == len(sums))

        def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, x in _slices(batches, 1):
                off = np.abs(x).max(axis=1).astype(float) * n + np.abs(sums).max().astype(float)
                if (off.max() ** 2 * len(sums)) < 2.0**62:
                    deviation = ((n * x - sums) ** 2).sum(axis=1).tolist()
                else:
                    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
                    deviation = [d if d < 1 << 63 else None for d in deviation]
                white = (x - mean) @ turn.T
                lists = pa.array(white.tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(deviation, pa.int64()), lists], ["id", "x", "deviation", "whitened"])

        return x.mapInArrow(whiten, f"id {kind}, x array<bigint>, deviation bigint, whitened array<double>").withColumnRenamed("id", id_col)

    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def fit_whitening(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int | None = None) -> Whitening:
    """Fit on each distinct vector once; ``components``: how many to keep at most (None: all that have a direction)."""
    x = quantised(rows, id_col, vec_col)
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        none = np.zeros(0)
        return Whitening(0, np.zeros(0, np.int64), none, 0.0, np.zeros((0, 0)), 0.0)
    fit = staged(x.filter(F.size("x") == lengths.d).groupBy("x").agg(F.lit(1).alias("one")).select("x"), "whitening-fit")
    d = lengths.d
    sums = np.zeros(d, np.int64)
    n = fit.count()
    for r in fit.select(F.posexplode("x").alias("j", "c")).groupBy("j").agg(F.sum("c").alias("s")).toLocalIterator():
        sums[r.j] = r.s
    mean = sums / n
    values, vectors = spectral_components(_moments(fit, mean) / n)
    trace = float(values.sum())
    real = int((values > d * EPS * max(values[0], 0)).sum()) if values[0] > 0 else 0
    keep = real if components is None else min(real, components)
    values, vectors = values[:keep], vectors[:keep]
    turn = vectors / np.sqrt(values)[:, None]
    error = 0.0
    if keep:
        error = float(np.abs(_moments(fit, mean, turn) / n - np.eye(keep)).max())
    return Whitening(n, sums, values, trace, turn, error)
