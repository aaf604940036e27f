"""Whitening of vectors: exact sums, covariance, eigenvectors refined from single precision, and the measured result."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import arrow_schema, map_batches

#: A component becomes the long floor(SCALE * component) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Rows of an Arrow batch that are worked on at a time.
STEP = 4096
#: Eigenvalues below this part of the largest count as zero: nothing can be divided by them.
FLAT = 1e-13
#: Refining ends when eigenvectors move less than this, or after ROUNDS steps.
CLOSE, ROUNDS = 1e-17, 12
#: Values nearer than this, for a largest entry of one, belong to one cluster: single precision mixes their vectors.
CLUSTER = 1e-4


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, not finite, or too large for a whole number of 53 bits."""
    most = float(2**52) / SCALE
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < most)), F.lit(False))


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of an Arrow column as whole numbers; shorter ones have zeros behind."""
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.values.cast(pa.float64()))
    widths = np.diff(offsets)
    if (widths == dims).all():
        values = flat[offsets[0] : offsets[-1]].reshape(-1, dims)
    else:
        values = np.zeros((len(widths), dims))
        for i, w in enumerate(widths):
            values[i, :w] = flat[offsets[i] : offsets[i + 1]]
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def _parts(batches: Iterator[pa.RecordBatch], at: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, STEP):
            part = batch.slice(start, STEP)
            yield part, _whole(part.column(at), dims)


@dataclass(frozen=True)
class Whitener:
    """``sums`` are the exact sums of the ``n`` fitted vectors per dimension.  ``vectors`` has a unit eigenvector of their
    covariance per column, by falling ``values``; ``trace`` is the sum of all eigenvalues."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def middle(self) -> np.ndarray:
        """Whole numbers next below the means: differences from them are exact."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def project(self, near: np.ndarray, k: int) -> np.ndarray:
        """Whitened values of rows less ``middle``; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values[:k] > 0, 1 / np.sqrt(self.values[:k]), np.nan)
        return (near - self.rest / self.n) @ self.vectors[:, :k] * scale


def _steps(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) after steps of Ogita and Aishima from ``x``; ``v`` has entries of at most one.

    With R = I - X'X and S = X'VX the eigenvalues are S_ii / (1 - R_ii), and X moves by XE, where
    E_ij = (S_ij + value_j R_ij) / (value_j - value_i), or R_ij / 2 if the two values are CLUSTER or less apart.  Each step
    about squares the error.  The vectors of a cluster come out orthogonal and span the right space, but turned inside it.
    """
    eye = np.eye(len(v), dtype=np.longdouble)
    for _ in range(ROUNDS):
        r, s = eye - x.T @ x, x.T @ (v @ x)
        values = np.diag(s) / (1 - np.diag(r))
        gaps = values[None, :] - values[:, None]
        close = np.abs(gaps) <= CLUSTER
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gaps))
        x = x + x @ e
        if np.abs(e).max() < CLOSE:
            break
    return values, x


def _solve(v: np.ndarray, noise: float) -> np.ndarray:
    """Orthogonal eigenvectors of a symmetric matrix in extended precision, by falling value; ``noise``: what its entries may be off."""
    scale = np.abs(v).max()
    if scale <= noise:
        return np.eye(len(v), dtype=np.longdouble)  # all directions are alike
    v = v / scale
    values, x = _steps(v, np.linalg.eigh(v.astype(np.float32))[1][:, ::-1].astype(np.longdouble))
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    for c in np.split(np.arange(len(values)), np.flatnonzero(values[:-1] - values[1:] > CLUSTER) + 1):
        if 1 < len(c) < len(v):
            part = x[:, c]
            inner = part.T @ (v @ part) - values[c].mean() * np.eye(len(c), dtype=np.longdouble)
            x[:, c] = part @ _solve((inner + inner.T) / 2, noise / scale)
    return x + x @ (np.eye(len(v), dtype=np.longdouble) - x.T @ x) / 2


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, to double precision.

    Eigenvectors in single precision are refined by matrix products in extended precision.  For each cluster of values that
    single precision cannot tell apart the problem is solved again inside the span of its vectors, less the middle of its
    values and scaled, so that the small differences get all digits; clusters inside of it likewise.  The largest entry of
    each vector is positive.
    """
    v = v.astype(np.longdouble)
    x = _solve(v, 64 * float(np.finfo(np.longdouble).eps) * float(np.abs(v).max()))
    values = ((v @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(v))] < 0, -1, 1)
    return values.astype(np.float64), x.astype(np.float64)


def _vectors(df: DataFrame, vector_col: str) -> DataFrame:
    return df.filter(usable(F.col(vector_col))).select(F.col(vector_col).alias("v"))


def _total(df: DataFrame, rows, width: int) -> np.ndarray:
    """Sum over all rows of ``rows(whole numbers)`` (a list of ``width`` arrays of doubles per part), added up in tasks and by Spark."""
    schema = arrow_schema("at int, part array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, whole in _parts(batches, 0, width):
            part = rows(whole)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), schema[1].type)], schema=schema)

    found = map_batches(df, run, "at int, part array<double>")
    # One row per dimension and task, added up before they reach the driver.
    added = found.select("at", F.posexplode("part")).groupBy("at", "pos").agg(F.sum("col").alias("sum"))
    cells = added.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("pos", "sum"))).alias("row")).orderBy("at").collect()
    return np.array([[c["sum"] for c in r["row"]] for r in cells])


def fit(df: DataFrame, vector_col: str = "embedding") -> Whitener | None:
    """Fit on every usable vector; None if there is none, or all are empty.

    Sums are exact.  Moments are taken of the differences from whole numbers next to the means, which are exact, so products
    and sums below 2 ** 53 are exact too, in any order of the rows; what the true means add is taken off at the end.  Only
    matrices with a row and a column per dimension reach the driver.
    """
    vectors = _vectors(df, vector_col)
    n, dims = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    if not dims:
        return None
    schema = arrow_schema("at int, high long, low long")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for _, whole in _parts(batches, 0, dims):  # in two halves, so that no sum leaves 64 bits
            high += (whole >> 26).sum(axis=0)
            low += (whole & ((1 << 26) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(high), pa.array(low)], schema=schema)

    halves = map_batches(vectors, add, "at int, high long, low long").groupBy("at").agg(F.sum("high"), F.sum("low")).orderBy("at").collect()
    sums = tuple((high << 26) + low for _, high, low in halves)
    bare = Whitener(n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0)
    middle, off = bare.middle, bare.rest / n

    def moments(whole: np.ndarray) -> np.ndarray:
        near = (whole - middle).astype(np.float64)
        return near.T @ near

    v = _total(vectors, moments, dims) / n - np.outer(off, off)
    v = (v + v.T) / 2
    scale = max(float(np.abs(v).max()), 1e-300)
    values, x = eigen(v / scale)
    values = np.where(values > FLAT * max(values.max(), 0.0), values, 0.0) * scale
    return Whitener(n, sums, values, x, float(np.trace(v)))


def whiten(df: DataFrame, model: Whitener | None, k: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component up to ``k`` (or the number of dimensions): the id, ``component`` (from 1), ``n``,
    ``deviation`` (sum over dimensions of (n x - S) ** 2, exact), ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or hold null or non-finite components (or ones of 2 ** 42 and more) give no rows and are not
    fitted; shorter vectors have zeros behind; ids may be null, and repeated rows count and come out as often as they are
    there; other columns do not matter.  A component without variance has null for ``whitened`` and is left out of
    ``identity_error``; without any variance ``explained`` and ``identity_error`` are null.  No usable vector: no rows.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    k = min(k, model.dims)
    live = int((model.values[:k] > 0).sum())
    middle, rest, n = model.middle, model.rest, model.n

    def second(whole: np.ndarray) -> np.ndarray:
        w = model.project(whole - middle, live)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    error = None
    if live:
        found = _total(_vectors(df, vector_col), second, model.dims) / n
        error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(live)).max())
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values[:k]]
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole in _parts(batches, 1, model.dims):
            m = len(whole)
            near = whole - middle
            w = model.project(near, k).ravel()
            every = np.repeat(np.arange(m), k)
            columns = [
                part.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                _deviations(near, n, rest, arrow[3].type).take(pa.array(every)),
                pa.array(w, mask=np.isnan(w)), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return map_batches(df.filter(usable(F.col(vector_col))).select(id_col, F.col(vector_col).alias("v")), run, schema)


def _deviations(near: np.ndarray, n: int, rest: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Sum over dimensions of (n x - S) ** 2, exact; null beyond 38 digits."""
    if near.size and near.shape[1] * (float(np.abs(near).max() + 1) * n) ** 2 >= 2.0**62:  # 64 bits may not do
        sums = [sum(d * d for d in row) for row in near.astype(object) * n - rest]
        return pa.array([Decimal(d) if d < 10**38 else None for d in sums], kind)
    return pa.array(((near * n - rest) ** 2).sum(axis=1)).cast(kind)
