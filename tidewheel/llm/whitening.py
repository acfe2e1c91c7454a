"""Whitening of embeddings: leading components of their covariance, and every vector projected on them.

A component c becomes the integer floor(scale * c) + offset, so sums over any number of rows are exact. The
covariance is centred before multiplying: each task takes n * x - S, an exact integer, divides by n and adds up
products; the tasks' sums (width x width each) are added row by row. The driver holds that matrix alone, its size set
by the width: Householder reflections bring it to tridiagonal form, Sturm counts and bisection give the leading
eigenvalues, inverse iteration their vectors, those of close eigenvalues made orthogonal to each other. The
components go to the tasks with the projection.

Rows whose vector is null or holds null or non-finite entries take no part; shorter vectors count as ending in zeros.
Equal rows, equal ids and null ids are rows of their own. Directions without variance (e within rounding of zero, as
when there are fewer rows than dimensions, or all are equal) are no components to scale by: their whitened value is
null, their share 0. Empty tables give no rows; other columns play no part. Entries beyond 2**40 are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import tasks, written

SCALE, OFFSET, COMPONENTS = 64.0, 1_000_000, 32
#: Rows multiplied at a time.
_ROWS = 4096
EPS = np.finfo(np.float64).eps


# --- eigenvectors of a symmetric matrix ---------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflections): a = Q T Q', Q the product of the reflections I - 2 v v'."""
    a, n, mirrors = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        norm = np.sqrt(x @ x)
        if norm == 0 or not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += norm if x[0] >= 0 else -norm
        v /= np.sqrt(v @ v)
        own = a[k + 1 :, k + 1 :]
        p = own @ v
        w = p - (v @ p) * v
        own -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -norm if x[0] >= 0 else norm
        a[k + 2 :, k] = a[k, k + 2 :] = 0
        mirrors.append((k + 1, v))
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), mirrors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are less than each of at: the signs of its Sturm sequence."""
    tiny = np.finfo(np.float64).tiny / EPS
    d = diagonal[0] - at
    count = (d < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        d = np.where(np.abs(d) < tiny, -tiny, d)
        d = diagonal[k] - at - off[k - 1] ** 2 / d
        count += d < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until its bounds are neighbours."""
    n, edge = len(diagonal), np.concatenate([[0.0], np.abs(off), [0.0]])
    reach = edge[:-1] + edge[1:]
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    pad = 2 * EPS * max(np.abs(low[0]), np.abs(high[0])) + np.finfo(np.float64).tiny
    low, high, rank = low - pad, high + pad, n - np.arange(k)  # the j-th largest: fewer than n - j + 1 lie below it
    while True:
        mid = (low + high) / 2
        if np.all((mid <= low) | (mid >= high)):
            return mid
        under = below(diagonal, off, mid) < rank
        inside = (mid > low) & (mid < high)
        low, high = np.where(inside & under, mid, low), np.where(inside & ~under, mid, high)


def _factors(diagonal: np.ndarray, off: np.ndarray, value: float) -> list[tuple]:
    """LU of T - value I with row exchanges: the rows of U, and the multiplier and exchange of each step."""
    n, least = len(diagonal), EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(np.float64).tiny)
    out, u, v = [], diagonal[0] - value, off[0] if n > 1 else 0.0
    for k in range(n - 1):
        b, d, c = off[k], diagonal[k + 1] - value, off[k + 1] if k + 2 < n else 0.0
        if abs(b) > abs(u):
            m = u / b
            out.append((b, d, c, m, True))
            u, v = v - m * d, -m * c
        else:
            u = u if abs(u) > least else least
            m = b / u
            out.append((u, v, 0.0, m, False))
            u, v = d - m * v, c
    out.append((u if abs(u) > least else least, 0.0, 0.0, 0.0, False))
    return out


def _solve(factors: list[tuple], y: np.ndarray) -> np.ndarray:
    y, n = y.copy(), len(factors)
    for k in range(n - 1):
        if factors[k][4]:
            y[k], y[k + 1] = y[k + 1], y[k]
        y[k + 1] -= factors[k][3] * y[k]
    for k in range(n - 1, -1, -1):
        u, v, w = factors[k][:3]
        y[k] = (y[k] - (v * y[k + 1] if k + 1 < n else 0.0) - (w * y[k + 2] if k + 2 < n else 0.0)) / u
    return y


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A unit vector by column for each value (falling); those of a cluster of values are made orthogonal each round."""
    n, norm = len(diagonal), max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0))
    out, start, at = np.zeros((n, len(values))), np.random.default_rng(1), 0
    shift = values.copy()
    for j in range(len(values)):
        if j:  # equal shifts would give equal vectors
            shift[j] = min(shift[j], shift[j - 1] - 4 * EPS * norm)
            if values[j - 1] - values[j] > 1e-3 * norm:
                at = j  # a cluster begins
        out[:, j] = _settled(_factors(diagonal, off, shift[j]), start.standard_normal(n), out[:, at:j], rounds)
    return out


def _settled(factors: list[tuple], y: np.ndarray, others: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        y = _solve(factors, y / np.abs(y).max())
        y /= np.abs(y).max()
        for _ in range(2):
            y -= others @ (others.T @ y)
        y /= np.sqrt(y @ y)
    return y


def leading_vectors(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors by column): the k leading ones of a symmetric matrix."""
    if not len(matrix) or not k:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scale = np.abs(matrix).max()
    if scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, mirrors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for at, v in reversed(mirrors):
        vectors[at:] -= 2 * np.outer(v, v @ vectors[at:])
    return values * scale, vectors / np.sqrt((vectors**2).sum(axis=0))


# --- sums over all rows -------------------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column, all lists of one width, as an integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (x * n - sums) / n


def _pieces(column: pa.Array, width: int):
    for at in range(0, len(column), _ROWS):
        yield _matrix(column.slice(at, _ROWS), width)


def _sum_products(made):
    """Every task's sum of products made(x)' made(x), row by row: (row, its doubles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for y in made(batch.column(0)):
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([r.tobytes() for r in total], pa.binary())], ["row", "sums"])

    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' rows, sorted by number -> their sums."""
    now, total = None, None
    done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["row", "sums"])
    for batch in batches:
        for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if row != now:
                if now is not None:
                    yield done()
                now, total = row, np.zeros(len(raw) // 8)
            total = total + np.frombuffer(raw, np.float64)
    if now is not None:
        yield done()


def products(column: DataFrame, made, width: int) -> np.ndarray:
    """The sum over all rows of made(x)' made(x), a matrix of the width alone."""
    parts = column.mapInArrow(_sum_products(made), "row int, sums binary")
    parts = parts.repartition(min(width, tasks(column.sparkSession)), "row").sortWithinPartitions("row").mapInArrow(_add_rows, "row int, sums binary")
    out = np.zeros((width, width))
    for row, raw in parts.collect():  # width rows
        out[row] = np.frombuffer(raw, np.float64)
    return (out + out.T) / 2


def totals(column: DataFrame, made, width: int, kind: str = "double") -> np.ndarray:
    """The sum over all rows of made(x): a row of the width; kind: double, or long for exact sums of integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64 if kind == "long" else np.float64)
        for batch in batches:
            for y in made(batch.column(0)):
                total += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["at", "total"])

    sums = column.mapInArrow(run, f"at int, total {kind}").groupBy("at").agg(F.sum("total").alias("total"))
    out = np.zeros(width, np.int64 if kind == "long" else np.float64)
    for at, total in sums.collect():  # width rows
        out[at] = total
    return out


# --- the operator -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What whitening needs: n rows, their exact sums, eigenvalues with unit vectors by column, shares of the trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def kept(self) -> np.ndarray:
        """Components with variance beyond rounding."""
        return self.values > len(self.sums) * EPS * self.values.max(initial=0.0) if len(self.values) else np.zeros(0, bool)

    def project(self, x: np.ndarray) -> np.ndarray:
        kept = self.kept
        return _centred(x, self.n, self.sums) @ (self.vectors[:, kept] / np.sqrt(self.values[kept]))


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE, offset: int = OFFSET) -> tuple[DataFrame, int]:
    """(id, x) of all rows that take part, x the integers, all of one width; and that width."""
    bad = F.exists(vector_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    whole = vectors.where(F.col(vector_col).isNotNull()).where(~bad)
    most, width = whole.agg(F.max(F.array_max(F.transform(vector_col, lambda c: F.abs(c.cast("double"))))), F.max(F.size(vector_col))).first()
    if (most or 0) * scale > 2.0**40:
        raise ValueError(f"an entry of {most} is beyond 2**40 times 1/{scale}")
    width = width or 0
    x = F.transform(vector_col, lambda c: F.floor(c.cast("double") * scale).cast("long") + offset)
    x = F.concat(x, F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size(vector_col)))
    return written(whole.select(F.col(id_col).alias("id"), x.alias("x")), "integers"), width


def fit(x: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Fits on all rows of x."""
    n, pieces = x.count(), lambda column: _pieces(column, width)
    if not n or not width:
        return Whitening(0, np.zeros(width, np.int64), np.zeros(0), np.zeros((width, 0)), np.zeros(0))
    sums = totals(x.select("x"), pieces, width, "long")
    covariance = products(x.select("x"), lambda column: (_centred(y, n, sums) for y in pieces(column)), width) / n
    values, vectors = leading_vectors(covariance, min(components, width))
    trace = np.trace(covariance)
    return Whitening(n, sums, values, vectors, np.maximum(values, 0.0) / trace if trace > 0 else np.zeros(len(values)))


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity; 0 without components."""
    width, k = len(model.sums), int(model.kept.sum())
    if not k:
        return 0.0
    made = lambda column: (model.project(y) for y in _pieces(column, width))
    mean = totals(x.select("x"), made, k) / model.n
    covariance = products(x.select("x"), lambda column: (y - mean for y in made(column)), k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The exact sum over dimensions of (n x - S)**2, beyond 64 bits, too."""
    far = x * n - sums
    if np.abs(far).max(initial=0) ** 2.0 * max(1, far.shape[1]) < 2.0**62:
        return pa.array((far * far).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = (far.astype(object) ** 2).sum(axis=1)
    return pa.array([Decimal(int(v)) for v in exact], pa.decimal128(38, 0))


def whiten(x: DataFrame, model: Whitening) -> DataFrame:
    """id, tw_deviation (decimal) and tw_white, an array by component, of every row of x."""
    width, k, kept = len(model.sums), len(model.values), model.kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                rows = _matrix(part.column(1), width)
                white, known = np.zeros((len(rows), k)), np.broadcast_to(kept, (len(rows), k))
                white[:, kept] = model.project(rows)
                flat = pa.array(white.ravel(), mask=~known.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) * k + 1, k, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), _deviations(rows, model.n, model.sums), lists], ["id", "tw_deviation", "tw_white"])

    kind = x.schema["id"].dataType.simpleString()
    if not k:
        return x.select("id", F.lit(0).cast("decimal(38,0)").alias("tw_deviation"), F.array().cast("array<double>").alias("tw_white")).limit(0)
    return x.mapInArrow(run, f"id {kind}, tw_deviation decimal(38,0), tw_white array<double>")
