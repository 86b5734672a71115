"""Embedding whitening by spectrum slicing.

The covariance is summed in whole numbers, centred before they are multiplied: Gram sums leave the
tasks, one row per pair of dimensions, and add up exactly. The driver holds that matrix alone. The
inertia of an LDL' factorisation of V - s*I counts the eigenvalues above s; bisection by such counts
puts each leading eigenvalue in an interval of its own, Rayleigh quotient iteration finishes it at a
cubic rate, and counts on both sides of the result certify that it is the k-th one. Vectors are then
projected in blocks, and the covariance of what came out is measured.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlake.llm.zone_kmeans import matrix, usable
from fleetlake.sources.scratch import materialised

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Rows that are multiplied at once.
_SLICE = 2048
# An eigenvalue below this part of the trace counts as zero: rounding cannot tell them apart.
ZERO = 1e-13
_EPS = float(np.finfo(float).eps)
_GROWTH = (1 + 17 ** 0.5) / 8


def whole(x: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    """floor(scale * x) + offset as longs; an error beyond what a double holds as a whole number."""
    out = np.floor(scale * x)
    if out.size and np.abs(out).max() > 1 << 50:
        raise ValueError(f"a component times {scale} is beyond the whole numbers of a double")
    return out.astype(np.int64) + offset


def _slices(batches, d: int, scale: int, offset: int):
    """(first column's part, whole numbers) of up to _SLICE rows at a time; vectors come last."""
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            part = batch.slice(at, _SLICE)
            yield part.column(0), whole(matrix(part.column(batch.num_columns - 1), d), scale, offset)


def _gram(y: np.ndarray) -> np.ndarray:
    """y'y in whole numbers; doubles where they are exact."""
    reach = len(y) * int(np.abs(y).max(initial=0)) ** 2
    if reach >= 1 << 62:
        raise ValueError("products of components do not fit a long")
    z = y.astype(float) if reach < 1 << 53 else y
    return (z.T @ z).astype(np.int64)


def _summed(rows: DataFrame, d: int) -> tuple[np.ndarray, list]:
    """A task's (i, j, value) rows added up: the upper triangle as a matrix, and (i, -1) as a list."""
    found = rows.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    square = np.zeros((d, d), object)
    line: list = [0] * (d + 1)
    for r in found:
        if r["j"] < 0:
            line[r["i"]] = r["value"]
        else:
            square[r["i"], r["j"]] = square[r["j"], r["i"]] = r["value"]
    return square, line


def _rows_of(square: np.ndarray | None, line: np.ndarray):
    """One Arrow batch (i, j, value) of a task's sums."""
    i, j = np.arange(len(line)), np.full(len(line), -1)
    value = line
    if square is not None:
        up = np.triu_indices(len(square))
        i, j = np.concatenate([i, up[0]]), np.concatenate([j, up[1]])
        value = np.concatenate([line, square[up]])
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(value)],
                                      names=["i", "j", "value"])


def covariance(rows: DataFrame, d: int, scale: int = SCALE, offset: int = OFFSET
               ) -> tuple[int, list[int], np.ndarray, float]:
    """(n, sums, covariance, trace) of the whole numbers of ``rows``; each entry is rounded once."""
    def add(batches):
        total = np.zeros(d + 1, np.int64)
        for _, x in _slices(batches, d, scale, offset):
            total[:d] += x.sum(axis=0)
            total[d] += len(x)
        yield _rows_of(None, total)

    vectors = rows.select("vector")
    _, line = _summed(vectors.mapInArrow(add, "i int, j int, value long"), d)
    n, sums = line[d], line[:d]
    if not n:
        return 0, sums, np.zeros((d, d)), 0.0
    centre = np.array([(2 * s + n) // (2 * n) for s in sums])

    def multiply(batches):
        square, total = np.zeros((d, d), np.int64), np.zeros(d + 1, np.int64)
        for _, x in _slices(batches, d, scale, offset):
            y = x - centre
            square += _gram(y)
            total[:d] += y.sum(axis=0)
        yield _rows_of(square, total)

    square, rest = _summed(vectors.mapInArrow(multiply, "i int, j int, value long"), d)
    exact = [[n * square[i, j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]
    return (n, sums, np.array([[c / (n * n) for c in row] for row in exact]),
            sum(exact[i][i] for i in range(d)) / (n * n))


def above(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``v`` above ``shift``: positive ones of D in L D L' = v - shift * I.

    Pivots are single entries or pairs, chosen by the size of their column (Bunch and Kaufman).
    """
    a = v - shift * np.eye(len(v))
    count = 0
    while len(a):
        low = np.abs(a[1:, 0])
        lam = low.max(initial=0.0)
        pair = False
        if lam and abs(a[0, 0]) < _GROWTH * lam:
            r = 1 + int(low.argmax())
            column = np.abs(a[:, r])
            column[r] = 0.0
            sigma = column.max()
            if abs(a[0, 0]) * sigma < _GROWTH * lam * lam:
                pair = abs(a[r, r]) < _GROWTH * sigma
                to = 1 if pair else 0
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if pair:  # a pair of opposite signs
            count += 1
            side = a[2:, :2]
            a = a[2:, 2:] - side @ np.linalg.solve(a[:2, :2], side.T)
        else:
            count += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0]) if a[0, 0] else a[1:, 1:]
    return int(count)


def leading(v: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` greatest eigenvalues, falling, and unit eigenvectors as columns.

    Eigenvalues that counts cannot part (closer than rounding) share an interval; their vectors are
    made orthogonal. A result whose counts do not certify its number is an error.
    """
    d = len(v)
    size = float(np.abs(v).sum(axis=1).max(initial=0.0))
    if not size:
        return np.zeros(m), np.eye(d)[:, :m]
    fine = 4 * d * _EPS * size
    counts = {-size - fine: d, size + fine: 0}

    def count(s: float) -> int:
        if s not in counts:
            counts[s] = above(v, s)
        return counts[s]

    draw = np.random.default_rng(1)
    values, found = np.zeros(m), np.zeros((d, m))
    for k in range(m):
        low = max(s for s, c in counts.items() if c > k)
        high = min(s for s, c in counts.items() if c <= k and s > low)
        while high - low > fine and (count(low) != k + 1 or count(high) != k):
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) > k else (low, middle)
        for _ in range(200):
            y, rho, settled = _refined(v, low, high, found[:, :k], values[:k], draw, fine)
            # Counts on both sides: it is the (k+1)-th and not a neighbour at the interval's edge.
            certified = settled and above(v, rho + 2 * fine) <= k < above(v, rho - 2 * fine)
            if certified:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) > k else (low, middle)
        if not certified:
            raise ArithmeticError(f"eigenvalue {k + 1} is not certified by the counts around {rho}")
        values[k], found[:, k] = rho, y
    return values, found


def _refined(v, low, high, before, values, draw, fine):
    """(vector, Rayleigh quotient, whether it settled inside the interval)."""
    def solved(shift, y):
        try:
            z = np.linalg.solve(v - shift * np.eye(len(v)), y)
        except np.linalg.LinAlgError:
            z = np.linalg.solve(v - (shift + fine) * np.eye(len(v)), y)
        return z / np.linalg.norm(z)

    near = before[:, np.abs(values - (low + high) / 2) <= (high - low) + 4 * fine]

    def apart(y, others):
        y = y - others @ (others.T @ y)
        return y / np.linalg.norm(y)

    y = apart(draw.standard_normal(len(v)), near)
    for _ in range(3):
        y = apart(solved((low + high) / 2, y), near)
    for _ in range(40):
        rho = float(y @ v @ y)
        if not low - fine <= rho <= high + fine:
            return y, rho, False
        if np.linalg.norm(v @ y - rho * y) <= fine / 4:
            y = apart(solved(rho, y), before)  # one more step of cubic convergence
            return y, float(y @ v @ y), True
        y = apart(solved(rho, y), near)
    return y, rho, high - low <= fine


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET,
           vector: str = "embedding") -> DataFrame:
    """vec_id, deviation, whitened array<double>, n, values array<double>, explained array<double>,
    identity_error; one row per row whose vector holds only finite numbers.

    Vectors that are null, empty or hold nulls, NaN or infinities are left out; so are vectors whose
    length is not the most frequent one (of equals the shortest). Repeated rows each get theirs; null
    ids are kept; further columns are ignored; an empty table gives no rows. Ties among eigenvalues
    take any orthogonal vectors. A component whose eigenvalue is zero (fewer different vectors than
    dimensions, constant dimensions) has null ``whitened`` and does not enter ``identity_error``.
    ``deviation`` is exact; one that no long can hold is an error.
    """
    rows = usable(vectors, None, vector).where(F.size("vector") > 0)
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = lengths["d"] if lengths else 1
    rows = rows.where(F.size("vector") == d)
    n, sums, v, trace = covariance(rows, d, scale, offset)
    m = min(components, d)
    values, axes = leading(v, m)
    live = values > ZERO * trace if trace else np.zeros(m, bool)
    values = np.where(live, values, 0.0)
    onto = axes / np.sqrt(np.where(live, values, 1.0))
    centre = np.array([(2 * s + n) // (2 * n) if n else 0 for s in sums])
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    mean = np.array([r / n if n else 0.0 for r in rest])

    def deviations(y: np.ndarray) -> np.ndarray:
        reach = d * (n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))) ** 2
        z = n * y.astype(np.int64 if reach < 1 << 63 else object) - np.array(
            rest, np.int64 if reach < 1 << 63 else object)
        return (z * z).sum(axis=1)

    def project(batches):
        for ids, x in _slices(batches, d, scale, offset):
            y = x - centre
            z = (y - mean) @ onto
            flat = pa.array(z.ravel(), mask=np.tile(~live, len(z)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(deviations(y).tolist(), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * m), flat)],
                names=["vec_id", "deviation", "whitened"])

    out = materialised(rows.mapInArrow(project, "vec_id long, deviation long, whitened array<double>"), "whitened")
    error = identity_error(out, m, n, live)
    return out.select(
        "vec_id", "deviation", "whitened", F.lit(n).cast("long").alias("n"),
        *[F.lit(a.tolist()).cast("array<double>").alias(name)
          for name, a in (("values", values), ("explained", values / trace if trace else np.zeros(m)))],
        F.lit(error).cast("double").alias("identity_error"))


def identity_error(rows: DataFrame, m: int, n: int, live: np.ndarray) -> float:
    """Greatest absolute entry of (covariance of ``whitened`` - identity) over the live components."""
    def multiply(batches):
        square, total = np.zeros((m, m)), np.zeros(m + 1)
        for batch in batches:
            z = np.nan_to_num(matrix(batch.column(0), m))
            square += z.T @ z
            total[:m] += z.sum(axis=0)
        yield _rows_of(square, total)

    square, line = _summed(rows.select("whitened").mapInArrow(multiply, "i int, j int, value double"), m)
    if not n or not live.any():
        return 0.0
    mean = np.array(line[:m], float) / n
    away = square.astype(float) / n - np.outer(mean, mean) - np.eye(m)
    return float(np.abs(away[np.ix_(live, live)]).max())
