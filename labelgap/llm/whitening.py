"""Whitening of vectors on the leading eigenvectors of their covariance, found by spectrum slicing.

The number of eigenvalues above a shift is the number of positive pivots of the LDL^T factors of the shifted matrix. Such
counts cut the spectrum until an interval holds one eigenvalue; Rayleigh quotient iteration then converges cubically
inside it, and two more counts, one on either side of the value found, prove which eigenvalue in order it is. Eigenvalues
that no shift tells apart are found together as one subspace.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.session import shuffle_width

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Entries whose scaled value is beyond this are no whole number in a long, and their vector is unusable.
MOST_SCALED = 2.0**62
#: Share of the largest eigenvalue below which two eigenvalues count as one cluster.
SEPARATION = 1e-10

_EPS = float(np.finfo(np.float64).eps)
_PIVOT = (1 + math.sqrt(17)) / 8
_SLICE = 4_000_000  # entries that are worked on at once


# -- spectrum slicing --------------------------------------------------------


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """Positive eigenvalues of ``matrix - shift``: positive pivots of its LDL^T factors, with 1x1 and 2x2 pivots for stability."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, above = len(a), 0, 0
    while k < n:
        column = np.abs(a[k + 1 :, k])
        largest = column.max() if len(column) else 0.0
        diagonal = abs(a[k, k])
        if max(diagonal, largest) == 0.0:
            k += 1
            continue
        step, chosen = 1, k
        if diagonal < _PIVOT * largest:
            row = k + 1 + int(column.argmax())
            others = np.abs(a[row, k:])
            others[row - k] = 0.0
            widest = others.max()
            if diagonal * widest < _PIVOT * largest * largest:
                chosen = row
                step = 1 if abs(a[row, row]) >= _PIVOT * widest else 2
        at = k + step - 1
        if chosen != at:
            a[[at, chosen], k:] = a[[chosen, at], k:]
            a[k:, [at, chosen]] = a[k:, [chosen, at]]
        rest = a[k + step :, k : k + step]
        if step == 1:
            above += a[k, k] > 0
            a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0] / a[k, k], rest[:, 0])
        else:  # a 2x2 pivot has one eigenvalue of either sign
            above += 1
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(a[k : k + 2, k : k + 2], rest.T)
        k += step
    return int(above)


def _shifted_solve(matrix: np.ndarray, shift: float, right: np.ndarray, spread: float) -> np.ndarray:
    for _ in range(4):
        try:
            found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(found).all():
                return found
        except np.linalg.LinAlgError:
            pass
        shift += _EPS * spread  # the shift is an eigenvalue to the last bit
    return right


def _rayleigh(matrix: np.ndarray, low: float, high: float, spread: float, start: np.ndarray) -> tuple[float, np.ndarray] | None:
    """The eigenvalue between two shifts by Rayleigh quotient iteration; None if it leads out of the interval."""
    vector = start / np.linalg.norm(start)
    for _ in range(3):  # inverse iteration leads to the one eigenvalue inside
        vector = _shifted_solve(matrix, (low + high) / 2, vector, spread)
        vector /= np.linalg.norm(vector)
    value = float(vector @ matrix @ vector)
    for _ in range(12):
        if not low < value <= high:
            return None
        if np.linalg.norm(matrix @ vector - value * vector) <= 4 * _EPS * spread:
            break
        vector = _shifted_solve(matrix, value, vector, spread)
        vector /= np.linalg.norm(vector)
        value = float(vector @ matrix @ vector)
    return (value, vector) if low < value <= high else None


def _cluster(matrix: np.ndarray, low: float, high: float, size: int, spread: float, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors of ``size`` eigenvalues too close to be told apart: their subspace, and the matrix within it."""
    basis = np.linalg.qr(start[:, :size])[0]
    for _ in range(6):
        basis = np.linalg.qr(_shifted_solve(matrix, (low + high) / 2, basis, spread))[0]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], (basis @ turn)[:, ::-1]


def leading_eigenpairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as columns.

    Eigenvalues that are zero to rounding are left out. The largest entry of a vector is positive.
    """
    size = len(matrix)
    spread = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    if spread == 0.0:
        return np.zeros(0), np.zeros((size, 0))
    width = SEPARATION * spread
    rng = np.random.default_rng(11)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    # Intervals with the counts above their ends, the uppermost on top.
    open_intervals = [(-width, 1.01 * spread, size, 0)]
    while open_intervals and len(values) < wanted:
        low, high, above_low, above_high = open_intervals.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if inside == 1:
            found = _rayleigh(matrix, low, high, spread, rng.standard_normal(size))
            if found is not None:
                value, vector = found
                proven = (eigenvalues_above(matrix, value + width / 4), eigenvalues_above(matrix, value - width / 4))
                if proven == (above_high, above_high + 1):
                    values.append(value)
                    vectors.append(vector)
                    continue
        if high - low <= width:
            several, basis = _cluster(matrix, low, high, inside, spread, rng.standard_normal((size, inside)))
            values.extend(several.tolist())
            vectors.extend(basis.T)
            continue
        middle = (low + high) / 2
        above = eigenvalues_above(matrix, middle)
        open_intervals += [(low, middle, above_low, above), (middle, high, above, above_high)]
    kept = [(e, v) for e, v in zip(values[:wanted], vectors) if e > 16 * size * _EPS * spread]
    columns = np.array([v for _, v in kept]).T.reshape(size, len(kept))
    for i in range(len(kept)):  # close neighbours are perpendicular only to their distance
        columns[:, i] -= columns[:, :i] @ (columns[:, :i].T @ columns[:, i])
        columns[:, i] /= np.linalg.norm(columns[:, i])
        columns[:, i] *= np.sign(columns[np.abs(columns[:, i]).argmax(), i])
    return np.array([e for e, _ in kept]), columns


# -- moments -------------------------------------------------------------------


class Moments:
    """Count, exact sums and centred products of whole-number rows; any two add up.

    Rows are centred on their own mean before they are multiplied, and two sets are joined by the distance of their means.
    """

    def __init__(self, dim: int):
        self.n, self.sums, self.products = 0, np.zeros(dim, object), np.zeros((dim, dim))

    def _join(self, n: int, sums: np.ndarray, products: np.ndarray) -> None:
        if not n:
            return
        if self.n:
            apart = (sums / n - self.sums / self.n).astype(np.float64)
            self.products += np.outer(apart, apart) * (self.n * n / (self.n + n))
        self.products += products
        self.n += n
        self.sums = self.sums + sums

    def add_rows(self, rows: np.ndarray, whole: bool = True) -> None:
        if not len(rows):
            return
        if not whole:
            sums = rows.sum(axis=0).astype(object)
        elif np.abs(rows).max() < 2.0**53 / max(len(rows), 1024):
            sums = np.array([int(s) for s in rows.astype(np.int64).sum(axis=0)], object)
        else:
            sums = np.array([sum(int(x) for x in column) for column in rows.T], object)
        centred = rows - (sums / len(rows)).astype(np.float64)
        self._join(len(rows), sums, centred.T @ centred)

    def join(self, other: Moments) -> None:
        self._join(other.n, other.sums, other.products)

    def covariance(self) -> np.ndarray:
        return self.products / self.n


_MOMENTS = "n long, sums array<string>, products binary"


def _record(moments: Moments) -> pa.RecordBatch:
    sums = pa.array([[str(s) for s in moments.sums]], pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([moments.n], pa.int64()), sums, pa.array([moments.products.tobytes()], pa.binary())], ["n", "sums", "products"])


def _joined(batches: Iterable[pa.RecordBatch], dim: int, whole: bool) -> Moments:
    all_ = Moments(dim)
    for batch in batches:
        for n, sums, products in zip(*(column.to_pylist() for column in batch.columns)):
            one = Moments(dim)
            one.n, one.products = n, np.frombuffer(products).reshape(dim, dim)
            one.sums = np.array([int(s) if whole else float(s) for s in sums], object)
            all_.join(one)
    return all_


def _gathered(parts: DataFrame, dim: int, whole: bool) -> DataFrame:
    """One row for all: a row per task is joined in two levels, so no task reads more than about the square root of them."""

    def run(batches):
        found = _joined(batches, dim, whole)
        if found.n:
            yield _record(found)

    width = shuffle_width(parts.sparkSession)
    for tasks in (width, math.isqrt(width - 1) + 1, 1):
        parts = parts.repartition(tasks).mapInArrow(run, _MOMENTS)
    return parts


def _scaled(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of a batch as whole numbers without the shift: the place of the first row, and the rows."""
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.floor(SCALE * flat.reshape(batch.num_rows, dim))
    step = max(1, _SLICE // max(dim, 1))
    for start in range(0, len(rows), step):
        yield start, rows[start : start + step]


# -- the operator ------------------------------------------------------------------


def usable_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, embedding``: rows whose vector is not null and holds finite entries only, and none beyond a long when scaled."""
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= MOST_SCALED / SCALE))
    return rows.filter(F.col("embedding").isNotNull() & ~bad)


def whiten(df: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per usable vector and component.

    An entry ``c`` counts as ``x = floor(64 c) + 1000000``. ``whitened`` is the centred vector on a unit eigenvector of the covariance of all
    vectors, over the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace; ``identity_error`` the largest
    entry by which the covariance of what is returned differs from the identity, measured over all rows; ``deviation`` the sum of ``(n x - S)^2``, null
    where it is beyond a long. Components without variance, beyond the rank of the covariance, are left out. Vectors must have one
    length: that of most vectors counts, the larger of equally frequent ones, and others are left out like unusable ones. Repeated and null
    ids keep their rows. No usable vector, or none that differs from another, gives an empty result.

    The driver sees one row: the eigenvectors, ``components`` times the length of a vector. Covariances are sums of a matrix per task.
    """
    spark = df.sparkSession
    usable = usable_vectors(df, id_column, vector_column)
    lengths = usable.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if most is None or most["dim"] == 0:
        return spark.createDataFrame([], schema)
    dim = most["dim"]
    vectors = usable.filter(F.size("embedding") == dim)

    def part(batches):
        found = Moments(dim)
        for batch in batches:
            for _, rows in _scaled(batch, dim):
                found.add_rows(rows)
        if found.n:
            yield _record(found)

    def solve(batches):
        found = _joined(batches, dim, True)
        if not found.n:
            return
        covariance = found.covariance()
        values, columns = leading_eigenpairs((covariance + covariance.T) / 2, components)
        sums = pa.array([[str(s) for s in found.sums]], pa.list_(pa.string()))
        arrays = [pa.array([a.tolist()], pa.list_(pa.float64())) for a in (values, columns.T.ravel())]
        yield pa.RecordBatch.from_arrays([pa.array([found.n], pa.int64()), sums, *arrays, pa.array([float(np.trace(covariance))])], ["n", "sums", "values", "vectors", "trace"])

    solved = _gathered(vectors.mapInArrow(part, _MOMENTS), dim, True)
    fit = solved.mapInArrow(solve, "n long, sums array<string>, values array<double>, vectors array<double>, trace double").first()
    if not fit["values"]:
        return spark.createDataFrame([], schema)
    n, sums = fit["n"], [int(s) for s in fit["sums"]]
    mean = np.array([s / n for s in sums])
    values = np.array(fit["values"])
    turn = np.array(fit["vectors"]).reshape(len(values), dim).T / np.sqrt(values)

    def check(batches):
        found = Moments(len(values))
        for batch in batches:
            for _, rows in _scaled(batch, dim):
                found.add_rows((rows - mean) @ turn, whole=False)
        if found.n:
            yield _record(found)

    def differences(batches):
        found = _joined(batches, len(values), False)
        yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(found.covariance() - np.eye(len(values))).max())])], ["error"])

    error = _gathered(vectors.mapInArrow(check, _MOMENTS), len(values), False).mapInArrow(differences, "error double").first()["error"]

    def project(batches):
        names = ["vec_id", "deviation", "whitened"]
        for batch in batches:
            for start, rows in _scaled(batch, dim):
                white = ((rows - mean) @ turn).ravel()
                offsets = pa.array(np.arange(0, white.size + 1, len(values)), pa.int32())
                arrays = [batch.column("vec_id").slice(start, len(rows)), _deviations(rows, n, sums), pa.ListArray.from_arrays(offsets, pa.array(white))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = vectors.mapInArrow(project, "vec_id long, deviation long, whitened array<double>")
    explained = F.array(*[F.lit(float(e) / fit["trace"]) for e in values])
    wide = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return wide.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """The exact sum of ``(n x - S)^2`` per row; the shift of ``x`` cancels. Null beyond a long."""
    furthest = n * float(np.abs(rows).max()) + max(abs(s) for s in sums)
    if rows.shape[1] * furthest * furthest < 2.0**62:
        apart = n * rows.astype(np.int64) - np.array(sums, np.int64)
        return pa.array((apart * apart).sum(axis=1))
    exact = [sum((n * int(x) - s) ** 2 for x, s in zip(row, sums)) for row in rows]
    return pa.array([e if e < 2**63 else None for e in exact], pa.int64())
