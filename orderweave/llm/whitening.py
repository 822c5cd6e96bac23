"""Embedding whitening: leading eigenvectors of the covariance by spectrum slicing.

Vectors become whole numbers, floor(`GRID` * c) of each entry c. The distinct ones are
the fit list; Spark sums them per dimension, then the products of their deviations from
the mean, block by block, so that one matrix of (dimensions x dimensions) is all that the
driver gets. There:

1. LDL^T inertia: the signs of D in a symmetric factorisation of V - s I (Bunch-Kaufman
   pivots) count the eigenvalues above s.
2. Bisection on those counts isolates each leading eigenvalue between two shifts.
3. Rayleigh quotient iteration, started inside the interval, converges cubically. A quotient
   that leaves its interval halves it once more and starts again.
4. Two more counts, just below and above the quotient, certify its number.

Every next vector is kept orthogonal to those before. Eigenvalues that no shift can part
are numbered as they are found, with any basis of their space.

Every row is then projected: whitened = (x - S/n) . component / sqrt(eigenvalue).

Defined results: rows whose vector is null or has a null or non-finite entry have none;
neither have vectors of another length than the most frequent one (the longer of two
equally frequent), empty ones included. Entries beyond a long become the nearest long.
Repeated rows are fitted once and returned each. Components whose eigenvalue is not above
rounding (fewer distinct vectors than components, constant dimensions) are left out.
`deviation` is null where the exact sum exceeds a long, and everywhere if the fit list has
an entry at an end of a long's range, as the sums are then not those of the vectors. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark import prepare, release, written
from .texts import flat

GRID = 256
COMPONENTS = 4
#: Rows multiplied at a time.
_ROWS = 4096
_EPS = float(np.finfo(float).eps)
_LONG = (-(1 << 63), (1 << 63) - 1)


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whole numbers, offsets, lengths, usable): the entries of all vectors, and which vectors count."""
    column = column.cast(pa.large_list(column.type.value_type))
    present = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = present & (bad[offsets[1:]] == bad[offsets[:-1]])
    scaled = np.floor(GRID * np.where(np.isfinite(values), values, 0.0)) + 0
    whole = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    whole[scaled >= 2.0**63] = _LONG[1]
    return whole, offsets, lengths, usable


def _packed(vector: np.ndarray) -> bytes:
    """Equal vectors get equal bytes: two bytes an entry where all fit, else eight."""
    small = vector.astype(np.int16)
    return small.tobytes() + b"\2" if np.array_equal(small, vector) else vector.tobytes() + b"\0"


def _unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    data, offsets = flat(column)
    sizes, n = np.diff(offsets), len(column)
    if (sizes == 2 * dimensions + 1).all():
        return np.ascontiguousarray(data.reshape(n, -1)[:, :-1]).view(np.int16).astype(np.int64)
    found = np.empty((n, dimensions), np.int64)
    for at, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        found[at] = np.frombuffer(data[a : b - 1].tobytes(), np.int16 if data[b - 1] == 2 else np.int64)
    return found


def _whole(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, dimensions, x): packed whole numbers of the usable rows."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offsets, lengths, usable = _entries(batch.column("vector"))
            which = np.flatnonzero(usable)
            packed = [_packed(whole[offsets[k] : offsets[k + 1]]) for k in which.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(which)), pa.array(lengths[which]), pa.array(packed, pa.binary())], names=["vec_id", "dimensions", "x"])

    return rows.mapInArrow(pack, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, dimensions long, x binary")


def _sums(distinct: DataFrame, dimensions: int) -> tuple[int, list[int], bool]:
    """How many vectors there are, the exact sum of each dimension, and whether no entry is at an end of a long's range."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, ends = 0, [0] * dimensions, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unpacked(batch.column("x"), dimensions)
            n += len(x)
            ends += int(((x == _LONG[0]) | (x == _LONG[1])).sum())
            safe = int(np.abs(x.astype(float)).max()) * len(x) < 1 << 62
            total = [a + b for a, b in zip(total, (x.sum(0) if safe else x.astype(object).sum(0)).tolist(), strict=True)]
        places = [-2, -1, *range(dimensions)]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array([str(v) for v in [ends, n, *total]])], names=["place", "total"])

    rows = distinct.mapInArrow(add, "place long, total string").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["place"]: int(r["total"]) for r in rows.collect()}  # dimensions + 2 rows
    return found.get(-1, 0), [found.get(k, 0) for k in range(dimensions)], not found.get(-2, 0)


class Centre:
    """The mean S/n of whole vectors, kept as a whole part and a rest, so that deviations lose nothing."""

    def __init__(self, n: int, sums: list[int], exact: bool = True):
        self.n, self.sums, self.exact = n, sums, exact
        self._whole = np.array([s // n for s in sums], np.int64)
        self._rest = np.array([(s % n) / n for s in sums])

    def deviations(self, x: np.ndarray) -> np.ndarray:
        if max(np.abs(x.astype(float)).max(initial=0), np.abs(self._whole.astype(float)).max(initial=0)) < 1 << 61:
            return (x - self._whole) - self._rest
        return (x.astype(object) - self._whole.astype(object)).astype(float) - self._rest

    def squares(self, x: np.ndarray) -> list[int | None]:
        """sum((n * x - S) ** 2), exactly."""
        if not self.exact:
            return [None] * len(x)
        most = max(int(np.abs(x.astype(float)).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        exact = x if 4 * (most + 1) ** 2 * max(len(self.sums), 1) < _LONG[1] else x.astype(object)
        found = ((self.n * exact - np.array(self.sums, exact.dtype)) ** 2).sum(1).tolist()
        return [v if v <= _LONG[1] else None for v in found]


def _products(distinct: DataFrame, dimensions: int, columns) -> np.ndarray:
    """Mean of column-by-column products over the fit list, centred; `columns` makes a block's columns."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                c = columns(_unpacked(batch.column("x").slice(start, _ROWS), dimensions))
                n += len(c)
                c = np.column_stack([c, np.ones(len(c))])
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            rows = [row.tobytes() for row in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.binary())], names=["place", "row"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(r.as_buffer(), float) for r in rows["row"]], axis=0)
        return pa.table({"place": rows["place"].slice(0, 1), "row": pa.array([total.tobytes()], pa.binary())})

    rows = distinct.mapInArrow(multiply, "place long, row binary").groupBy("place").applyInArrow(add, "place long, row binary").collect()
    found = np.array([np.frombuffer(r["row"], float) for r in sorted(rows, key=lambda r: r["place"])])  # a square of the dimensions
    n, means = found[-1, -1], found[-1, :-1] / found[-1, -1]
    return found[:-1, :-1] / n - np.outer(means, means)  # what rounding left of the means is next to nothing


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues are (positive, zero, negative): signs of D in P A P^T = L D L^T."""
    a = np.array(matrix, float)
    alpha, (plus, zero, minus) = (1 + 17**0.5) / 8, (0, 0, 0)
    while len(a):
        n = len(a)
        below = np.abs(a[1:, 0])
        r = int(below.argmax()) + 1 if n > 1 else 0
        most = below[r - 1] if n > 1 else 0.0
        if max(abs(a[0, 0]), most) == 0:
            zero, a = zero + 1, a[1:, 1:]
            continue
        pair = False
        if abs(a[0, 0]) < alpha * most:
            of_r = np.abs(a[r])
            sigma = max(np.delete(of_r, r))
            if abs(a[0, 0]) * sigma >= alpha * most**2:
                pass
            elif of_r[r] >= alpha * sigma:
                a = _swapped(a, 0, r)
            else:
                pair, a = True, _swapped(a, 1, r)
        if pair:
            # a pivot of two rows: one eigenvalue on either side, as its determinant is negative
            d, c = a[:2, :2], a[2:, :2]
            plus, minus = plus + 1, minus + 1
            a = a[2:, 2:] - c @ np.linalg.solve(d, c.T)
        else:
            plus, minus = plus + (a[0, 0] > 0), minus + (a[0, 0] < 0)
            c = a[1:, 0]
            a = a[1:, 1:] - np.outer(c / a[0, 0], c)
    return int(plus), int(zero), int(minus)


def _swapped(a: np.ndarray, i: int, j: int) -> np.ndarray:
    order = np.arange(len(a))
    order[[i, j]] = order[[j, i]]
    return a[np.ix_(order, order)]


def _above(v: np.ndarray, shift: float) -> int:
    return inertia(v - shift * np.eye(len(v)))[0]


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors, by row) of the `most` greatest that are above rounding."""
    v = (v + v.T) / 2
    d = len(v)
    norm = float(np.abs(v).sum(1).max(initial=0.0))
    rounding = 4 * d * _EPS * norm
    values, vectors = [], np.zeros((0, d))
    if not norm or not np.isfinite(norm):
        return np.array(values), vectors
    for k in range(1, min(most, _above(v, rounding)) + 1):
        # more than `above` and at most `inside` eigenvalues are above `high` and `low`; the k-th is between them
        low, high, above = rounding, norm + rounding, 0
        inside = _above(v, low)
        start = np.cos(np.arange(1, d + 1) * (k + 0.5))  # any vector that no eigenvector is orthogonal to
        while True:
            alone = inside - above == 1
            if alone or high - low <= 2 * rounding:
                value, vector = _quotient_iteration(v, (low + high) / 2, start, vectors, rounding)
                certain = low - rounding <= value <= high + rounding and _above(v, value - 2 * rounding) >= k > _above(v, value + 2 * rounding)
                if certain or high - low <= 2 * rounding:
                    break
            middle = (low + high) / 2
            n = _above(v, middle)
            low, high, inside, above = (middle, high, n, above) if n >= k else (low, middle, inside, n)
        values.append(value)
        vectors = np.vstack([vectors, vector])
    return np.array(values), vectors


def _quotient_iteration(v: np.ndarray, shift: float, start: np.ndarray, found: np.ndarray, rounding: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration, after two steps of inverse iteration at the shift; orthogonal to the vectors found."""
    identity = np.eye(len(v))
    value, vector, least, best = shift, start, np.inf, (shift, start)
    for step in range(30):
        at = shift if step < 2 else value
        try:
            vector = np.linalg.solve(v - at * identity, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            vector = np.linalg.solve(v - (at + rounding) * identity, vector)
        # by a power of two, so exactly: a shift within a few bits of an eigenvalue makes the entries huge, and their squares overflow
        vector = np.ldexp(vector, -np.frexp(np.abs(vector).max())[1])
        vector = vector - found.T @ (found @ vector)
        vector = vector / np.linalg.norm(vector)
        value = float(vector @ v @ vector)
        residual = float(np.linalg.norm(v @ vector - value * vector))
        if step >= 2 and residual >= least / 2:
            break
        if residual < least:
            least, best = residual, (value, vector)
    return best


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = written(_whole(vectors, vec_id, vector))
    id_type = rows.schema["vec_id"].dataType
    schema = f"vec_id {id_type.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.where("dimensions > 0").groupBy("dimensions").count()
    usual = lengths.orderBy(F.desc("count"), F.desc("dimensions")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    dimensions = usual["dimensions"]
    rows = rows.where(F.col("dimensions") == dimensions)
    distinct = written(rows.select("x").distinct())
    n, sums, exact = _sums(distinct, dimensions)
    centre = Centre(n, sums, exact)
    v = _products(distinct, dimensions, centre.deviations)
    values, axes = leading(v, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    onto = (axes / np.sqrt(values)[:, None]).T
    explained = values / np.trace(v)
    error = float(np.abs(_products(distinct, dimensions, lambda x: centre.deviations(x) @ onto) - np.eye(len(values))).max())
    k = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unpacked(batch.column("x"), dimensions)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            columns = {
                "vec_id": batch.column("vec_id").take(each),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(x) * k, n)),
                "deviation": pa.array(centre.squares(x), pa.int64()).take(each),
                "whitened": pa.array((centre.deviations(x) @ onto).ravel()),
                "explained": pa.array(np.tile(explained, len(x))),
                "identity_error": pa.array(np.full(len(x) * k, error)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        release()

    return rows.select("vec_id", "x").mapInArrow(project, schema)
