"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

Rows whose vector is null, or holds a null or non-finite entry, are dropped; so are
vectors shorter than the longest (their missing places count as null). An entry c becomes the
whole number x = floor(64 * c) + 1000000 (64 * c is held within +-2**52). The *fit
list* has each distinct x vector once; its covariance V is taken with divisor n.

1. Each partition of the fit list keeps (count, mean, eigenvalues, eigenvectors) of
   its scatter and takes in one vector after another: a centred rank-one update of the
   eigendecomposition. The new eigenvalues are the roots of the secular equation, solved
   for all at once by rational interpolation in brackets; directions that an update
   leaves alone, and equal eigenvalues, are deflated first; eigenvectors come
   from the weights that fit the computed roots exactly, so they stay orthogonal.
2. Spectra are combined in groups of ``FAN``, level by level: the eigenpairs of one are
   rank-one updates of the other, and so is the difference of the means.
3. Rayleigh-Ritz: the covariance is projected on the combined eigenvectors in one
   distributed pass, and the small dense problem gives the components to double
   precision. One more pass measures the covariance of the whitened fit list.

What reaches the driver is bounded by the number of dimensions d: sums (d), one
spectrum and one projected matrix (d * d). An update costs about d**3 operations a vector.

Repeated vectors count once in the fit and come back for each of their rows. A
null id stays null. Equal eigenvalues leave their components free up to a rotation. A
component without variance has whitened null. A deviation beyond 64 bits is null.
An empty table, or one without usable vectors, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, map_arrow, staged

STEP, SHIFT = 64, 1_000_000      # fixed values of the whole numbers
REACH = float(1 << 52)
FAN = 16
EPS = np.finfo(np.float64).eps
SPECTRUM = "n long, mean array<double>, values array<double>, vectors array<double>"


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z' for ascending distinct d, and the matrix d_j - root_i (row i).

    Root i lies between d_i and d_(i+1), the last within rho |z|**2 of d. It is sought as a
    distance from the nearer pole, so that differences to the poles keep their relative accuracy.
    """
    k, weight = len(d), rho * z2
    here = np.arange(k)
    span = np.append(np.diff(d), rho * z2.sum())
    middle = span / 2
    delta = d[None, :] - d[:, None]
    right = 1 + (1 / (delta - middle[:, None])) @ weight < 0
    near = here + (right & (here < k - 1))
    delta = d[None, :] - d[near][:, None]
    first = delta[here, here]
    second = np.append(delta[here[:-1], here[1:]], span[-1])
    low, high = np.where(right, first + middle, first), np.where(right, second, first + middle)
    tau = (low + high) / 2
    lower = np.tril(np.ones((k, k)))
    some = here                      # roots still moving
    for _ in range(80):
        t = tau[some]
        inverse = 1 / (delta[some] - t[:, None])
        f = 1 + inverse @ weight
        low[some], high[some] = np.where(f < 0, t, low[some]), np.where(f < 0, high[some], t)
        inverse *= inverse
        slope = inverse @ weight
        inverse *= lower[some]
        left = inverse @ weight
        one, two = first[some] - t, second[some] - t
        a = (one + two) * f - one * two * slope
        b = one * two * f
        c = f - one * left - two * (slope - left)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = t + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = np.where(((new > low[some]) & (new < high[some])) | (new == t), new, (low[some] + high[some]) / 2)
        tau[some] = new
        # convergence is quadratic: the step after one of a relative 1e-9 would be lost in rounding
        some = some[(np.abs(new - t) > 1e-9 * np.abs(new)) & (high[some] - low[some] > EPS * np.abs(high[some]))]
        if not len(some):
            break
    return d[near] + tau, delta - tau[:, None]


def update_of_diagonal(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of diag(d) + rho z z' for ascending distinct d and z without zeros."""
    k = len(d)
    if k == 1:
        return d + rho * z * z, np.ones((1, 1))
    values, gap = secular_roots(d, z * z, rho)
    # the weights for which the computed roots are exact; each factor pairs a root with the pole next to it
    i = np.arange(k)
    poles = np.where(i[None, :] < i[:, None], d[None, :], np.append(d[1:], 0)[None, :]) - d[:, None]
    poles[:, -1] = rho
    weight = np.sqrt(np.abs(np.prod(-gap.T / poles, axis=1))) * np.sign(z)
    vectors = weight[:, None] / gap.T
    return values, vectors / np.sqrt((vectors * vectors).sum(0))


class Spectrum:
    """Count, mean and eigendecomposition (ascending, of the directions seen so far) of a scatter matrix."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def empty(cls, dims: int) -> "Spectrum":
        return cls(0, np.zeros(dims), np.empty(0), np.empty((dims, 0)))

    def direction(self, v: np.ndarray, rho: float) -> None:
        """Adds rho v v' to the scatter."""
        length = np.sqrt(v @ v)
        if not length or not rho:
            return
        z = self.vectors.T @ v
        if len(self.values) < len(v):
            rest = v - self.vectors @ z
            rest -= self.vectors @ (self.vectors.T @ rest)
            size = np.sqrt(rest @ rest)
            if size > 64 * EPS * length:        # a direction not seen before, with eigenvalue 0
                self.vectors = np.column_stack([rest / size, self.vectors])
                self.values, z = np.append(0.0, self.values), np.append(size, z)
        tolerance = 8 * EPS * max(self.values[-1], rho * length * length)
        live = rho * np.abs(z) * length > tolerance
        self._merge_equal(z, live, tolerance)
        some = np.flatnonzero(live)
        if not len(some):
            return
        values, turn = update_of_diagonal(self.values[some], z[some], rho)
        if len(some) == len(self.values):
            self.values, self.vectors = values, self.vectors @ turn
            return
        self.values[some], self.vectors[:, some] = values, self.vectors[:, some] @ turn
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _merge_equal(self, z: np.ndarray, live: np.ndarray, tolerance: float) -> None:
        """Of two directions with (nearly) one eigenvalue, a rotation leaves all weight to one."""
        some = np.flatnonzero(live)
        if not (np.diff(self.values[some]) <= 2 * tolerance).any():     # |c s| <= 1/2
            return
        for i, j in zip(some[:-1].tolist(), some[1:].tolist()):
            size = np.hypot(z[i], z[j])
            c, s = z[j] / size, z[i] / size
            if abs((self.values[j] - self.values[i]) * c * s) <= tolerance:
                a, b = self.vectors[:, i].copy(), self.vectors[:, j].copy()
                self.vectors[:, i], self.vectors[:, j] = c * a - s * b, s * a + c * b
                z[i], z[j], live[i] = 0.0, size, False

    def add(self, x: np.ndarray) -> None:
        """Takes in one vector: the centred rank-one update."""
        off = x - self.mean
        self.direction(off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: "Spectrum") -> None:
        """Takes in all vectors of another spectrum by successive rank-one updates."""
        if not other.n:
            return
        for value, vector in zip(other.values[::-1], other.vectors.T[::-1]):
            self.direction(vector, value)
        off = other.mean - self.mean
        both = self.n + other.n
        self.direction(off, self.n * other.n / both)
        self.mean = self.mean + off * (other.n / both)
        self.n = both

    def row(self) -> dict:
        return {"n": [self.n], "mean": [self.mean.tolist()], "values": [self.values.tolist()], "vectors": [self.vectors.ravel().tolist()]}

    @classmethod
    def of_row(cls, n: int, mean: list, values: list, vectors: list) -> "Spectrum":
        return cls(n, np.array(mean, float), np.array(values, float), np.array(vectors, float).reshape(len(mean), len(values)))


def whole_numbers(vector: Column) -> Column:
    """x of each entry of an array column."""
    held = lambda c: F.greatest(F.least(c * STEP, F.lit(REACH)), F.lit(-REACH))
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(held(c)).cast("long") + SHIFT)


def usable(vector: Column) -> Column:
    """Whether an array column is there and all its entries are finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector.cast("array<double>"), lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(dims: int):
    """Exact sums per dimension, given out before 64 bits could overflow; dimension -1 is the count."""
    def run(batches):
        total, bound, count = np.zeros(dims, np.int64), 0, 0
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            reach = int(np.abs(x).max(initial=0)) * len(x)
            if bound + reach >= 1 << 62:
                yield pa.RecordBatch.from_pydict({"dim": np.arange(dims, dtype=np.int32), "total": total})
                total, bound = np.zeros(dims, np.int64), 0
            total, bound, count = total + x.sum(0), bound + reach, count + len(x)
        yield pa.RecordBatch.from_pydict({"dim": np.arange(-1, dims, dtype=np.int32), "total": np.append(count, total)})
    return run


def _spectrum(dims: int, origin: np.ndarray):
    def run(batches):
        own = Spectrum.empty(dims)
        for batch in batches:
            for x in (_matrix(batch.column(0), dims) - origin).astype(np.float64):
                own.add(x)
        if own.n:
            yield pa.RecordBatch.from_pydict(own.row(), schema=_ARROW)
    return run


_ARROW = pa.schema([("n", pa.int64()), *[(c, pa.list_(pa.float64())) for c in ("mean", "values", "vectors")]])


def _combined(table: pa.Table) -> pa.Table:
    parts = [Spectrum.of_row(**r) for r in table.select(["n", "mean", "values", "vectors"]).to_pylist()]
    parts.sort(key=lambda s: (-s.n, s.mean.tolist()))
    for other in parts[1:]:
        parts[0].merge(other)
    return pa.table({**parts[0].row(), "part": pa.array(table["part"].slice(0, 1).to_pylist(), pa.int64())},
                    schema=pa.schema([*_ARROW, ("part", pa.int64())]))


def combined_spectrum(spectra: DataFrame) -> Spectrum | None:
    """One spectrum of all rows of ``spectra`` (columns of SPECTRUM): groups of FAN become one, level by level."""
    level = staged(spectra.withColumn("part", F.spark_partition_id().cast("long")), "spectra")
    width = level.agg(F.max("part")).first()[0]
    while width is not None and width > 0:
        width //= FAN
        level = level.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInArrow(_combined, SPECTRUM + ", part long")
    last = level.collect()     # at most one spectrum
    return Spectrum.of_row(*last[0][:4]) if last else None


def _products(dims: int, origin: np.ndarray, rest: np.ndarray, basis: np.ndarray):
    """Sums of y and y y' of all vectors, centred and then projected on the basis."""
    k = basis.shape[1]

    def run(batches):
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = ((_matrix(batch.column(0), dims) - origin) - rest) @ basis
            total, square = total + y.sum(0), square + y.T @ y
        yield pa.RecordBatch.from_pydict({"at": np.arange(k + k * k, dtype=np.int64), "total": np.append(total, square.ravel())})
    return run


def projected_covariance(fit: DataFrame, n: int, dims: int, origin: np.ndarray, rest: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the vectors' projections on the columns of ``basis``, in one pass."""
    k = basis.shape[1]
    sums = fit.select("x").mapInArrow(_products(dims, origin, rest, basis), "at long, total double").groupBy("at").agg(F.sum("total").alias("total"))
    found = np.zeros(k + k * k)
    for at, total in sums.collect():     # k + k * k numbers
        found[at] = total / n
    mean, square = found[:k], found[k:].reshape(k, k)
    return square - np.outer(mean, mean)


class Whitening:
    """n, sums, components (columns, by falling eigenvalue), eigenvalues, trace and the measured identity error."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.values, self.trace = n, sums, components, values, trace
        self.origin = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])
        self.identity_error = 0.0
        # what rounding alone can leave of a zero eigenvalue
        self.varies = values > 4 * len(sums) * EPS * max(values.max(initial=0), 0)
        scale = np.where(self.varies, 1 / np.sqrt(np.where(self.varies, values, 1)), np.nan)
        self.map = components * scale

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, exact; None beyond 64 bits."""
        top = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        if top < 1 << 62:
            off = x * self.n - np.array(self.sums, np.int64)
            if int(np.abs(off).max(initial=0)) ** 2 * len(self.sums) < 1 << 62:
                return (off * off).sum(1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def fit_list(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Distinct x vectors of the usable rows, written to the shared folder: columns x, dims."""
    v = F.col(f"`{vector}`")
    return staged(rows.where(usable(v)).select(whole_numbers(v).alias("x")).distinct().withColumn("dims", F.size("x")), "fit-list")


def fit_whitening(rows: DataFrame, vector: str = "embedding", count: int = 16) -> Whitening | None:
    """The first ``count`` components of the rows' fit list; None without usable vectors."""
    fit = fit_list(columns(rows, vector), vector)
    dims = fit.agg(F.max("dims")).first()[0]
    if dims is None:
        return None
    fit = fit.where(F.col("dims") == dims).select("x")
    sums = fit.mapInArrow(_sums(dims), "dim int, total long").groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    total = {dim: int(v) for dim, v in sums.collect()}     # d + 1 numbers
    n, sums = total[-1], [total[k] for k in range(dims)]
    origin = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    spectrum = combined_spectrum(map_arrow(fit, _spectrum(dims, origin), SPECTRUM))
    # all directions, those never seen last; QR takes off what rounding did to their right angles
    seen = spectrum.vectors[:, ::-1]
    basis, _ = np.linalg.qr(np.column_stack([seen, np.eye(dims)]) if seen.shape[1] < dims else seen)
    values, turn = np.linalg.eigh(projected_covariance(fit, n, dims, origin, rest, basis[:, :dims]))
    values, vectors = values[::-1], (basis[:, :dims] @ turn)[:, ::-1]
    model = Whitening(n, sums, np.ascontiguousarray(vectors[:, :count]), values[:count], float(values.sum()))
    some = model.map[:, model.varies]
    if some.shape[1]:
        error = projected_covariance(fit, n, dims, origin, rest, some) - np.eye(some.shape[1])
        model.identity_error = float(np.abs(error).max())
    return model


def _whiten(model: Whitening):
    dims, k = model.components.shape
    explained = np.maximum(model.values, 0) / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            white = ((x - model.origin) - model.rest) @ model.map
            rows = len(x)
            white = pa.array(white.ravel(), mask=~np.tile(model.varies, rows))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n)), pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                white, pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, model.identity_error))],
                ["vec", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", count: int = 16) -> DataFrame:
    """Per usable row and component: ``id``, component, n, deviation, whitened, explained, identity_error."""
    kind = rows.schema[id].dataType.simpleString()
    schema = f"vec {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit_whitening(rows, vector, count)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("vec", id)
    v = F.col(f"`{vector}`")
    own = columns(rows, id, vector).where(usable(v) & (F.size(v) == len(model.sums))) \
        .select(F.col(f"`{id}`").alias("vec"), whole_numbers(v).alias("x"))
    return map_arrow(own, _whiten(model), schema).withColumnRenamed("vec", id)
