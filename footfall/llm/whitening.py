"""Whitening of embeddings by incremental eigendecomposition.

Every entry c of a vector becomes the integer x = floor(64 c) + 1000000; the fit list is each distinct x
vector once. Each partition of the fit list keeps the eigendecomposition of its scatter matrix and takes
in one vector after the other: a vector moves the mean and adds a centred rank-one term, whose effect on
the spectrum is the roots of a secular equation (`SymmetricSpectrum.add`). Directions that the term does not
touch are deflated, equal eigenvalues are first turned so that it touches one of them only, and eigenvectors are
formed from recomputed weights, which keeps them orthogonal. Spectra of partitions are combined the
same way, by one rank-one update for each eigenpair of the other and one for the difference of the
means, ``FAN_IN`` at a time until one is left. Rayleigh-Ritz passes over the fit list then refine the basis:
the exactly centred rows are projected on it, their Gram matrix is summed, and its eigenvectors turn
the basis, until the projections are uncorrelated to ``SETTLED``.

All sums of x are integers; rows are centred as x minus an integer near the mean minus a remainder below 1, so no
digits are lost. A task holds one batch of rows and dims x dims numbers.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries take no part; a null id
is kept; repeated vectors count once in the fit and are returned each; other columns are ignored; an empty table
gives no rows. A component without variance (fewer distinct vectors than dimensions, or a linear relation
between them) has whitened and explained 0, and is left out of identity_error. Vectors of different lengths, or
entries whose x does not fit 64 bits, raise an error. A deviation beyond 64 bits is null; ``deviation_text``
holds it in decimal digits always.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
FAN_IN = 16
#: Rayleigh-Ritz passes end when no two components are correlated by more than this.
SETTLED, MAX_PASSES = 1e-11, 6
_EPS = np.finfo(np.float64).eps
_ROOT_STEPS = 100


# ------------------------------------------------------------------ rank-one updates

def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> np.ndarray:
    """The differences d[i] - root[j] (row i, column j) for the roots of 1 + rho sum(z2 / (d - root)) = 0.

    ``d`` rises strictly, ``z2`` and ``rho`` are positive: root j lies between d[j] and d[j+1], the last one at most
    rho sum(z2) above d[-1]. Each root is sought as its distance from the nearer of the two poles
    beside it, which keeps the differences to the poles accurate. All roots are sought at once; a step that
    leaves a root's bracket is replaced by halving the bracket.
    """
    k = len(d)
    at = np.arange(k)
    width = np.append(np.diff(d), rho * z2.sum())
    gaps = d[:, None] - d[None, :]
    half = gaps - width / 2
    left = 1 / rho + (z2[:, None] / half).sum(axis=0) >= 0     # the root is in the lower half
    left[-1] = True
    pole = np.where(left, at, np.minimum(at + 1, k - 1))
    gaps = d[:, None] - d[pole][None, :]
    lo = np.where(left, 0.0, -width / 2)
    hi = np.where(left, np.where(at == k - 1, width, width / 2), 0.0)
    below = at[:, None] <= at[None, :]
    tau = (lo + hi) / 2
    up = np.minimum(at + 1, k - 1)
    for _ in range(_ROOT_STEPS):
        delta = gaps - tau
        terms = z2[:, None] / delta
        f = 1 / rho + terms.sum(axis=0)
        size = 1 / rho + np.abs(terms).sum(axis=0)
        lo, hi = np.where(f < 0, tau, lo), np.where(f < 0, hi, tau)
        done = (np.abs(f) <= _EPS * size) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        slope = terms / delta
        all_slope, psi = slope.sum(axis=0), np.where(below, slope, 0.0).sum(axis=0)
        near, far = delta[at, at], delta[up, at]
        # the sums of either side as one pole each, with the right value and slope: a quadratic for the step
        c = f - near * psi - far * (all_slope - psi)
        a = (near + far) * f - near * far * all_slope
        b = near * far * f
        # the last root has no pole above it: one pole and a constant
        c[-1], a[-1], b[-1] = f[-1] - near[-1] * all_slope[-1], near[-1] * (f[-1] - near[-1] * all_slope[-1]) + near[-1] ** 2 * all_slope[-1], 0.0
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = near[-1] + near[-1] ** 2 * all_slope[-1] / c[-1]
        new = tau + step
        inside = (new > lo) & (new < hi)
        tau = np.where(done, tau, np.where(inside, new, (lo + hi) / 2))
    return gaps - tau


@dataclass
class SymmetricSpectrum:
    """Eigenvalues (rising) and eigenvectors (columns) of a positive semidefinite matrix."""

    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def zero(cls, dims: int) -> SymmetricSpectrum:
        return cls(np.zeros(dims), np.eye(dims))

    def add(self, v: np.ndarray, rho: float = 1.0) -> None:
        """Adds rho v v^T."""
        z = self.vectors.T @ v
        norm = float(np.sqrt(z @ z))
        rho *= norm * norm
        if not rho > 0:
            return
        z /= norm
        d = self.values
        tiny = 8 * _EPS * max(d[-1], rho)
        self._gather(z, tiny)
        touched = rho * np.abs(z) > tiny
        k = np.flatnonzero(touched)
        if not len(k):
            return
        d_k, z_k = d[k], z[k]
        delta = secular_roots(d_k, z_k * z_k, rho)
        # the weights for which the computed roots are exact; eigenvectors made of them are orthogonal
        between = d_k[None, :] - d_k[:, None]
        np.fill_diagonal(between, rho)
        weight = np.sqrt(np.abs(np.prod(-delta / between, axis=1)))
        w = np.copysign(weight, z_k)[:, None] / delta
        w /= np.sqrt((w * w).sum(axis=0))
        values = d.copy()
        at = np.arange(len(k))
        values[k] = d_k - delta[at, at]
        self.vectors[:, k] = self.vectors[:, k] @ w
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.vectors = self.vectors[:, order]

    def _gather(self, z: np.ndarray, tiny: float) -> None:
        """Turns the eigenvectors of eigenvalues within ``tiny`` of each other so that z has one entry among them."""
        d = self.values
        close = np.diff(d) <= tiny
        if not close.any():
            return
        i = 0
        while i < len(d) - 1:
            j = i + int(np.searchsorted(d[i:], d[i] + tiny, side="right"))
            if j - i > 1:
                u = z[i:j].copy()
                size = float(np.sqrt(u @ u))
                if size > 0:
                    sign = 1.0 if u[-1] >= 0 else -1.0
                    u[-1] += sign * size
                    u /= np.sqrt(u @ u)
                    block = self.vectors[:, i:j]
                    self.vectors[:, i:j] = block - 2 * np.outer(block @ u, u)
                    z[i:j] = 0.0
                    z[j - 1] = -sign * size
            i = j


@dataclass
class CentredSpectrum:
    """Number, mean and scatter spectrum of a list of vectors. Means are relative to OFFSET."""

    n: int
    mean: np.ndarray
    scatter: SymmetricSpectrum

    @classmethod
    def empty(cls, dims: int) -> CentredSpectrum:
        return cls(0, np.zeros(dims), SymmetricSpectrum.zero(dims))

    def take(self, x: np.ndarray) -> None:
        """One vector more: the scatter about the new mean grows by one rank-one term."""
        away = x - self.mean
        self.scatter.add(away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def join(self, other: CentredSpectrum) -> None:
        """The vectors of ``other`` too: one rank-one update for each eigenpair and one for the means."""
        if not other.n:
            return
        for value, vector in zip(other.scatter.values, other.scatter.vectors.T):
            if value > 0:
                self.scatter.add(vector, float(value))
        away, n = other.mean - self.mean, self.n + other.n
        self.scatter.add(away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def record(self) -> tuple[int, bytes]:
        return self.n, np.concatenate([self.mean, self.scatter.values, self.scatter.vectors.ravel()]).tobytes()

    @classmethod
    def of_record(cls, n: int, data: bytes) -> CentredSpectrum:
        flat = np.frombuffer(data, np.float64)
        dims = int(round((len(flat) + 1) ** 0.5)) - 1          # dims + dims + dims * dims numbers
        return cls(n, flat[:dims].copy(), SymmetricSpectrum(flat[dims:2 * dims].copy(), flat[2 * dims:].reshape(dims, dims).copy()))


# ------------------------------------------------------------------ frames

def whole_numbers(c: Column) -> Column:
    """The vector's entries as x."""
    return F.transform(c, lambda e: F.floor(e.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))


def _usable(c: Column) -> Column:
    wrong = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & ~wrong


def _matrix(b: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.asarray(b.column("x").flatten()).reshape(b.num_rows, dims)


def partition_spectra(fit: DataFrame, dims: int) -> DataFrame:
    """One row for each partition of ``fit`` (x): its number of vectors, exact sums and spectrum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, sums, part = CentredSpectrum.empty(dims), [0] * dims, None
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("part")[:1]
            x = _matrix(b, dims)
            sums = [s + t for s, t in zip(sums, _exact_sums(x))]
            for row in (x - OFFSET).astype(np.float64):
                have.take(row)
        if have.n:
            n, data = have.record()
            yield pa.RecordBatch.from_pydict({"place": part, "n": pa.array([n], pa.int64()), "sums": pa.array([[str(s) for s in sums]], pa.list_(pa.string())),
                                              "spectrum": pa.array([data], pa.binary())})

    return fit.select("x", F.spark_partition_id().cast("long").alias("part")).mapInArrow(
        run, "place long, n long, sums array<string>, spectrum binary")


def _exact_sums(x: np.ndarray) -> list[int]:
    if int(np.abs(x).max()) < (1 << 62) // len(x):
        return [int(s) for s in x.sum(axis=0)]
    return [sum(col) for col in x.T.tolist()]


def combined_spectrum(spark: SparkSession, parts: DataFrame) -> CentredSpectrum:
    """All spectra of ``parts`` as one: FAN_IN at a time in one task, round after round."""

    def join(rows: pa.Table) -> pa.Table:
        some = [CentredSpectrum.of_record(n.as_py(), d.as_py()) for n, d in zip(rows.column("n"), rows.column("spectrum"))]
        some.sort(key=lambda s: (-s.n, s.mean.tobytes()))
        for s in some[1:]:
            some[0].join(s)
        n, data = some[0].record()
        return pa.table({"place": pa.array([rows.column("place")[0].as_py() // FAN_IN], pa.int64()), "n": pa.array([n], pa.int64()),
                         "spectrum": pa.array([data], pa.binary())})

    schema = "place long, n long, spectrum binary"
    now = parts.select("place", "n", "spectrum")
    last = now.agg(F.max("place")).first()[0]
    while last:
        now = written(spark, now.groupBy(F.expr(f"place div {FAN_IN}")).applyInArrow(join, schema), "spectra")
        last //= FAN_IN
    row = now.first()
    return CentredSpectrum.of_record(row["n"], bytes(row["spectrum"]))


@dataclass
class Centre:
    """The exact centre S / n of the fit list, as an integer and a remainder below 1 in each dimension."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.floor = [s // self.n for s in self.sums]
        self.over = [s - self.n * f for s, f in zip(self.sums, self.floor)]
        self.whole, self.part = np.array(self.floor, np.int64), np.array([r / self.n for r in self.over])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum (n x - S)^2 of each row, exact."""
        away = x - self.whole
        bound = (int(np.abs(away).max()) + 1) * self.n if len(x) else 0
        if bound * bound * x.shape[1] < 1 << 63:
            d = away * self.n - np.array(self.over, np.int64)
            return (d * d).sum(axis=1).tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, self.over)) for row in away.tolist()]


def gram(fit: DataFrame, centre: Centre, basis: np.ndarray) -> np.ndarray:
    """Covariance of the fit list's projections on ``basis``, summed over the partitions."""
    dims, n = basis.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for b in batches:
            if b.num_rows:
                y = centre.centred(_matrix(b, dims)) @ basis
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(n * n)), "value": pa.array(total.ravel())})

    sums = fit.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(n * n)
    out[sums["at"].to_numpy()] = sums["value"].to_numpy()
    return out.reshape(n, n) / centre.n


@dataclass
class Whitener:
    """Centre and leading components of a fit list."""

    centre: Centre
    vectors: np.ndarray        # dims x components, unit columns
    values: np.ndarray         # their eigenvalues, falling
    trace: float
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        y = self.centre.centred(x) @ self.vectors
        return np.divide(y, np.sqrt(self.values), out=np.zeros_like(y), where=self.values > 0)


def refined(fit: DataFrame, centre: Centre, spectrum: CentredSpectrum, components: int) -> Whitener:
    """Rayleigh-Ritz passes from the combined spectrum's basis."""
    basis = np.linalg.qr(spectrum.scatter.vectors[:, ::-1])[0]
    trace, values, found = None, None, None
    for _ in range(MAX_PASSES):
        found = gram(fit, centre, basis)
        trace = float(np.trace(found)) if trace is None else trace
        if values is not None:
            real = _with_variance(values)
            scale = np.sqrt(np.where(real, values, 1.0))
            error = np.abs(found / np.outer(scale, scale) - np.eye(len(values)))[np.ix_(real, real)]
            if not error.size or error.max() <= SETTLED:
                break
        values, turn = np.linalg.eigh((found + found.T) / 2)
        values, basis = values[::-1], np.linalg.qr(basis @ turn[:, ::-1])[0]
    keep = min(components, len(values))
    real = _with_variance(values)[:keep]
    lead, e = basis[:, :keep], np.where(real, values[:keep], 0.0)
    lead = lead * np.where(lead[np.abs(lead).argmax(axis=0), np.arange(keep)] < 0, -1.0, 1.0)
    checked = gram(fit, centre, lead)
    scale = np.sqrt(np.where(real, e, 1.0))
    error = np.abs(checked / np.outer(scale, scale) - np.eye(keep))[np.ix_(real, real)]
    return Whitener(centre, lead, e, trace, float(error.max()) if error.size else 0.0)


def _with_variance(values: np.ndarray) -> np.ndarray:
    return values > 16 * len(values) * _EPS * max(float(values[0]), 0.0)


def fit_whitener(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of ``vectors`` (x, already whole numbers); None for an empty frame."""
    lengths = vectors.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if lengths["least"] is None:
        return None
    if lengths["least"] != lengths["most"]:
        raise ValueError(f"vectors of {lengths['least']} to {lengths['most']} entries: all need the same length")
    fit = written(spark, vectors.select("x").distinct(), "fit-list")
    parts = written(spark, partition_spectra(fit, lengths["most"]), "spectra")
    place = F.posexplode("sums").alias("at", "s")
    sums = parts.select(place).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    spectrum = combined_spectrum(spark, parts)
    return refined(fit, Centre(spectrum.n, [int(r["s"]) for r in sums]), spectrum, components)


def whitened_rows(spark: SparkSession, rows: DataFrame, model: Whitener | None) -> DataFrame:
    """One row for each row of ``rows`` (vec_id, x) and component."""
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double, "
              "deviation_text string")
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)       # dims x COMPONENTS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dims, k = m.vectors.shape
        explained = m.values / m.trace if m.trace > 0 else np.zeros(k)
        for b in batches:
            if not b.num_rows:
                continue
            x, r = _matrix(b, dims), b.num_rows
            dev = m.centre.deviations(x)
            each = pa.array(np.repeat(np.arange(r), k))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                pa.array(np.full(r * k, m.centre.n, np.int64)),
                pa.array([d if d < 1 << 63 else None for d in dev], pa.int64()).take(each),
                pa.array(m.whitened(x).ravel()), pa.array(np.tile(explained, r)), pa.array(np.full(r * k, m.identity_error)),
                pa.array([str(d) for d in dev], pa.string()).take(each)],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def whitened_embeddings(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vectors`` (vec_id, embedding) whitened on their own fit list: vec_id, component, n, deviation,
    whitened, explained, identity_error, deviation_text."""
    rows = vectors.where(_usable(F.col("embedding"))).select("vec_id", whole_numbers(F.col("embedding")).alias("x"))
    return whitened_rows(spark, rows, fit_whitener(spark, rows, components))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
