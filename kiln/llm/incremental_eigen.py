"""Embedding whitening by incremental eigendecomposition.

Spectrum. The scatter matrix of some rows is kept as U diag(d) U^T beside their number and mean. A new
row x changes it by one centred rank-one term, n / (n + 1) * (x - mean)(x - mean)^T, and the new
eigenvalues are the roots of the secular equation 1 + rho * sum z_i^2 / (d_i - lambda) = 0 with
z = U^T (x - mean). Entries of z that vanish leave their pair as it is, and equal eigenvalues are rotated
so that one of them carries their whole z (deflation). Every root is found relative to its nearest pole;
z is recomputed from the roots (Gu and Eisenstat), which keeps the new eigenvectors orthogonal.

On Spark: each task streams its rows through these updates and returns one spectrum. Spectra meet in
groups of ``FAN`` per round, by successive rank-one updates with the scaled eigenvectors of the other
and one for the distance of the means. A last pass refines: with the orthonormal basis found, all tasks
sum its Rayleigh quotient over the centred rows, whose eigenvectors (Ritz vectors) turn the basis. As
the basis is complete, the result has the accuracy of that sum, whatever rounding the updates left.
Rows are x - round(S / n) in the updates and (n x - S) / n in the refinement, whole numbers before they
become doubles, so a large offset common to all vectors costs no digits.

Defined results: vectors that are null or hold null or non-finite entries are dropped; entries saturate
at +-2^62 before the offset; vectors of different lengths are fitted apart, each length by its own rows;
empty vectors give no rows; components whose eigenvalue is zero to double precision (constant or repeated
dimensions, or fewer rows than dimensions) have no whitened value and are not returned; a deviation
beyond the range of a long is null; a null id stays null; repeated rows count and are returned each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import slices, stored
from kiln.llm.segment_search import matrix, scaled

FAN = 16        # partial results that one task combines
EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """Matrix of d_i - lambda_j for the eigenvalues lambda of diag(d) + rho z z^T; ``d`` rising and
    distinct, no entry of ``z`` zero, ``rho`` > 0. Bracketed two-pole rational steps, all roots at once."""
    k = len(d)
    w0 = rho * z * z
    top = d[-1] + w0.sum()
    right = np.append(d[1:], top)
    mid = (d + right) / 2
    below = np.tril(np.ones((k, k), bool)).T                       # [i, j]: pole i <= j
    f = 1 + (w0[:, None] / (d[:, None] - mid[None, :])).sum(axis=0)
    near = np.arange(k) + (f < 0)
    near[-1] = k - 1                                               # the last root has one pole only
    origin = d[near]
    delta = d[:, None] - origin[None, :]
    lo, hi = d - origin, right - origin
    left = (f >= 0) | (np.arange(k) == k - 1)
    lo = np.where((f < 0), mid - origin, lo)
    hi = np.where((f >= 0), mid - origin, hi)
    mu = (lo + hi) / 2
    mu = np.where(left & (f >= 0), hi / 2, mu)
    gap1, gap2 = d - origin, right - origin
    done = np.zeros(k, bool)
    for _ in range(100):
        diff = delta - mu[None, :]
        w = w0[:, None] / diff
        dw = w / diff
        psi, phi = (w * below).sum(axis=0), (w * ~below).sum(axis=0)
        dpsi, dphi = (dw * below).sum(axis=0), (dw * ~below).sum(axis=0)
        f = 1 + psi + phi
        done |= np.abs(f) <= 4 * EPS * (1 + np.abs(psi) + np.abs(phi))
        lo, hi = np.where(f < 0, np.maximum(lo, mu), lo), np.where(f > 0, np.minimum(hi, mu), hi)
        done |= hi - lo <= 2 * EPS * np.abs(mu)
        if done.all():
            break
        p, q = gap1 - mu, gap2 - mu
        c = 1 + psi - p * dpsi + phi - q * dphi
        a = c * (p + q) + p * p * dpsi + q * q * dphi
        b = p * q * f
        last = np.arange(k) == k - 1
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            single = p + p * p * dpsi / (1 + psi - p * dpsi)        # one pole: 1 + r + s / (p - step) = 0
        step = np.where(last, single, step)
        new = mu + step
        bad = ~np.isfinite(new) | (new <= lo) | (new >= hi)
        mu = np.where(done, mu, np.where(bad, (lo + hi) / 2, new))
    return delta - mu[None, :]


def deflated(d: np.ndarray, u: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """Indices of the pairs that the update changes. Rotates columns of ``u`` and ``z`` in place so that
    of equal eigenvalues only the last has an entry in ``z``."""
    size = max(np.abs(d).max(initial=0), rho * float(z @ z))
    tol = 8 * EPS * size
    first = 0
    while first < len(d):
        stop = int(np.searchsorted(d, d[first] + tol, side="right"))
        if stop - first > 1:
            v = z[first:stop].copy()
            norm = float(np.linalg.norm(v))
            if norm > 0:                                           # Householder: v becomes (0, ..., 0, -+norm)
                v[-1] += np.copysign(norm, v[-1])
                v /= np.linalg.norm(v)
                u[:, first:stop] -= 2 * np.outer(u[:, first:stop] @ v, v)
                last = z[stop - 1]
                z[first:stop] = 0
                z[stop - 1] = -np.copysign(norm, last)
        first = max(stop, first + 1)
    return np.flatnonzero(rho * np.abs(z) * np.sqrt(float(z @ z)) > tol)


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of u diag(d) u^T + rho v v^T, ``rho`` >= 0."""
    z = u.T @ v
    if not rho > 0 or not np.any(z):
        return d, u
    d, u = d.copy(), u.copy()
    active = deflated(d, u, z, rho)
    if not len(active):
        return d, u
    e, y = d[active], z[active]
    diff = secular_roots(e, y, rho)
    # the z for which these roots are exact: products of ratios of differences, all positive
    gaps = e[:, None] - e[None, :]
    np.fill_diagonal(gaps, -1)
    fitted = np.sqrt(np.abs(np.prod(diff / gaps, axis=1))) * np.where(y < 0, -1.0, 1.0)
    q = fitted[:, None] / diff
    q /= np.linalg.norm(q, axis=0)
    d[active] = e - np.diagonal(diff)
    u[:, active] = u[:, active] @ q
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


class Spectrum:
    """Number, mean and eigendecomposition of the scatter matrix of some rows."""

    def __init__(self, n: int, mean: np.ndarray, d: np.ndarray, u: np.ndarray):
        self.n, self.mean, self.d, self.u = n, mean, d, u

    @staticmethod
    def empty(dim: int) -> Spectrum:
        return Spectrum(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        v = x - self.mean
        self.d, self.u = rank_one(self.d, self.u, v, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + v / self.n

    def merge(self, other: Spectrum) -> None:
        n = self.n + other.n
        for e, v in zip(other.d, other.u.T, strict=True):
            self.d, self.u = rank_one(self.d, self.u, v, max(float(e), 0.0))
        v = other.mean - self.mean
        self.d, self.u = rank_one(self.d, self.u, v, self.n * other.n / n)
        self.mean = self.mean + v * (other.n / n)
        self.n = n

    def pack(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.d, self.u.ravel()]).tobytes()

    @staticmethod
    def unpack(b: bytes, dim: int) -> Spectrum:
        a = np.frombuffer(b)
        return Spectrum(int(a[0]), a[1:1 + dim], a[1 + dim:1 + 2 * dim], a[1 + 2 * dim:].reshape(dim, dim))


class Moments:
    """Number, mean and scatter matrix of some rows; batches are centred before they are multiplied."""

    def __init__(self, n: int, mean: np.ndarray, scatter: np.ndarray):
        self.n, self.mean, self.scatter = n, mean, scatter

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        return Moments(len(x), mean, (x - mean).T @ (x - mean))

    def merge(self, other: Moments) -> None:
        n = self.n + other.n
        v = other.mean - self.mean
        self.scatter = self.scatter + other.scatter + np.outer(v, v) * (self.n * other.n / n)
        self.mean, self.n = self.mean + v * (other.n / n), n

    def pack(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.scatter.ravel()]).tobytes()

    @staticmethod
    def unpack(b: bytes, dim: int) -> Moments:
        a = np.frombuffer(b)
        return Moments(int(a[0]), a[1:1 + dim], a[1 + dim:].reshape(dim, dim))


def merged(parts: DataFrame, kind: type, size: dict[int, int], name: str) -> dict[int, bytes]:
    """Partial results (dim, part, body), one per task and length, combined in groups of ``FAN`` per
    round until each length has one; ``size``: entries of a mean by length."""
    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(rows["dim"].iloc[0])
        bodies = list(rows.sort_values("part")["body"])
        out = kind.unpack(bodies[0], size[dim])
        for b in bodies[1:]:
            out.merge(kind.unpack(b, size[dim]))
        return pd.DataFrame({"dim": [dim], "part": [int(rows["part"].iloc[0]) // FAN], "body": [out.pack()]})

    schema = "dim int, part long, body binary"
    parts = stored(parts, name)
    while parts.groupBy("dim").count().agg(F.max("count")).first()[0] not in (None, 1):
        parts = parts.groupBy("dim", F.expr(f"part div {FAN}")).applyInPandas(combine, schema)
        parts = stored(parts, name)
    return {r["dim"]: bytes(r["body"]) for r in parts.collect()}


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches with vectors of one length, as rows of whole numbers."""
    for batch in slices(batches, 2_048):
        dims = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            part = batch.take(pa.array(np.flatnonzero(dims == dim)))
            yield int(dim), part, matrix(part.column("x"), int(dim))


def _per_task(update: Callable, finish: Callable = lambda state: state.pack()):
    """Folds a task's rows into one state per length: rows of (dim, part, body)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict = {}
        for dim, _, x in _groups(batches):
            states[dim] = update(states.get(dim), dim, x)
        part = TaskContext.get().partitionId()
        if states:
            yield pa.RecordBatch.from_arrays([pa.array(list(states), pa.int32()), pa.array([part] * len(states), pa.int64()),
                                              pa.array([finish(s) for s in states.values()], pa.binary())], names=["dim", "part", "body"])
    return run


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S exactly: longs where they must fit, else Python integers."""
    top = max([abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))])
    kind = np.int64 if n * top < 2 ** 62 and max(map(abs, total), default=0) < 2 ** 62 else object
    return x.astype(kind) * n - np.array(total, kind)


def _squares(dev: np.ndarray) -> list[int | None]:
    """Sums of squares per row, exactly; null beyond a long."""
    if dev.dtype != object and float(np.abs(dev.astype(np.float64)).max(initial=0)) ** 2 * dev.shape[1] < 2.0 ** 62:
        return (dev * dev).sum(axis=1).tolist()
    out = [sum(v * v for v in row) for row in dev.tolist()]
    return [v if v < 2 ** 63 else None for v in out]


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: int = 64,
             offset: int = 1_000_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every vector for the
    ``components`` largest eigenvalues, fitted on all vectors."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col), scale, offset).alias("x")).filter("size(x) > 0")

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, x in _groups(batches):
            top = max(abs(int(x.max())), abs(int(x.min())))
            s = x.sum(axis=0) if top * len(x) < 2 ** 62 else x.astype(object).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([len(x)] * dim, pa.int64()),
                                              pa.array([str(v) for v in s])], names=["dim", "place", "n", "s"])

    sums = rows.mapInArrow(partial_sums, "dim int, place int, n long, s string").groupBy("dim", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    fit: dict[int, tuple[int, list[int]]] = {}
    for r in sums.orderBy("dim", "place").collect():                # as many numbers as a vector has, per length
        fit.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    centre = {dim: [round(s / n) if abs(s) < 2 ** 53 else s // n for s in total] for dim, (n, total) in fit.items()}
    size = {dim: dim for dim in fit}

    def add(state: Spectrum | None, dim: int, x: np.ndarray) -> Spectrum:
        state = state or Spectrum.empty(dim)
        for row in (x - np.array(centre[dim], np.int64)).astype(np.float64):
            state.add(row)
        return state

    spectra = merged(rows.mapInArrow(_per_task(add), "dim int, part long, body binary"), Spectrum, size, "eigen-spectra")
    basis = {dim: np.linalg.qr(Spectrum.unpack(b, dim).u)[0] for dim, b in spectra.items()}

    def centred(dim: int, x: np.ndarray) -> np.ndarray:
        n, total = fit[dim]
        return (deviations(x, n, total) / n).astype(np.float64)

    def quotient(state: Moments | None, dim: int, x: np.ndarray) -> Moments:
        y = centred(dim, x) @ basis[dim]
        new = Moments(len(y), np.zeros(dim), y.T @ y)               # the mean of the centred rows is zero
        if state is None:
            return new
        state.n, state.scatter = state.n + new.n, state.scatter + new.scatter
        return state

    quotients = merged(rows.mapInArrow(_per_task(quotient), "dim int, part long, body binary"), Moments, size, "eigen-quotients")
    ritz: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
    for dim, b in quotients.items():
        v = Moments.unpack(b, dim).scatter / fit[dim][0]
        e, r = np.linalg.eigh((v + v.T) / 2)
        keep = np.flatnonzero(e > max(e[-1], 0) * dim * 64 * EPS)[::-1][:components]
        ritz[dim] = (e[keep], basis[dim] @ r[:, keep], float(np.trace(v)))

    def scores(dim: int, x: np.ndarray) -> np.ndarray:
        e, u, _ = ritz[dim]
        return centred(dim, x) @ u / np.sqrt(e)

    def spread(state: Moments | None, dim: int, x: np.ndarray) -> Moments:
        new = Moments.of(scores(dim, x))
        if state is None:
            return new
        state.merge(new)
        return state

    size_out = {dim: len(e) for dim, (e, _, _) in ritz.items()}
    spreads = merged(rows.mapInArrow(_per_task(spread), "dim int, part long, body binary"), Moments, size_out, "eigen-check")
    error = {}
    for dim, b in spreads.items():
        m = Moments.unpack(b, size_out[dim])
        error[dim] = float(np.abs(m.scatter / m.n - np.eye(size_out[dim])).max(initial=0))

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, x in _groups(batches):
            e, _, trace = ritz[dim]
            w, k = scores(dim, x), size_out[dim]
            each = np.repeat(np.arange(len(x)), k)
            dev = pa.array(_squares(deviations(x, *fit[dim])), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), fit[dim][0], np.int64)), dev.take(pa.array(each)), pa.array(w.ravel()),
                 pa.array(np.tile(e / trace if k else e, len(x))), pa.array(np.full(len(each), error[dim]))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(result, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
