"""Embedding whitening by incremental eigendecomposition (operator 12).

Entries become integers (``floor(1024 c) + 100000``).  Every partition keeps the
eigendecomposition of the scatter matrix of the vectors that it has seen and
updates it with each further vector: a vector x changes the scatter around
the running mean m of k vectors by k / (k + 1) (x - m)(x - m)^T, a centred
rank-one update.  Its eigenvalues are the roots of the secular equation
1 + rho sum z_i^2 / (d_i - t) = 0, one between each two old eigenvalues, after
deflation of entries z_i that vanish and of old eigenvalues that coincide; the
eigenvectors come from the z that belongs exactly to the roots found, so they
stay orthogonal.  Two spectra are combined by successive rank-one updates, one
per eigenpair of the second and one for the distance of the means, in a tree
of tasks.  A last distributed Rayleigh-Ritz step projects the covariance on
that basis, centred exactly by the integer sums, and turns the basis to
double precision.

Work: O(d^3) a vector for dimension d; state: one d x d matrix a partition.
The driver holds one such matrix and d integer sums.

Defined results: a null or empty vector, one with a null or non-finite entry
and one of another length than the most frequent are left out, without rows;
entries beyond 2^53 after scaling are set to it; a null id stays an id, equal
rows count each; a component without variance (e at most 1e-13 of the trace;
all of them for a single vector) has ``whitened`` null and no part in
``identity_error``, which is null if there is no other; ``explained`` is null if the
trace is 0; a ``deviation`` that no long holds is null; an empty table gives no
rows.  Columns beside id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.vectors import combined, integers_of, matrix_of, partition_states, width_of

SCALE, OFFSET, LARGEST = 1024, 100_000, 1 << 53
#: components of the result
COMPONENTS = 8
#: an eigenvalue up to this part of the trace counts as none
NO_VARIANCE = 1e-13
_EPS = float(np.finfo(np.float64).eps)
#: exact sums are kept as high * 2 ** _LIMB + low
_LIMB = 26


# -- rank-one update -------------------------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum z2_j / (d_j - t) for ascending, distinct d, z2 > 0, rho > 0.

    Returns (origin, tau): root i is d[origin_i] + tau_i, where the origin is
    the nearer pole, so that its distance to the poles has no cancellation.
    All roots are iterated side by side: the middle-way rational step, kept in
    a bracket that every evaluation shortens.
    """
    k = len(d)
    weight = rho * z2
    upper = np.append(d[1:], d[-1] + weight.sum())
    gap = upper - d
    rows = np.arange(k)                 # roots still iterated
    below = np.tri(k)                   # poles at most the left one of root i
    origin = rows
    shifted = d - d[:, None]            # poles seen from the origin
    tau = 0.5 * gap
    low, high = np.zeros(k), gap
    with np.errstate(all="ignore"):
        for turn in range(100):
            inverse = 1.0 / (shifted - tau[rows, None])
            square = inverse * inverse
            f = 1.0 + inverse @ weight
            noise = 8 * _EPS * (1.0 + np.abs(inverse) @ weight)
            steep = square @ weight
            square *= below
            psi = square @ weight       # the slope that the poles below add
            t = tau[rows]
            is_low = f < 0              # f rises from pole to pole
            if turn == 0:
                # the half that holds the root names its origin; above the last root there is no pole
                right = is_low.copy()
                right[-1] = False
                origin = rows + right
                shifted = d - d[origin][:, None]
                move = np.where(right, gap, 0.0)
                low, high, t = low - move, high - move, t - move
                left_pole, right_pole = -move, gap - move
                low[is_low], high[~is_low] = t[is_low], t[~is_low]
            else:
                low[rows[is_low]], high[rows[~is_low]] = t[is_low], t[~is_low]
            lo, hi = low[rows], high[rows]
            more = (np.abs(f) > noise) & (hi - lo > 4 * _EPS * np.abs(t))
            da, db = left_pole[rows] - t, right_pole[rows] - t
            both = da * db
            c = f - da * psi - db * (steep - psi)
            a = (da + db) * f - both * steep
            b = both * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            if rows[-1] == k - 1:
                step[-1] = da[-1] + da[-1] ** 2 * psi[-1] / (f[-1] - da[-1] * psi[-1])
            following = t + step
            inside = (following > lo) & (following < hi)
            following = np.where(inside, following, 0.5 * (lo + hi))
            tau[rows] = np.where(more, following, t)
            if not more.any():
                break
            rows = rows[more]
            if len(rows) < k:
                shifted, below = d - d[origin[rows]][:, None], np.tri(k)[rows]
    return origin, tau


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors (the rows) of basis^T diag(values) basis + rho vector vector^T."""
    z = basis @ vector
    norm2 = float(z @ z)
    if not rho * norm2 > 0.0:
        return values, basis
    weight = rho * norm2
    z /= np.sqrt(norm2)
    tol = 8 * _EPS * max(float(values[-1]), weight)
    live = weight * np.abs(z) > tol
    if not live.any():
        return values, basis
    if (np.diff(values[live]) <= tol).any():
        # coinciding eigenvalues: a reflection turns their part of z into one entry
        basis = basis.copy()
        place = np.flatnonzero(live)
        for group in np.split(place, np.flatnonzero(np.diff(values[place]) > tol) + 1):
            if len(group) > 1:
                mirror = z[group]
                size = np.copysign(np.sqrt(mirror @ mirror), mirror[-1])
                mirror[-1] += size
                rows = basis[group]
                basis[group] = rows - np.outer(mirror * (2.0 / (mirror @ mirror)), mirror @ rows)
                z[group[:-1]], z[group[-1]] = 0.0, -size
                live[group[:-1]] = False
    whole = live.all()
    d, zk, rows = (values, z, basis) if whole else (values[live], z[live], basis[live])
    k = len(d)
    if k == 1:
        roots = d + weight * zk * zk
    else:
        origin, tau = secular_roots(d, zk * zk, weight)
        roots = d[origin] + tau
        away = (d[origin][:, None] - d) + tau[:, None]  # root i - pole j, without cancellation
        # the z whose roots these are exactly (products over the roots, each beside its own pole)
        apart = d[:, None] - d
        beside = np.where(np.tri(k - 1, k, dtype=bool), apart[1:], apart[:-1])
        exact2 = away[-1] * np.prod(away[:-1] / beside, axis=0)
        turn = np.copysign(np.sqrt(np.abs(exact2)), zk) / away
        turn /= np.sqrt(np.einsum("ij,ij->i", turn, turn))[:, None]
        rows = turn @ rows
    if whole:
        return roots, rows  # roots ascend
    values, basis = values.copy(), basis.copy()
    values[live], basis[live] = roots, rows
    order = np.argsort(values, kind="stable")
    return values[order], basis[order]


# -- spectra ---------------------------------------------------------------

_STATE = ("n bigint, high array<bigint>, low array<bigint>, mean array<double>, "
          "eigenvalues array<double>, basis array<double>")


def _sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact column sums in two limbs."""
    return (x >> _LIMB).sum(axis=0), (x & ((1 << _LIMB) - 1)).sum(axis=0)


def _carried(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return high + (low >> _LIMB), low & ((1 << _LIMB) - 1)


def integer_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    place, values = matrix_of(column, width)
    return place, integers_of(values, SCALE, LARGEST) + OFFSET


def partition_spectrum(batches: Iterator[pa.RecordBatch], width: int) -> dict | None:
    """The spectrum of a partition's vectors by one rank-one update each."""
    n, mean = 0, np.zeros(width)
    values, basis = np.zeros(width), np.eye(width)
    high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for batch in batches:
        _, x = integer_vectors(batch.column(0), width)
        more = _sums(x)
        high, low = _carried(high + more[0], low + more[1])
        for row in x.astype(np.float64):
            away = row - mean
            if n:
                values, basis = rank_one(values, basis, away, n / (n + 1))
            n += 1
            mean = mean + away / n
    if not n:
        return None
    return {"n": n, "high": high, "low": low, "mean": mean, "eigenvalues": values, "basis": basis.ravel()}


def merged(a: dict, b: dict) -> dict:
    """Two spectra as one, by successive rank-one updates of the first."""
    mean_a, mean_b = np.asarray(a["mean"]), np.asarray(b["mean"])
    width = len(mean_a)
    values, basis = np.array(a["eigenvalues"], dtype=np.float64), np.array(a["basis"]).reshape(width, width)
    other = np.array(b["basis"]).reshape(width, width)
    for value, vector in zip(b["eigenvalues"], other):
        if value > 0:
            values, basis = rank_one(values, basis, vector, float(value))
    n = a["n"] + b["n"]
    values, basis = rank_one(values, basis, mean_b - mean_a, a["n"] * b["n"] / n)
    high, low = _carried(np.asarray(a["high"]) + np.asarray(b["high"]), np.asarray(a["low"]) + np.asarray(b["low"]))
    return {"n": n, "high": high, "low": low, "mean": mean_a + (mean_b - mean_a) * (b["n"] / n),
            "eigenvalues": values, "basis": basis.ravel()}


class Model:
    """The fitted components: exact n and sums, unit eigenvectors (one a column), eigenvalues."""

    def __init__(self, n: int, sums: list[int], basis: np.ndarray) -> None:
        self.n, self.sums, self.basis = n, sums, basis
        self.whole = np.array([s // n for s in sums], dtype=np.int64)   # S / n = whole + rest / n
        self.rest = [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])
        self.eigenvalues = np.zeros(basis.shape[1])
        self.trace = 0.0
        self.identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.fraction

    def usable(self) -> np.ndarray:
        """Numbers (from 0) of the leading components that have variance."""
        e = self.eigenvalues[:COMPONENTS]
        return np.flatnonzero((e > NO_VARIANCE * self.trace) & (e > 0))

    def whitened(self, x: np.ndarray, components: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.basis[:, components] / np.sqrt(self.eigenvalues[components])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum (n x - S)^2, exactly, per row; None beyond a long."""
        away, n = x - self.whole, self.n
        most = int(np.abs(away).max(initial=0))
        kind = np.int64 if most * most * len(self.sums) < 1 << 62 and most * n * len(self.sums) < 1 << 62 else object
        away, rest = away.astype(kind), np.array(self.rest, dtype=kind)
        squares, crossed = (away * away).sum(axis=1), (away * rest).sum(axis=1)
        own = sum(r * r for r in self.rest)
        exact = [n * n * int(s) - 2 * n * int(c) + own for s, c in zip(squares, crossed)]
        return [v if v < 1 << 63 else None for v in exact]


_MOMENTS = "total array<double>, products array<double>"


def _moments(batches: Iterator[pa.RecordBatch], width: int, project) -> dict | None:
    """Sums and sums of products of the projected vectors of a partition."""
    total, products = 0.0, 0.0
    for batch in batches:
        _, x = integer_vectors(batch.column(0), width)
        if len(x):
            y = project(x)
            total, products = total + y.sum(axis=0), products + y.T @ y
    return None if np.isscalar(total) else {"total": total, "products": products.ravel()}


def _added(a: dict, b: dict) -> dict:
    return {k: np.asarray(a[k]) + np.asarray(b[k]) for k in ("total", "products")}


def _covariance(vectors: DataFrame, width: int, project, n: int) -> np.ndarray:
    """Covariance (divisor n) of the projected vectors, from one distributed pass."""
    found = combined(partition_states(vectors, lambda b: _moments(b, width, project), _MOMENTS), _added, _MOMENTS)
    mean = np.array(found["total"]) / n
    return np.array(found["products"]).reshape(len(mean), len(mean)) / n - np.outer(mean, mean)


def fit(table: DataFrame, vector_col: str = "embedding") -> Model | None:
    """Components of all vectors of a table; None if there is no vector."""
    width = width_of(table, vector_col)
    if not width:
        return None
    vectors = table.select(F.col(vector_col).cast("array<double>"))
    spectra = partition_states(vectors, lambda b: partition_spectrum(b, width), _STATE)
    spectrum = combined(spectra, merged, _STATE)
    if spectrum is None:
        return None
    sums = [(h << _LIMB) + l for h, l in zip(spectrum["high"], spectrum["low"])]
    # the combined basis, largest eigenvalue first, orthonormal to rounding
    start, _ = np.linalg.qr(np.array(spectrum["basis"]).reshape(width, width)[::-1].T)
    model = Model(spectrum["n"], sums, start)
    # Rayleigh-Ritz: the covariance in that basis is diagonal but for the error of the updates
    covariance = _covariance(vectors, width, lambda x: model.centred(x) @ start, model.n)
    values, turn = np.linalg.eigh(covariance)
    basis = start @ turn[:, ::-1]
    model.basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(width)] < 0, -1.0, 1.0)
    model.eigenvalues, model.trace = values[::-1], float(np.trace(covariance))
    used = model.usable()
    if len(used):
        spread = _covariance(vectors, width, lambda x: model.whitened(x, used), model.n)
        model.identity_error = float(np.abs(spread - np.eye(len(used))).max())
    return model


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and leading component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    model = fit(table, vector_col)
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    width = len(model.sums)
    shown = min(COMPONENTS, width)
    explained = [float(e) / model.trace if model.trace > 0 else None for e in model.eigenvalues[:shown]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = model.usable()
        for batch in batches:
            place, x = integer_vectors(batch.column(1), width)
            rows = len(x)
            values = np.full((rows, shown), np.nan)
            values[:, used] = model.whitened(x, used)
            ids = batch.column(0).take(pa.array(np.repeat(place, shown)))
            yield pa.record_batch([
                ids, pa.array(np.tile(np.arange(1, shown + 1), rows), pa.int32()),
                pa.array(np.full(rows * shown, model.n), pa.int64()),
                pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), shown))),
                pa.array(values.ravel(), pa.float64(), from_pandas=True),
                pa.array(explained * rows, pa.float64()),
                pa.array([model.identity_error] * (rows * shown), pa.float64())], names=schema_names)

    schema_names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return table.select(F.col(id_col).cast("bigint"), F.col(vector_col).cast("array<double>")).mapInArrow(run, schema)
