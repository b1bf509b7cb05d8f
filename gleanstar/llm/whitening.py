"""Whitening of embeddings by QDWH spectral divide-and-conquer.

Spark tasks reduce the vectors to sums and to the covariance, one partial matrix a task;
the covariance, whose size is the square of the dimension whatever the number of rows, is
split on the driver: the polar factor of the covariance less a shift (QDWH iterations on
QR factorisations) gives the projector on the eigenvectors above the shift, its range and
the complement are split on, until single components are left. The scaled components go to
the tasks, which project their vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.rows import configure_batches

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Entries whose scaled value a double cannot hold as an integer count as not finite.
_LARGEST = 2.0**53
_EPS = np.finfo(float).eps


def qdwh(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps."""
    n = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return np.eye(n)
    x = a / size
    # a lower bound of the smallest singular value; too small a bound costs steps only
    low = max(np.abs(np.diag(np.linalg.qr(x, mode="r"))).min() / np.sqrt(n) * 0.1, _EPS * 0.01)
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square)) if square < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))[0]
        after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved < 10 * _EPS * np.sqrt(n) and 1 - low < 10 * _EPS:
            break
    return x


def _split(a: np.ndarray, shift: float):
    """Bases of the invariant subspaces above and below the shift, or None where the shift
    does not part them."""
    n = len(a)
    projector = (qdwh(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e-8:
        return None
    # the range of the projector from fixed random vectors, then once more from that range
    start = np.random.default_rng(n).standard_normal((n, k))
    basis = np.linalg.qr(projector @ start)[0]
    q = np.linalg.qr(projector @ basis, mode="complete")[0]
    above, below = q[:, :k], q[:, k:]
    if np.linalg.norm(below.T @ a @ above) > 1e-12 * n * np.linalg.norm(a):
        return None
    return above, below


def spectral(a: np.ndarray, floor: float | None = None) -> np.ndarray:
    """Orthonormal eigenvectors of a symmetric matrix as columns, in no order."""
    n = len(a)
    a = (a + a.T) / 2
    floor = _EPS * np.linalg.norm(a) if floor is None else floor
    beside = np.linalg.norm(a - np.diag(np.diag(a)))
    if n == 1 or beside <= floor * 0.1:
        return np.eye(n)
    if n == 2:
        turn = np.arctan2(2 * a[0, 1], a[0, 0] - a[1, 1]) / 2
        return np.array([[np.cos(turn), -np.sin(turn)], [np.sin(turn), np.cos(turn)]])
    diagonal = np.diag(a)
    # eigenvalues lie on both sides of the mean of the diagonal unless all are equal
    mean, spread = float(np.mean(diagonal)), beside / n + float(np.std(diagonal))
    shifts = [float(np.median(diagonal)), mean, *(mean + spread * t for t in (0.037, -0.041, 0.11, -0.13, 0.31, -0.29, 0.7, -0.7))]
    for shift in shifts:
        parts = _split(a, shift)
        if parts is not None:
            return np.hstack([basis @ spectral(basis.T @ a @ basis, floor) for basis in parts])
    # no shift parts the eigenvalues within rounding: one multiple eigenvalue
    return np.eye(n)


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns; a vector's entry of
    largest size is positive."""
    v = spectral(covariance)
    v, _ = np.linalg.qr(v)
    values = np.einsum("ij,ij->j", v, covariance @ v)
    order = np.argsort(-values, kind="stable")
    v = v[:, order]
    return values[order], v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """What is fitted: rows, sums per dimension, falling eigenvalues, eigenvectors as columns,
    and the shares of the variance of the components kept."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def usable(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, x as a matrix of longs) of the vectors of each length that hold neither NULL nor
    entries that are not finite; NULL and empty vectors are in none."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    entries = column.values
    values = pc.fill_null(entries.cast(pa.float64()), np.nan).to_numpy()
    out = []
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        scaled = values[offsets[rows][:, None] + np.arange(d)] * SCALE
        with np.errstate(invalid="ignore"):
            good = (np.abs(scaled) < _LARGEST).all(axis=1)
        out.append((rows[good], np.floor(scaled[good]).astype(np.int64) + SHIFT))
    return [(rows, x) for rows, x in out if len(rows)]


def _of_length(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    return next(((rows, x) for rows, x in usable(column) if x.shape[1] == d), (np.zeros(0, np.int64), np.zeros((0, d), np.int64)))


def _summed(partial: DataFrame) -> dict[int, np.ndarray]:
    """Sums of arrays of numbers by the integer k; one row a k reaches the driver."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = values.values.to_numpy()
                total[k] = total[k] + row if k in total else row
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), batch.schema.field(1).type)], ["k", "v"])

    kind = partial.schema["v"].dataType.simpleString()
    added = partial.repartition("k").mapInArrow(add, f"k long, v {kind}")
    return {r.k: np.array(r.v) for r in added.collect()}


def _covariance(vectors: DataFrame, centre: np.ndarray, n: int, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance (divisor n) of x less the centre, projected if wanted; every vector is
    centred before it is multiplied."""

    def run(batches):
        total = None
        for batch in batches:
            c = _of_length(batch.column(0), len(centre))[1] - centre
            c = c if project is None else c @ project
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], ["k", "v"])

    rows = _summed(vectors.mapInArrow(run, "k long, v array<double>"))
    total = np.array([rows[k] for k in range(len(rows))])
    return (total + total.T) / 2 / n


def fit(vectors: DataFrame, keep: int = COMPONENTS) -> Whitening | None:
    """Fit on the only column, of arrays of numbers; None without a usable vector."""

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, x in usable(batch.column(0)):
                d = x.shape[1]
                totals[d] = np.append(x.sum(axis=0), len(rows)) + totals.get(d, 0)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.list_(pa.int64()))], ["k", "v"])

    # a row a length
    by_length = _summed(vectors.mapInArrow(add, "k long, v array<long>"))
    if not by_length:
        return None
    length = max(by_length, key=lambda d: (int(by_length[d][-1]), d))
    *sums, n = (int(s) for s in by_length[length])
    centre = np.array([s / n for s in sums])
    covariance = _covariance(vectors, centre, n)
    values, v = components(covariance)
    # directions without variance (beyond rounding) cannot be whitened
    kept = min(keep, int((values > max(values[0], 0) * len(values) * _EPS * 8).sum()))
    return Whitening(n, sums, values[:kept], v[:, :kept], values[:kept] / max(np.trace(covariance), _EPS))


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n * x - sum)^2 of each row, exact."""
    if max(n * int(np.abs(x).max(initial=0)), int(np.abs(sums).max())) < 2**62:
        exact = x * n - sums
    else:
        exact = x.astype(object) * n - sums.astype(object)
    if len(sums) * int(np.abs(exact).max(initial=0)) ** 2 >= 2**63:
        exact = exact.astype(object)
    return [d if d < 2**63 else None for d in (exact * exact).sum(axis=1).tolist()]


def whiten(docs: DataFrame, vector_col: str = "embedding", keep: int = COMPONENTS, columns: Sequence[str] | None = None) -> tuple[DataFrame, Whitening | None, float]:
    """The input's rows with a usable vector (or the given columns of them) as a struct `row`,
    beside deviation and whitened (an array, the largest component first); the fit, NULL
    without rows; and identity_error, the largest absolute entry of the covariance of all
    rows' whitened less the identity.

    A vector's entry c counts as x = floor(64 * c) + 1000000. Rows whose vector is NULL, empty,
    or holds NULL or non-finite entries (or such that a double does not hold 64 * c as an
    integer) are dropped; so are vectors of another length than most have (of equally
    frequent lengths the largest counts). deviation is the sum over dimensions of
    (n * x - sum)^2, exact, NULL where a long cannot hold it. Directions without variance are
    no components: equal vectors throughout, or a single one, have an empty whitened and
    identity_error 0. An empty table gives no rows. Repeated rows count as often as they
    stand. The fit runs when this is called.
    """
    configure_batches(docs)
    vectors = docs.select(F.col(f"`{vector_col}`"))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)])
    rows = docs.select(row.alias("row"), F.col(f"`{vector_col}`").alias("vector"))
    kinds = f"row {rows.schema['row'].dataType.simpleString()}, deviation long, whitened array<double>"
    model = fit(vectors, keep)
    if model is None:
        return rows.limit(0).select("row", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")), None, 0.0
    n, sums, centre, scaled = model.n, np.array(model.sums, np.int64), model.mean, model.scaled
    error, width = 0.0, scaled.shape[1]
    if width:
        error = float(np.abs(_covariance(vectors, centre, n, scaled) - np.eye(width)).max())

    def project(batches):
        for batch in batches:
            kept, x = _of_length(batch.column(1), len(centre))
            whitened = (x - centre) @ scaled
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, whitened.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), pa.array(_deviation(x, n, sums), pa.int64()), lists], ["row", "deviation", "whitened"])

    return rows.mapInArrow(project, kinds), model, error


def whitened_components(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: int = COMPONENTS) -> DataFrame:
    """A row per usable row and component: id, component (from 1), n, deviation, whitened,
    explained, identity_error; rows and cases as in `whiten`."""
    out, model, error = whiten(docs, vector_col, keep, [id_col])
    parts = out.select(F.col(f"row.`{id_col}`").alias("id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = [] if model is None else model.explained.tolist()
    share = F.element_at(F.array(*[F.lit(e) for e in explained]), F.col("at") + 1) if explained else F.lit(None).cast("double")
    return parts.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(0 if model is None else model.n).cast("long").alias("n"), "deviation",
        "whitened", share.alias("explained"), F.lit(error).alias("identity_error"),
    )
