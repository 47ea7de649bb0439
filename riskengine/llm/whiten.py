"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, and each distinct one is fitted once. The covariance matrix is never formed: what is
needed of it is its product with a thin block Q, which one pass over the centred fit list X gives as X'(XQ) / n, summed
by tasks and then by dimension. The driver holds a few vectors per component, nothing that grows with the rows.

An iteration multiplies the block by a Chebyshev polynomial of the matrix that is small on the unwanted part of the
spectrum and grows fast above it (a three-term recurrence, one pass per degree), orthonormalises it (QR) and solves the
small problem within it (Rayleigh-Ritz). Bounds of the unwanted part come from a short Lanczos run and from the block's
own lower values. Each block has some columns more than asked for, and a few fresh random ones per iteration, so a
direction that was missed would come in. It ends when two iterations in a row certify the components: residuals
``|Vu - eu|`` near rounding, and values that the fresh directions did not move.

Rules for odd input: rows are left out whose vector is null, empty, holds null, non-finite or too large entries for a
long, or has another length than most vectors have (of equally frequent lengths the shortest counts); repeated rows each
get their result; a null id passes through; directions without variance are no components; other columns are not read;
a table without usable vectors, or with equal ones alone, gives no rows. ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import written

#: How an entry becomes a whole number.
SCALE, OFFSET = 64, 1_000_000
DEGREE, LANCZOS_STEPS, FRESH = 10, 12, 3
#: Residuals, relative to the largest eigenvalue: what is asked for, and what will do once they no longer shrink.
TOLERANCE, ENOUGH = 2e-14, 1e-10
MOST_ITERATIONS = 100
#: The filter may raise the first component over the last one wanted by this much, so that rounding does not drown it.
MOST_RAISE = 1e6
_TOP = float(2**62)


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows, ``x`` the bytes of its 64-bit numbers, and the number of dimensions."""
    own = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
    fits = F.forall("c", lambda c: F.coalesce(F.abs(c * SCALE) < _TOP, F.lit(False)))
    own = own.filter(F.coalesce((F.size("c") > 0) & fits, F.lit(False)))
    lengths = own.groupBy(F.size("c").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    d = lengths.d if lengths else 0

    def run(batches):
        for batch in batches:
            x = np.floor(batch.column(1).flatten().to_numpy() * SCALE).astype(np.int64) + OFFSET
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(x.tobytes(), batch.num_rows, 8 * d)], names=["vec_id", "x"])

    return own.filter(F.size("c") == d).mapInArrow(run, "vec_id bigint, x binary"), d


def _binary(data: bytes, rows: int, width: int) -> pa.Array:
    ends = np.arange(rows + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _rows(column: pa.Array, d: int) -> np.ndarray:
    """The whole numbers of a batch, one vector per row."""
    if not len(column):
        return np.zeros((0, d), np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.int64, (ends[-1] - ends[0]) // 8, ends[0]).reshape(-1, d)


@dataclass
class Fit:
    """The distinct vectors, their number and sums; ``near`` and ``rest`` add up to the means."""

    rows: DataFrame
    d: int
    n: int
    sums: list[int]

    def __post_init__(self):
        self.near = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self):
        """What a task does to centre a batch. Whole numbers are subtracted first, so nothing is lost to their size."""
        d, near, rest = self.d, self.near, self.rest
        return lambda column: (_rows(column, d) - near).astype(np.float64) - rest

    def product(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The covariance matrix times ``q``, and its diagonal; one pass."""
        centred, d = self.centred(), self.d
        k = q.shape[1]

        def run(batches):
            total, squares = np.zeros((d, k)), np.zeros(d)
            for batch in batches:
                x = centred(batch.column(0))
                total += x.T @ (x @ q)
                squares += np.einsum("ij,ij->j", x, x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d), pa.int32()), *map(pa.array, total.T), pa.array(squares)], names=["i", *names]
            )

        names = [f"c{j}" for j in range(k + 1)]
        parts = self.rows.mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in names))
        found = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).orderBy("i").toArrow()
        out = np.column_stack([found.column(c).to_numpy() for c in names]) / self.n
        return out[:, :k], out[:, k]

    def spread(self, axes: np.ndarray) -> np.ndarray:
        """The covariance of the vectors projected on ``axes``, from the projections themselves; one pass."""
        centred, k = self.centred(), axes.shape[1]

        def run(batches):
            total = np.zeros((k, k))
            for batch in batches:
                w = centred(batch.column(0)) @ axes
                total += w.T @ w
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), *map(pa.array, total.T)], names=["i", *names])

        names = [f"c{j}" for j in range(k)]
        parts = self.rows.mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in names))
        found = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).orderBy("i").toArrow()
        return np.column_stack([found.column(c).to_numpy() for c in names]) / self.n


def fit_list(rows: DataFrame, d: int) -> Fit | None:
    """Each distinct vector once, with exact sums."""
    own = written(rows.select("x").distinct(), "fit-list")

    def run(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _rows(batch.column(0), d)
            n += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"]
        )

    sums = own.mapInArrow(run, "i int, n bigint, high bigint, low bigint").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")
    )
    found = sums.orderBy("i").collect()
    if not found or not found[0].n:
        return None
    return Fit(own, d, found[0].n, [(r.high << 32) + r.low for r in found])


def _lower_bound(fit: Fit, rng: np.random.Generator) -> float:
    """A value below the spectrum, as tight as a few Lanczos steps give it."""
    q = rng.standard_normal(fit.d)
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS_STEPS, fit.d)):
        w = fit.product(basis[-1][:, None])[0][:, 0]
        alphas.append(basis[-1] @ w)
        for _ in range(2):
            for b in basis:
                w = w - (b @ w) * b
        betas.append(np.linalg.norm(w))
        if betas[-1] <= 1e-12 * max(alphas):
            break
        basis.append(w / betas[-1])
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1) + np.diag(betas[: len(alphas) - 1], -1))
    return max(0.0, values[0] - abs(betas[-1] * vectors[-1, 0]))


def _filtered(fit: Fit, q: np.ndarray, product: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """The block times a Chebyshev polynomial that stays below one on [low, cut], scaled to one at ``top``.

    ``product`` is the matrix times the block, so the first degree costs no pass.
    """
    centre, half = (cut + low) / 2, (cut - low) / 2
    first = half / (top - centre)
    sigma, before, now = first, q, (product - centre * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        now, before = (fit.product(now)[0] - centre * now) * (2 * following / half) - sigma * following * before, now
        sigma = following
    return now


def components(fit: Fit, k: int = 16, degree: int = DEGREE, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues (fewer, if the rest have no variance), unit eigenvectors, and the trace."""
    rng = np.random.default_rng(seed)
    d = fit.d
    block = min(d, 2 * k + FRESH)
    low = _lower_bound(fit, rng) if block < d else 0.0
    basis, last, best, certified = rng.standard_normal((d, block)), None, np.inf, 0
    for _ in range(MOST_ITERATIONS):
        q = np.linalg.qr(basis)[0]
        product, diagonal = fit.product(q)
        values, inner = np.linalg.eigh((q.T @ product + product.T @ q) / 2)
        order = np.argsort(values)[::-1]
        values, q, product = values[order], q @ inner[:, order], product @ inner[:, order]
        if values[0] <= 0:
            return values[:0], q[:, :0], 0.0
        count = min(k, d)
        residual = np.linalg.norm(product[:, :count] - q[:, :count] * values[:count], axis=0).max() / values[0]
        moved = np.inf if last is None else np.abs(values[:count] - last[:count]).max() / values[0]
        good = residual <= TOLERANCE or (residual <= ENOUGH and residual > best / 2)
        certified = certified + 1 if good and (moved <= 1e-12 or not certified) else 0
        if block == d or certified >= 2:
            break
        best, last = min(best, residual), values
        # The least value of the block, fresh columns aside, parts what is wanted from what is not.
        cut = min(values[-1 - FRESH], values[count - 1] * (1 - 1e-9))
        if cut <= low:
            low = 0.0
        cut = max(cut, values[0] * 1e-12)
        # How far outside the unwanted part the first and the last wanted value lie, as growth per degree.
        growth = [np.arccosh(max(1.0, (2 * v - cut - low) / (cut - low))) for v in (values[0], values[count - 1])]
        allowed = int(np.log(MOST_RAISE) / max(growth[0] - growth[1], 1e-9))
        kept = _filtered(fit, q, product, low, cut, values[0], max(1, min(degree, allowed)))
        basis = np.column_stack([kept[:, : block - FRESH] / np.linalg.norm(kept[:, : block - FRESH], axis=0), rng.standard_normal((d, FRESH))])
    else:
        raise ArithmeticError(f"components are not certified: residual {residual:.1e}")
    held = values[:count] > values[0] * d * np.finfo(float).eps
    axes = q[:, :count][:, held]
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return values[:count][held], axes * signs, float(diagonal.sum())


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", k: int = 16) -> DataFrame:
    """Per usable row and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows, d = whole_vectors(vectors, id_column, column)
    nothing = vectors.sparkSession.createDataFrame([], schema)
    if not d:
        return nothing
    rows = written(rows, "whole-vectors")
    fit = fit_list(rows, d)
    values, axes, trace = components(fit, k)
    if not len(values):
        return nothing
    scaled = axes / np.sqrt(values)
    error = float(np.abs(fit.spread(scaled) - np.eye(len(values))).max())
    explained, n, count = values / trace, fit.n, len(values)
    centred, near, left = fit.centred(), fit.near, np.array([s % fit.n for s in fit.sums], np.int64)

    def deviations(column: pa.Array) -> pa.Array:
        """Sums of squares of n * x - S, as 64-bit numbers where they cannot exceed them, else one by one."""
        away = _rows(column, d) - near
        most = (float(np.abs(away).max()) + 1) * n
        if most * most * d < 2**62:
            return pa.array(((n * away - left) ** 2).sum(1))
        exact = (sum((n * a - b) ** 2 for a, b in zip(row, left.tolist())) for row in away.tolist())
        return pa.array([v if v < 2**63 else None for v in exact], pa.int64())

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            which = pa.array(np.repeat(np.arange(m), count))
            columns = [
                batch.column(0).take(which), pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()), pa.array(np.full(m * count, n)),
                deviations(batch.column(1)).take(which), pa.array((centred(batch.column(1)) @ scaled).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
