"""Operator 12, embedding whitening: leading eigenvectors by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(64 c) + 1000000 and are written once in blocks.  The covariance V
is never formed: one distributed pass gives V Q = sum of xcᵀ (xc Q) / n for a thin block Q, with every xc
centred by the exact sums before it is multiplied.  A short Lanczos run brackets the low end of the
spectrum.  Each round applies a scaled Chebyshev polynomial of V, a three-term recurrence of passes, that
damps the eigenvalues below the block's least Ritz value; QR and Rayleigh-Ritz follow, until the residuals
certify every wanted component.

A pass leaves one d x p sum per task; the sums are added up in about the root of their number of tasks
before the driver adds the rest, so the driver gets few of them at any size.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped, and so are
vectors of another length than the commonest one (the longer of equally common ones).  Entries beyond the
range of a long saturate at 2^62.  Repeated rows and null ids count and are returned like others.
Components whose eigenvalue is numerically zero (1e-12 of the first) cannot be scaled and have no rows, so
an empty table, a single vector or equal vectors give none.  A deviation beyond the range of a long is
null.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.session import materialize

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
BLOCK_BYTES = 2 << 20
DEGREE = 10              # passes of one filter
LANCZOS = 12             # passes that bracket the spectrum
TOLERANCE = 1e-14        # residual norm in units of the largest eigenvalue
MOST_ROUNDS = 60
_TOP = 1 << 62


class Model(NamedTuple):
    n: int
    sums: list[int]               # exact, per dimension
    wide: bool                    # n * x does not fit 64 bits
    values: np.ndarray            # eigenvalues, falling
    vectors: np.ndarray           # d x k, columns
    explained: np.ndarray
    residual: float               # largest residual norm over the largest eigenvalue
    passes: int
    identity_error: float


def pack(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, int]:
    """Writes the usable vectors as blocks (ids, x as 64-bit integers); also their dimension."""
    v = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("c"))
    bad = F.exists("c", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(math.inf)))
    v = v.where(F.col("c").isNotNull() & ~bad)
    sizes = v.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dim = sizes[0].d if sizes else 0
    rows = max(1, BLOCK_BYTES // (8 * max(dim, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            x = np.clip(np.floor(flat * SCALE), -_TOP, _TOP).astype(np.int64) + SHIFT
            for lo in range(0, len(x), rows):
                ids = batch.column(0).slice(lo, rows)
                yield pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([x[lo:lo + rows].tobytes()], pa.binary())], ["ids", "x"])

    return materialize(v.where(F.size("c") == dim).where(F.lit(dim > 0)).mapInArrow(run, "ids array<long>, x binary"), "vectors"), dim


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for ids, x in zip(batch.column(0), batch.column(1), strict=True):
            yield ids.values, np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dim)


def _offsets(x: np.ndarray, n: int, sums: list[int], wide: bool) -> np.ndarray:
    """n x - S, exact."""
    if wide:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int], wide: bool) -> np.ndarray:
    return (_offsets(x, n, sums, wide) / n).astype(float)


def _totals(packed: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """n, the sums per dimension and the largest |x|, all exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, top = 0, [0] * dim, 0
        for _, x in _blocks(batches, dim):
            peak = max(int(x.max()), -int(x.min()))
            part = x.sum(0) if peak * len(x) < _TOP else x.astype(object).sum(0)
            n, top, sums = n + len(x), max(top, peak), [a + int(b) for a, b in zip(sums, part, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([top] * dim, pa.int64()),
                                          pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], ["dim", "n", "top", "s"])

    rows = packed.mapInArrow(run, "dim int, n long, top long, s decimal(38,0)").groupBy("dim").agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.sum("s").alias("s")).orderBy("dim").collect()
    return (rows[0].n, [int(r.s) for r in rows], rows[0].top) if rows else (0, [], 0)


def _added(packed: DataFrame, dim: int, size: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of ``part(x)``, ``size`` doubles: per task, then in few tasks, then here."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for _, x in _blocks(batches, dim):
            total += part(x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for t in batch.column(0):
                total += np.frombuffer(t.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    tasks = 2 * packed.sparkSession.sparkContext.defaultParallelism
    sums = packed.coalesce(tasks).mapInArrow(local, "total binary").repartition(math.isqrt(tasks)).mapInArrow(join, "total binary")
    return np.sum([np.frombuffer(r.total) for r in sums.collect()], axis=0)


def _low_end(product: Callable[[np.ndarray], np.ndarray], dim: int, rng: np.random.Generator) -> float:
    """A cautious lower end of the spectrum from a short Lanczos run with full reorthogonalisation."""
    basis = [rng.standard_normal(dim)]
    basis[0] /= np.linalg.norm(basis[0])
    alpha, beta = [], []
    for _ in range(min(LANCZOS, dim)):
        w = product(basis[-1][:, None])[:, 0]
        alpha.append(basis[-1] @ w)
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beta.append(np.linalg.norm(w))
        if beta[-1] <= 1e-12 * max(abs(a) for a in alpha):
            break
        basis.append(w / beta[-1])
    ritz, s = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return max(0.0, ritz[0] - beta[-1] * abs(s[-1, 0]))


def _filtered(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial that is small on [low, high], scaled to 1 at ``top``."""
    half, centre = max((high - low) / 2, 1e-6 * top), (high + low) / 2
    first = half / (top - centre) if top > centre else 1.0
    scale, before = first, q
    now = (product(q) - centre * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        now, before = (product(now) - centre * now) * (2 * following / half) - scale * following * before, now
        scale = following
    return now


def fit(packed: DataFrame, dim: int, components: int = COMPONENTS, seed: int = 12) -> Model:
    """Certified leading components of the covariance of all packed vectors."""
    n, sums, top = _totals(packed, dim) if dim else (0, [], 0)
    wide = 2 * n * top >= _TOP
    empty = Model(n, sums, wide, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0, 0, 0.0)
    if n < 2:
        return empty
    passes = 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums, wide)
            return c.T @ (c @ q)

        return _added(packed, dim, q.size, part).reshape(q.shape) / n

    trace = float(_added(packed, dim, 1, lambda x: np.array([np.square(_centred(x, n, sums, wide)).sum()]))[0]) / n
    if not trace > 0:
        return empty
    rng = np.random.default_rng(seed)
    k = min(components, dim)
    q = np.linalg.qr(rng.standard_normal((dim, min(dim, k + max(8, k // 2)))))[0]
    low, last = (_low_end(product, dim, rng) if q.shape[1] < dim else 0.0), math.inf
    for _ in range(MOST_ROUNDS):
        vq = product(q)                                          # Rayleigh-Ritz
        values, w = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, w = values[::-1], w[:, ::-1]
        q, vq = q @ w, vq @ w
        residual = float(np.linalg.norm(vq[:, :k] - q[:, :k] * values[:k], axis=0).max()) / values[0]
        if residual <= TOLERANCE or (residual <= 1e-11 and residual > last / 2):      # at the rounding floor
            break
        if residual > last / 2:
            low = 0.0                                            # the bracket was not safe
        last = residual
        q = np.linalg.qr(_filtered(product, q, min(low, values[-1]), max(values[-1], 0.0), values[0], DEGREE))[0]
    else:
        raise RuntimeError(f"no certified components after {MOST_ROUNDS} rounds, residual {residual}")
    keep = values[:k] > 1e-12 * values[0]
    u = q[:, :k][:, keep]
    u = u * np.sign(u[np.abs(u).argmax(0), np.arange(u.shape[1])])
    e = values[:k][keep]
    model = Model(n, sums, wide, e, u, e / trace, residual, passes, 0.0)
    return model._replace(identity_error=_identity_error(packed, dim, model))


def _identity_error(packed: DataFrame, dim: int, m: Model) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, from the rows themselves."""
    k, base = len(m.values), m.vectors / np.sqrt(m.values)

    def part(x: np.ndarray) -> np.ndarray:
        y = _centred(x, m.n, m.sums, m.wide) @ base
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    total = _added(packed, dim, k + k * k, part) / m.n
    return float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(packed: DataFrame, dim: int, m: Model) -> DataFrame:
    """One row per packed vector and component."""
    k, base = len(m.values), m.vectors / np.sqrt(m.values)
    rows = max(1, 65_536 // max(k, 1))

    def deviations(off: np.ndarray) -> pa.Array:
        if not m.wide and np.square(off.astype(float)).sum(1).max(initial=0) < _TOP:
            return pa.array(np.square(off).sum(1))
        exact = [sum(int(v) ** 2 for v in row) for row in off]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _blocks(batches, dim):
            for lo in range(0, len(block), rows):
                off = _offsets(block[lo:lo + rows], m.n, m.sums, m.wide)
                y = (off / m.n).astype(float) @ base
                each = pa.array(np.repeat(np.arange(len(y)), k))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, rows).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))), pa.array(np.full(y.size, m.n)),
                                                  deviations(off).take(each), pa.array(y.ravel()), pa.array(np.tile(m.explained, len(y))), pa.array(np.full(y.size, m.identity_error))],
                                                 [c.split()[0] for c in SCHEMA.split(", ")])

    return packed.where(F.lit(k > 0)).mapInArrow(run, SCHEMA)
