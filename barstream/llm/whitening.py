"""Whitening of embeddings by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.session import staged

SCALE, SHIFT = 64, 1_000_000
SEED = 13
#: Directions carried beside the wanted ones: the wider the gap behind them, the fewer passes.
GUARDS = 24
#: Largest residual of a certified component, as a share of the largest eigenvalue, and
#: the one accepted where rounding lets it fall no further.
TOLERANCE, FLOOR = 2e-14, 1e-12
#: Components below this share of the largest eigenvalue have no variance to divide by.
RANK = 1e-12
#: A filter raises the largest eigenvalue over the unwanted ones by this factor at most,
#: so that the orthogonal basis still holds the smallest wanted direction.
AMPLIFICATION, DEGREE = 1e10, 24
ROUNDS = 60
PROBES = 4
#: Cells of a block of result rows that a task writes, 16 a row.
CELLS = 1 << 20
#: Cells of a block of vectors as the passes read it.
PACKED = 1 << 18
#: Partial sums that the driver adds itself; more are added in lanes first.
LANES = 64

ROWS = "vec_id long, y array<long>"
PARTIAL = "task long, lane long, sums binary"
OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, cells: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors as matrices of at most ``cells`` cells."""
    step = max(1, cells // d)
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            flat = np.asarray(part.column("y").flatten(), np.int64)
            yield part.column("vec_id"), flat.reshape(part.num_rows, d)


def _packed(rows: DataFrame, d: int) -> DataFrame:
    """The vectors alone, many to a row, as the passes read them: bytes of 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _blocks(batches, d, PACKED):
            yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary())], ["block"])

    return staged(rows.mapInArrow(run, "block binary"), "vector-blocks")


def _summed(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: type, d: int) -> np.ndarray:
    """The sum over all blocks of ``of(block)``: one partial sum a task, then a tree.

    The driver gets at most ``LANES`` sums, or the square root of the number of tasks.
    Partial sums are added in the order of the tasks, so reruns agree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for block in batch.column("block"):
                total += of(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, d))
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int64()), pa.array([task // each], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            ["task", "lane", "sums"],
        )

    def added(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("task").to_numpy())
        total = np.zeros(shape, kind)
        for i in order:
            total += np.frombuffer(table.column("sums")[int(i)].as_buffer(), kind).reshape(shape)
        kept = table.slice(int(order[0]), 1)
        return kept.set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

    tasks = blocks.rdd.getNumPartitions()
    each = max(1, math.isqrt(tasks)) if tasks > LANES else 1
    partial = blocks.mapInArrow(run, PARTIAL)
    if each > 1:
        partial = partial.groupBy("lane").applyInArrow(added, PARTIAL)
    out = np.zeros(shape, kind)
    for row in sorted(partial.collect(), key=lambda r: r["task"]):
        out += np.frombuffer(row["sums"], kind).reshape(shape)
    return out


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n``, the exact sums of ``y = x - SHIFT``, components and eigenvalues."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residual: float


def vectors_of(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, y`` of the usable rows and their length (0: none), with entries ``floor(64 c)`` in place of ``c``.

    Dropped are null vectors, those with null or non-finite entries, and those of
    another length than most (on ties: than the longest of the most frequent).
    """
    entry = lambda c: c.cast("double")
    bad = lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == float("inf"))
    usable = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    usable = usable.where(F.col("v").isNotNull() & ~F.exists("v", bad) & (F.size("v") > 0))
    whole = usable.select("vec_id", F.transform("v", lambda c: F.floor(SCALE * entry(c)).cast("long")).alias("y"))
    rows = staged(whole, "vectors")
    lengths = rows.groupBy(F.size("y").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return (rows, 0) if most is None else (rows.where(F.size("y") == most["d"]), most["d"])


def fit_whitening(blocks: DataFrame, d: int, components: int = 32) -> Whitening | None:
    """The leading components of the covariance of ``d``-vectors (``_packed``); None without any.

    The covariance V is never formed: each pass multiplies the centred vectors with a
    narrow block Q, giving VQ as a sum over tasks.  Every round applies a Chebyshev
    polynomial by its three-term recurrence, one pass a degree, which keeps what lies
    in [0, b] small and raises what lies above; b is the smallest Ritz value of the
    block so far.  QR and Rayleigh-Ritz follow, until every wanted component has a
    residual of at most ``TOLERANCE`` of the largest eigenvalue.  Random vectors
    orthogonal to the result are then filtered alike: if one of them shows more
    variance than the last component it joins the block and the rounds go on.
    """
    counted = _summed(blocks, lambda y: np.append(y.sum(0), len(y)), (d + 1,), np.int64, d)
    n, sums = int(counted[-1]), counted[:-1]
    if not n:
        return None
    mean = sums / n
    passes = 0

    def applied(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def of(y: np.ndarray) -> np.ndarray:
            c = y - mean
            return c.T @ (c @ q)

        return _summed(blocks, of, q.shape, np.float64, d) / n

    def filtered(q: np.ndarray, vq: np.ndarray, b: float, top: float) -> np.ndarray:
        """The Chebyshev filter of [0, b] on ``q``, scaled to 1 at ``top``."""
        half = b / 2
        steep = math.acosh(max(1 + 1e-6, 2 * top / b - 1))
        degree = max(2, min(DEGREE, int(math.log(AMPLIFICATION) / steep)))
        rate = first_rate = half / (top - half)
        old, new = q, (vq - half * q) * (rate / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first_rate - rate)
            old, new = new, (applied(new) - half * new) * (2 * after / half) - old * (rate * after)
            rate = after
        return new

    def ritz(block: np.ndarray):
        q, _ = np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))
        vq = applied(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        return q @ turn[:, order], vq @ turn[:, order], values[order]

    random = np.random.default_rng(SEED)
    wanted, width = min(d, components), min(d, components + GUARDS)
    q, vq, values = ritz(random.standard_normal((d, width)))
    trace = float(_summed(blocks, lambda y: np.array([((y - mean) ** 2).sum()]), (1,), np.float64, d)[0]) / n
    best = math.inf
    stalled = 0
    for _ in range(ROUNDS):
        top = max(values[0], 1e-300)
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max()) / top
        stalled = stalled + 1 if residual > best / 2 else 0
        best = min(best, residual)
        certified = residual <= TOLERANCE or residual <= FLOOR and stalled >= 2
        if certified and (len(values) == d or values[-1] <= RANK * top):
            break
        b = max(values[-1], 1e-6 * top)
        if certified:
            floor = max(values[wanted - 1], 1e-6 * top)
            probe = random.standard_normal((d, min(PROBES, d - wanted)))
            probe -= q[:, :wanted] @ (q[:, :wanted].T @ probe)
            probe = filtered(probe, applied(probe), floor, 1.5 * max(top, floor))
            probe -= q[:, :wanted] @ (q[:, :wanted].T @ probe)
            probe, vp, found = ritz(probe)
            if found[0] <= floor * (1 + 1e-9):
                break
            q, vq, values = ritz(np.concatenate([q, probe], axis=1)[:, : max(d, width)])
            best = math.inf
            continue
        q, vq, values = ritz(filtered(q, vq, b, top))
    else:
        raise ArithmeticError(f"residual {residual:.1e} after {ROUNDS} rounds")
    real = values[:wanted] > RANK * max(values[0], 1e-300)
    return Whitening(n, sums, q[:, :wanted][:, real], values[:wanted][real], trace, passes, residual)


def _deviations(y: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The exact sums of squares of ``n*x - S``; more than 63 bits are an error."""
    largest = n * int(np.abs(y).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if largest * largest * y.shape[1] < 1 << 63:
        apart = n * y - sums
        return (apart * apart).sum(1)
    apart = n * y.astype(object) - sums.astype(object)
    return (apart * apart).sum(1)


def whiten(embeddings: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` by row and component.

    Rows whose vector is null, of another length than most, or holds null or
    non-finite entries are left out.  Components are numbered from 1 by falling
    variance; those without variance (equal vectors, fewer rows than components)
    have nothing to divide by and are left out.  Rows that repeat an id each get
    their own rows, null ids stay null, no usable row gives no row.  A deviation
    that exceeds 64 bits is an error.  Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows, d = vectors_of(embeddings, id_col, vector_col)
    blocks = _packed(rows, d) if d else None
    fit = fit_whitening(blocks, d, components) if d else None
    if fit is None or not len(fit.values):
        return spark.createDataFrame([], OUT)
    n, sums, trace, k = fit.n, fit.sums, fit.trace, len(fit.values)
    mean = sums / n
    scaled = fit.vectors / np.sqrt(fit.values)

    def spread(y: np.ndarray) -> np.ndarray:
        z = (y - mean) @ scaled
        return np.concatenate([z.T @ z, z.sum(0)[None]])

    moments = _summed(blocks, spread, (k + 1, k), np.float64, d) / n
    error = float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())
    explained = fit.values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _blocks(batches, d, CELLS * d // (16 * max(d, k))):
            m = len(y)
            at = pa.array(np.repeat(np.arange(m), k))
            deviation = pa.array(_deviations(y, n, sums), pa.int64())
            columns = [
                ids.take(at),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()),
                deviation.take(at),
                pa.array(((y - mean) @ scaled).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUT.split(", ")])

    return rows.mapInArrow(run, OUT)
