"""Operator 11: PCA whitening of embeddings by incremental eigendecomposition.

Entries become integers floor(256 c), and the fit list is each distinct integer vector once. A task keeps count,
exact sums and the spectrum of its centred scatter matrix. It takes vectors by blocks: a block of few vectors
gives one centred rank-one update a vector, a longer one is first reduced to the d rows of its triangular factor,
whose scatter is the block's; one further update accounts for the distance of the means. An update solves the
secular equation between its poles, after deflating entries that vanish and poles that coincide, and takes the
vectors from the Löwner formula, so they stay orthogonal. Spectra of tasks are merged the same way, at most
``FAN_IN`` to a task. A last pass over the fit list takes the Rayleigh quotient of the exactly centred
vectors in the merged basis and its eigenvectors (Rayleigh-Ritz), which ends at double precision.

Only spectra (d * d numbers) and sums go to the driver. Vectors that are null or hold null or non-finite entries
take no part. Where lengths differ, the length with most distinct vectors counts (of equals the larger) and
rows of another length, and empty vectors, have no result. Entries beyond 64 bits are clipped to them. A component whose eigenvalue is
zero to rounding has null in whitened, and no place in identity_error; with one distinct vector, explained and
identity_error are null. deviation is null where it exceeds 64 bits. Repeated rows and null ids give rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.common import materialize, parts

SCALE, KEPT, FAN_IN = 256, 4, 32
EPS = np.finfo(float).eps
_PART = "n long, sums string, values binary, vectors binary"


def block_rows(d: int) -> int:
    """Vectors taken at once, so that reducing them outweighs the updates of the spectrum."""
    return max(4096, 16 * d)


# ---- integer vectors ----
def integers(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """(rows that take part, their vectors as 64-bit integers)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float) if n else np.zeros(0)
    lens = np.array(column.value_lengths().fill_null(0), np.int64) if n else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(lens)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    whole = np.array(column.is_valid()) & (bad[begin[1:]] == bad[begin[:-1]]) & (lens > 0) if n else np.zeros(0, bool)
    scaled = np.floor(flat * SCALE, where=np.isfinite(flat), out=np.zeros(len(flat)))
    low, high = scaled <= -(2.0**63), scaled >= 2.0**63
    x = np.where(low | high, 0, scaled).astype(np.int64)
    x[low], x[high] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    rows = np.flatnonzero(whole)
    return rows, [x[begin[r] : begin[r + 1]] for r in rows]


def pack(x: np.ndarray) -> bytes:
    """The shortest of 2, 4 and 8 bytes an entry behind that width, so equal vectors give equal bytes."""
    low, high = int(x.min()), int(x.max())
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return bytes([kind().itemsize]) + x.astype(f"<i{kind().itemsize}").tobytes()
    return b"\x08" + x.astype("<i8").tobytes()


def unpack(column: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(column), d), np.int64)
    for i, raw in enumerate(column):
        b = raw.as_buffer()
        out[i] = np.frombuffer(b, f"<i{b[0] if isinstance(b[0], int) else b[0][0]}", d, 1)
    return out


# ---- spectra ----
def secular(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z^T, and their distances to the poles (row i: d - eigenvalue i).

    ``d`` ascends strictly, no entry of ``z`` is zero, ``rho`` is positive. Each root is sought from the pole next to it
    by a rational function with the poles on either side, kept within its bracket by bisection.
    """
    m, w = len(d), rho * z * z
    reach = np.append(d[1:], d[-1] + w.sum())
    gap = reach - d
    middle = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        right = np.nan_to_num(1 + (w / (d - middle[:, None])).sum(axis=1)) < 0
    right[-1] = False
    origin = np.arange(m) + right
    delta = d - d[origin][:, None]
    lo, hi = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    hi[-1] = gap[-1]
    mu = (lo + hi) / 2
    left = np.tril(np.ones((m, m), bool))
    at, last = np.arange(m), np.arange(m) == m - 1
    nxt = np.minimum(at + 1, m - 1)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(100):
            far = delta - mu[:, None]
            t = w / far
            s = t / far
            psi, phi = np.where(left, t, 0).sum(axis=1), np.where(left, 0, t).sum(axis=1)
            dpsi, dphi = np.where(left, s, 0).sum(axis=1), np.where(left, 0, s).sum(axis=1)
            f = 1 + psi + phi
            lo, hi = np.where(f < 0, mu, lo), np.where(f < 0, hi, mu)
            done = (np.abs(f) <= 4 * EPS * (1 + np.abs(psi) + np.abs(phi))) | (hi - lo <= EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if done.all():
                break
            a1, a2 = far[at, at], np.where(last, 0, far[at, nxt])
            c = f - a1 * dpsi - a2 * dphi
            b = (a1 + a2) * c + a1 * a1 * dpsi + a2 * a2 * dphi
            root = np.sqrt(np.abs(b * b - 4 * a1 * a2 * f * c))
            step = np.where(b <= 0, (b - root) / (2 * c), 2 * a1 * a2 * f / (b + root))
            step = np.where(last, a1 + a1 * a1 * dpsi / (1 + psi - a1 * dpsi), step)
            new = mu + step
            inside = np.isfinite(new) & (new > lo) & (new < hi)
            mu = np.where(done, mu, np.where(inside, new, (lo + hi) / 2))
    return d[origin] + mu, delta - mu[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (ascending) of vectors diag(values) vectors^T + v v^T."""
    z = vectors.T @ v
    rho = float(z @ z)
    if rho == 0 or not np.isfinite(rho):
        return values, vectors
    z = z / np.sqrt(rho)
    d, q = values.copy(), vectors.copy()
    tol = 8 * EPS * max(abs(float(d[0])), abs(float(d[-1])), rho)
    live: list[int] = []
    for j in np.flatnonzero(rho * np.abs(z) > tol).tolist():
        if live:
            i = live[-1]
            size = float(np.hypot(z[i], z[j]))
            c, s = float(z[j]) / size, float(z[i]) / size
            if abs((d[j] - d[i]) * c * s) <= tol:  # two poles are one: turn the pair so that one entry vanishes
                z[j], z[i] = size, 0.0
                q[:, i], q[:, j] = c * q[:, i] - s * q[:, j], s * q[:, i] + c * q[:, j]
                d[i], d[j] = d[i] * c * c + d[j] * s * s, d[i] * s * s + d[j] * c * c
                live.pop()
        live.append(j)
    if live:
        at = np.array(live)
        poles, zz = d[at], z[at]
        found, far = secular(poles, zz, rho)
        ratio = -far / np.where(np.eye(len(at), dtype=bool), 1.0, poles[:, None] - poles)
        zz = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=0))), zz)
        u = (zz / far).T
        u /= np.sqrt((u * u).sum(axis=0))
        d[at], q[:, at] = found, q[:, at] @ u
    by = np.argsort(d, kind="stable")
    return d[by], q[:, by]


class Spectrum:
    """Count, exact sums, and the spectrum of the centred scatter of the vectors seen."""

    def __init__(self, d: int) -> None:
        self.n, self.sums = 0, [0] * d
        self.values, self.vectors = np.zeros(d), np.eye(d)

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def _count(self, n: int, sums: list[int]) -> None:
        """Take over counts; the distance of the means is one update."""
        if self.n and n:
            apart = np.array([s / n for s in sums]) - self.mean()
            self.values, self.vectors = rank_one(self.values, self.vectors, apart * np.sqrt(self.n * n / (self.n + n)))
        self.n, self.sums = self.n + n, [a + b for a, b in zip(self.sums, sums, strict=True)]

    def add(self, x: np.ndarray) -> None:
        """A block of integer vectors."""
        sums = exact_sums(x)
        centred = x.astype(float) - np.array([s / len(x) for s in sums])
        for row in np.linalg.qr(centred, "r") if len(x) > x.shape[1] else centred:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self._count(len(x), sums)

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector * np.sqrt(value))
        self._count(other.n, other.sums)

    def row(self) -> pa.RecordBatch:
        cells = [[self.n], [",".join(map(str, self.sums))], [self.values.tobytes()], [self.vectors.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, [pa.int64(), pa.string(), pa.binary(), pa.binary()], strict=True)], ["n", "sums", "values", "vectors"])

    @staticmethod
    def of(n: int, sums: str, values: bytes, vectors: bytes) -> Spectrum:
        out = Spectrum(0)
        out.n, out.sums, out.values = n, [int(s) for s in sums.split(",")], np.frombuffer(values)
        out.vectors = np.frombuffer(vectors).reshape(len(out.values), -1)
        return out


def exact_sums(x: np.ndarray) -> list[int]:
    if len(x) * max(abs(int(x.min())), abs(int(x.max()))) < 2**63:
        return x.sum(axis=0).tolist()
    return [sum(c) for c in zip(*x.tolist(), strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    held, n = [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, block_rows(d)):
            held.append(unpack(batch.column(0).slice(a, block_rows(d)), d))
            n += len(held[-1])
            if n >= block_rows(d):
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def gathered(df: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str):
    """The one row that ``fold`` makes of all rows, at most about ``FAN_IN`` tasks' rows to a task; None of no rows."""
    width = parts(df.sparkSession)
    while width > 1:
        width = -(-width // FAN_IN)
        df = df.repartition(width).mapInArrow(fold, schema)
    return df.first()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = None
    for batch in batches:
        for row in batch.to_pylist():
            one = Spectrum.of(**row)
            if whole is None:
                whole = one
            else:
                whole.merge(one)
    if whole is not None:
        yield whole.row()


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for raw in batch.column(0):
            one = np.frombuffer(raw.as_buffer())
            total = one.copy() if total is None else total + one
    if total is not None:
        yield _one(total)


def _one(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], ["total"])


def summed(fit: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of a fit list of what ``of`` gives for a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(of(x) for x in _blocks(batches, d))
        if not isinstance(total, int):
            yield _one(np.asarray(total, float).ravel())

    return np.frombuffer(gathered(fit.mapInArrow(run, "total binary"), _add, "total binary")[0])


def fit_list(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(x) of each distinct integer vector of the length that counts, and that length; 0 where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = integers(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([len(v) for v in x], pa.int32()), pa.array([pack(v) for v in x], pa.binary())], ["d", "x"])

    packed = df.select(column).mapInArrow(run, "d int, x binary").distinct()
    stored = materialize(packed, "whitening-fit")
    d = stored.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return stored.where(F.col("d") == (d[0] if d else 0)).select("x"), d[0] if d else 0


def decompose(fit: DataFrame, d: int) -> tuple[Spectrum, np.ndarray, np.ndarray]:
    """Count and sums of a fit list, eigenvalues of its covariance (falling) and their vectors (columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(d)
        for x in _blocks(batches, d):
            own.add(x)
        if own.n:
            yield own.row()

    merged = Spectrum.of(**gathered(fit.mapInArrow(run, _PART), _merge, _PART).asDict())
    mean, basis = merged.mean(), merged.vectors

    def quotient(x: np.ndarray) -> np.ndarray:
        y = (x.astype(float) - mean) @ basis
        return y.T @ y

    ritz = summed(fit, d, quotient).reshape(d, d) / merged.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    vectors = (basis @ turn)[:, ::-1]
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    return merged, np.maximum(values[::-1], 0), vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exactly."""
    top = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if top * top * x.shape[1] < 2**63:
        return ((x * n - np.array(sums)) ** 2).sum(axis=1).tolist()
    exact = (sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [v if v < 2**63 else None for v in exact]


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def report(df: DataFrame, id_col: str = "vec_id", column: str = "embedding", kept: int = KEPT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and leading component."""
    kind = df.schema[column].dataType.elementType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        df = df.withColumn(column, F.col(column).cast("array<double>"))
    fit, d = fit_list(df, column)
    if not d:
        return df.sparkSession.createDataFrame([], _RESULT)
    merged, values, vectors = decompose(fit, d)
    n, sums, mean, k = merged.n, merged.sums, merged.mean(), min(kept, d)
    real = values[:k] > max(d, 8) * EPS * values[0] if values[0] > 0 else np.zeros(k, bool)
    turn = vectors[:, :k] / np.sqrt(np.where(real, values[:k], 1.0))
    trace = float(values.sum())
    explained = (values[:k] / trace).tolist() if trace > 0 else [None] * k
    error = None
    if real.any():

        def products(x: np.ndarray) -> np.ndarray:
            w = np.column_stack([(x.astype(float) - mean) @ turn[:, real], np.ones(len(x))])
            return w.T @ w

        m = int(real.sum())
        total = summed(fit, d, products).reshape(m + 1, m + 1) / n
        error = float(np.abs(total[:m, :m] - np.outer(total[m, :m], total[m, :m]) - np.eye(m)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors_ = integers(batch.column(1))
            own = [(r, v) for r, v in zip(rows.tolist(), vectors_, strict=True) if len(v) == d]
            if not own:
                continue
            x = np.stack([v for _, v in own])
            ids = batch.column(0).take(pa.array([r for r, _ in own], pa.int64()))
            apart, white = pa.array(deviations(x, n, sums), pa.int64()), (x.astype(float) - mean) @ turn
            for j in range(k):
                cells = [ids, pa.array([j + 1] * len(own), pa.int32()), pa.array([n] * len(own), pa.int64()), apart]
                cells.append(pa.array(white[:, j]) if real[j] else pa.nulls(len(own), pa.float64()))
                cells += [pa.array([explained[j]] * len(own), pa.float64()), pa.array([error] * len(own), pa.float64())]
                yield pa.RecordBatch.from_arrays(cells, [c.split()[0] for c in _RESULT.split(", ")])

    return df.select(F.col(id_col).cast("long").alias("vec_id"), column).mapInArrow(run, _RESULT)
