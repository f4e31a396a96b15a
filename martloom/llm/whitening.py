"""Whitening of embeddings by incremental eigendecomposition.

1. Vectors become whole numbers; each distinct one counts once (the fit list).
2. Every partition keeps the spectrum of its scatter, centred at its running mean. A further vector is a rank-one
   update: the new eigenvalues are the roots of the secular equation, found for all at once between the old
   ones; directions that the vector does not touch, and equal eigenvalues, are deflated first. The vectors
   follow from weights recomputed from the roots (Gu and Eisenstat), which keeps them orthogonal.
3. Two spectra combine by one rank-one update for each direction of the smaller one, and one for the distance of the
   means. Partitions are combined in a tree of groups of `FAN_IN`; a spectrum is as large as the square of a vector.
4. A last pass over the fit list is a Rayleigh-Ritz step: the covariance projected on the directions found, centred
   before multiplying, is summed over all partitions and diagonalised once more. So the components are
   right to double precision whatever the updates have lost.

Left out: rows whose vector is null, or has null or non-finite entries, or has another length than most of the
others (of two lengths as frequent, the larger counts). Entries beyond 2^46 in size count as 2^46. Components without
variance (below `LEAST_SHARE` of all of it) cannot be whitened and are left out, so equal vectors, a single one or an
empty table give no rows. Rows that repeat an id or have none are transformed like others. `deviation` is null where it does
not fit 64 bits. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.support import Workspace

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LEAST_SHARE = 1e-12
FAN_IN = 16
LARGEST = float(1 << 52)
EPS = float(np.finfo(float).eps)
STATE_ROW = "slot bigint, state binary"
WHITE_ROW = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


# ---- spectra -------------------------------------------------------------------------------------------------


def secular_roots(poles: np.ndarray, weights: np.ndarray, rho: float) -> np.ndarray:
    """Distances poles[j] - root[i] of the roots of 1 + rho * sum(weights / (poles - x)); poles ascending and distinct.

    Each root is sought from its nearer pole, so small distances keep their digits. Steps interpolate both
    neighbouring poles; one that leaves the bracket is replaced by its middle.
    """
    k = len(poles)
    every = np.arange(k)
    width = np.append(np.diff(poles), rho * weights.sum())
    middle = poles + width / 2
    right = (1 + rho * (weights[:, None] / (poles[:, None] - middle)).sum(0) < 0) & (every < k - 1)
    origin = poles[every + right]
    gaps = poles[:, None] - origin
    low = np.where(right, -width / 2, 0.0)
    high = np.where(right, 0.0, width / 2)
    high[-1] = width[-1]
    at = (low + high) / 2
    below = np.tri(k, dtype=bool).T  # pole j at or below root i
    done = np.zeros(k, bool)
    for _ in range(60):
        apart = gaps - at
        part = weights[:, None] / apart
        value = 1 + rho * part.sum(0)
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        slopes = rho * part / apart
        left, all_ = np.where(below, slopes, 0).sum(0), slopes.sum(0)
        one = apart[every, every]
        two = np.append(apart[every[:-1] + 1, every[:-1]], 1.0)
        a = (one + two) * value - one * two * all_
        b = one * two * value
        c = value - one * left - two * (all_ - left)
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # the last root has one pole beside it
            step[-1] = at[-1] * at[-1] * all_[-1] / (value[-1] + at[-1] * all_[-1]) - at[-1]
        to = at + step
        done |= (np.abs(step) <= 4 * EPS * np.abs(at)) | (np.abs(value) <= EPS * k * (1 + rho * np.abs(part).sum(0)))
        if done.all():
            break
        to = np.where((to > low) & (to < high), to, (low + high) / 2)
        at = np.where(done, at, to)
    return gaps - at


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and vectors of `vectors diag(values) vectors' + rho vector vector'`, rho not negative."""
    z = vector @ vectors
    size = rho * float(z @ z)
    if size <= 0:
        return values, vectors
    tiny = 8 * EPS * max(float(np.abs(values).max()), size)
    # equal eigenvalues: turn their directions so that only the last one is touched
    if (np.diff(values) <= tiny).any():
        values, vectors, z = _deflate_equal(values.copy(), vectors.copy(), z.copy(), tiny)
    live = np.flatnonzero(rho * np.abs(z) * np.sqrt(size / rho) > tiny)
    if not len(live):
        return values, vectors
    poles, weights = values[live], z[live] ** 2
    if len(live) == 1:
        new = poles + rho * weights
        turned = vectors[:, live]
    else:
        apart = secular_roots(poles, weights, rho)  # pole j - root i
        between = poles[:, None] - poles  # pole j - pole i
        np.fill_diagonal(between, 1.0)
        ratio = -apart
        ratio /= np.where(np.eye(len(live), dtype=bool), rho, -between)
        fitted = np.sqrt(np.abs(ratio.prod(1))) * np.sign(z[live])
        mix = fitted[:, None] / apart
        mix /= np.linalg.norm(mix, axis=0)
        new = poles - np.diagonal(apart)
        turned = vectors[:, live] @ mix
    values, vectors = values.copy(), vectors.copy()
    values[live], vectors[:, live] = new, turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _deflate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tiny: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = 0
    for i in range(1, len(values) + 1):
        if i < len(values) and values[i] - values[first] <= tiny:
            continue
        if i - first > 1:
            block = slice(first, i)
            mirror = z[block].copy()
            length = np.linalg.norm(mirror)
            if length > 0:
                target = -np.copysign(length, mirror[-1])
                mirror[-1] -= target
                mirror /= np.linalg.norm(mirror)
                vectors[:, block] -= 2 * np.outer(vectors[:, block] @ mirror, mirror)
                z[block] = 0
                z[i - 1] = target
            values[block] = values[first:i].mean()
        first = i
    return values, vectors, z


class Spectrum:
    """Number, exact sums, mean and eigendecomposition of the centred scatter of whole-number vectors."""

    def __init__(self, dims: int):
        self.n, self.sums, self.mean = 0, np.zeros(dims, np.int64), np.zeros(dims)
        self.values, self.vectors = np.zeros(dims), np.eye(dims)

    def add(self, x: np.ndarray) -> None:
        moved = x - SHIFT - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), moved)
        self.n += 1
        self.mean += moved / self.n
        self.sums += x

    def merge(self, other: Spectrum) -> None:
        if other.n > self.n:
            for name in ("n", "sums", "mean", "values", "vectors"):
                mine, theirs = getattr(self, name), getattr(other, name)
                setattr(self, name, theirs), setattr(other, name, mine)
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        moved, total = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / total, moved)
        self.mean += moved * (other.n / total)
        self.sums += other.sums
        self.n = total

    def dump(self) -> bytes:
        return b"".join(np.ascontiguousarray(a).tobytes() for a in (np.array([self.n]), self.sums, self.mean, self.values, self.vectors))

    @classmethod
    def load(cls, dims: int, state: bytes) -> Spectrum:
        self = cls(dims)
        whole, real = np.frombuffer(state, np.int64), np.frombuffer(state, np.float64)
        self.n, self.sums = int(whole[0]), whole[1 : 1 + dims].copy()
        self.mean, self.values = real[1 + dims : 1 + 2 * dims].copy(), real[1 + 2 * dims : 1 + 3 * dims].copy()
        self.vectors = real[1 + 3 * dims :].reshape(dims, dims).copy()
        return self


# ---- passes over the table -----------------------------------------------------------------------------------


def scaled(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows (vec_id, x) of usable vectors in whole numbers, and their length."""
    real = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = real.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    lengths = usable.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths["dims"] if lengths else 0
    whole = F.transform("v", lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(SHIFT).cast("bigint"))
    return usable.where(F.size("v") == dims).select("vec_id", whole.alias("x")), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


def _state(slot: int, state: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([state], pa.binary())], names=["slot", "state"])


def _gathered(rows: DataFrame, slots: int, fold: Callable[[Iterator[np.ndarray]], bytes], merge: Callable[[list[bytes]], bytes], dims: int) -> bytes | None:
    """`fold` every partition of `rows` (x) to a state, `merge` states in a tree; the last one comes to the driver."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _state(TaskContext.get().partitionId(), fold(_matrix(b.column(0), dims) for b in batches))

    def merged(group: pa.Table) -> pa.Table:
        states = [s for _, s in sorted(zip(group.column("slot").to_pylist(), group.column("state").to_pylist()))]
        return pa.Table.from_batches([_state(group.column("slot")[0].as_py() // FAN_IN, merge(states))])

    states = rows.mapInArrow(folded, STATE_ROW)
    while slots > 1:
        states = states.groupBy(F.floor(F.col("slot") / FAN_IN)).applyInArrow(merged, STATE_ROW)
        slots = -(-slots // FAN_IN)
    found = states.collect()
    return found[0]["state"] if found else None


class Whitener:
    """Components of a fit: `mean` as whole part and rest, `directions` as columns, falling `eigenvalues`."""

    def __init__(self, n: int, sums: np.ndarray, directions: np.ndarray, eigenvalues: np.ndarray, total: float):
        self.n, self.whole, self.rest = n, sums // n, sums % n
        self.directions, self.eigenvalues, self.total = directions, eigenvalues, total
        self.identity_error = float("nan")

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of n * x - sums, exact."""
        large = np.square(self.centred(x) * self.n).sum(1) >= float(1 << 62)
        safe = np.where(large[:, None], self.whole, x)
        found = np.square(self.n * (safe - self.whole) - self.rest).sum(1).tolist()
        for i in np.flatnonzero(large):
            exact = sum((self.n * (int(v) - int(w)) - int(r)) ** 2 for v, w, r in zip(x[i], self.whole, self.rest))
            found[i] = exact if exact < 1 << 63 else None
        return found


def _sums(states: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(s) for s in states], axis=0).tobytes()


def fit(spark: SparkSession, rows: DataFrame, dims: int, components: int = COMPONENTS, parts: int | None = None) -> Whitener | None:
    """Fit on each distinct `x` of `rows` once. `parts`: number of partitions, by default that of shuffles."""
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = Workspace(spark, "whitening")
    distinct = work.table(rows.select("x").distinct(), "fit")
    listed = distinct.repartition(parts, "x")

    def spectrum(blocks: Iterator[np.ndarray]) -> bytes:
        kept = Spectrum(dims)
        for block in blocks:
            for x in block:
                kept.add(x)
        return kept.dump()

    def combined(states: list[bytes]) -> bytes:
        kept = Spectrum.load(dims, states[0])
        for state in states[1:]:
            kept.merge(Spectrum.load(dims, state))
        return kept.dump()

    state = _gathered(listed, parts, spectrum, combined, dims)
    found = Spectrum.load(dims, state) if state else Spectrum(dims)
    if not found.n:
        return None
    basis, _ = np.linalg.qr(found.vectors)
    whitener = Whitener(found.n, found.sums, basis, np.ones(dims), 1.0)

    def projected(blocks: Iterator[np.ndarray]) -> bytes:
        total = np.zeros((dims, dims))
        for block in blocks:
            y = whitener.centred(block) @ whitener.directions
            total += y.T @ y
        return total.tobytes()

    ritz = np.frombuffer(_gathered(listed, parts, projected, _sums, dims)).reshape(dims, dims) / found.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    total = float(np.trace(ritz))
    kept = [int(i) for i in np.argsort(-values, kind="stable")[:components] if values[i] > LEAST_SHARE * total]
    if not kept:
        return None
    whitener = Whitener(found.n, found.sums, basis @ turn[:, kept], values[kept], total)

    def covariance(blocks: Iterator[np.ndarray]) -> bytes:
        total = np.zeros((len(kept), len(kept)))
        for block in blocks:
            y = whitener.apply(block)
            total += y.T @ y
        return total.tobytes()

    white = np.frombuffer(_gathered(listed, parts, covariance, _sums, dims)).reshape(len(kept), len(kept)) / found.n
    whitener.identity_error = float(np.abs(white - np.eye(len(kept))).max())
    return whitener


def whitened(vectors: DataFrame, components: int = COMPONENTS, parts: int | None = None) -> DataFrame:
    """One row for each usable vector and component; see the module for what is left out."""
    spark = vectors.sparkSession
    rows, dims = scaled(vectors)
    rows = Workspace(spark, "whitening").table(rows, "scaled")
    whitener = fit(spark, rows, dims, components, parts) if dims else None
    if whitener is None:
        return spark.createDataFrame([], WHITE_ROW)
    count = len(whitener.eigenvalues)
    explained = whitener.eigenvalues / whitener.total

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            n = len(x)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(n), count))),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), n)),
                pa.array(np.full(n * count, whitener.n)),
                pa.array(whitener.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), count))),
                pa.array(whitener.apply(x).reshape(-1)),
                pa.array(np.tile(explained, n)),
                pa.array(np.full(n * count, whitener.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in WHITE_ROW.split(", ")])

    return rows.mapInArrow(transform, WHITE_ROW)
