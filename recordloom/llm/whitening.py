"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it: a block Q of a few
vectors is multiplied by it in passes over the table, each of which sums Y'(YQ) of the centred
rows Y in tasks and then over tasks. A round applies a Chebyshev polynomial of degree
`DEGREE`, by its three-term recurrence, one pass a step: it stays below 1 on the unwanted part
of the spectrum, from a lower bound up to the block's smallest Ritz value, and grows fast above it.
Then come QR and Rayleigh-Ritz. Rounds go on until the wanted pairs are certified: the
residuals |VQ - QE| are at rounding size. The lower bound comes from a short Lanczos run.

Entries are integers: floor(scale * c) + offset. Sums, and each row's deviation from the mean,
are exact integers; the centred entries (n * x - S) / n come from them by one division.

Defined results: vectors that are null, empty, or hold null or non-finite entries, and vectors
whose length is not the commonest one, are dropped. Rows without id, repeated rows and rows of
one id are rows like any other. Components whose eigenvalue is nothing but rounding
(constant dimensions, fewer rows than components) have no rows, as nothing can scale them to one; so an
empty table, or a single vector, gives none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.ship import ship

SCALE, OFFSET = 1024, 100_000
DEGREE = 8
# Vectors of the block beyond the wanted ones.
SPARE = 16
LANCZOS = 10
CERTIFIED, SETTLED = 1e-13, 1e-11
MOST_ROUNDS = 500
# Rows summed at a time, and the rows of partial sums that reach the driver.
BATCH = 8192
SUMS = 8
NOTHING = 1e-11


@dataclass(frozen=True)
class Entries:
    """How vectors become integers, and the length that counts."""

    width: int
    scale: int
    offset: int

    def of(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the usable rows, and their integers (rows x width; objects beyond a long)."""
        usable = pc.fill_null(pc.equal(pc.list_value_length(vectors), self.width), False)
        at = np.flatnonzero(usable.to_numpy(zero_copy_only=False))
        flat = vectors.take(pa.array(at)).flatten().cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False).reshape(len(at), self.width)
        # Null entries came as NaN.
        finite = np.isfinite(values).all(axis=1)
        at, values = at[finite], np.floor(values[finite] * self.scale)
        if values.size and np.abs(values).max() >= 2.0**52:
            whole = [[int(v) + self.offset for v in row] for row in values.tolist()]
            return at, np.array(whole, object).reshape(values.shape)
        return at, values.astype(np.int64) + self.offset


@dataclass(frozen=True)
class Centre:
    """Number of rows and the exact sum of each dimension."""

    n: int
    sums: list[int]

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers, as objects where a long would not hold their squares' sum."""
        sums = np.array(self.sums, object)
        most = max((abs(int(v)) for v in (x.min(), x.max())), default=0) * self.n if x.size else 0
        reach = most + max(map(abs, self.sums), default=0)
        if x.dtype != object and reach * reach * max(1, x.shape[1]) < 2**62:
            return x * self.n - sums.astype(np.int64)
        return x.astype(object) * self.n - sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n


Part = Callable[[np.ndarray], np.ndarray]


def _partial_sums(batches: Iterator[pa.RecordBatch], entries: Entries, part: Part, size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size)
    for batch in batches:
        _, x = entries.of(batch["vector"])
        for lo in range(0, len(x), BATCH):
            total = total + part(x[lo : lo + BATCH]).ravel()
    yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).tobytes()])], ["part"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for data in batch["part"].to_pylist():
            part = np.frombuffer(data, np.float64)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["part"])


def summed(rows: DataFrame, entries: Entries, part: Part, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of `part` over all rows: in tasks, then over tasks in `SUMS` tasks, then here."""
    size = int(np.prod(shape))
    parts = rows.mapInArrow(partial(_partial_sums, entries=entries, part=part, size=size), "part binary")
    few = parts.repartition(SUMS).mapInArrow(_summed, "part binary").collect()
    return np.sum([np.frombuffer(r.part, np.float64) for r in few], axis=0).reshape(shape)


def _centre(rows: DataFrame, entries: Entries) -> Centre:
    """Number of rows and exact sums, as decimals beyond a long."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * entries.width
        for batch in batches:
            _, x = entries.of(batch["vector"])
            n += len(x)
            # Entries lie below 2 ** 53, so 1,024 rows sum within a long.
            for lo in range(0, len(x), 1024):
                sums = [a + int(b) for a, b in zip(sums, x[lo : lo + 1024].sum(axis=0), strict=True)]
        dims = pa.array([-1, *range(len(sums))], pa.int32())
        yield pa.RecordBatch.from_arrays([dims, pa.array([str(v) for v in [n, *sums]])], ["dim", "total"])

    totals = rows.mapInArrow(counted, "dim int, total string").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    found = {r.dim: int(r.total) for r in totals.collect()}
    return Centre(found.get(-1, 0), [found.get(j, 0) for j in range(entries.width)])


class Covariance:
    """Products of the covariance (divisor n) with blocks of vectors, a pass over the rows each."""

    def __init__(self, rows: DataFrame, entries: Entries, centre: Centre):
        self.rows, self.entries, self.centre, self.passes = rows, entries, centre, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        centre = self.centre

        def part(x: np.ndarray) -> np.ndarray:
            y = centre.centred(x)
            return y.T @ (y @ q)

        self.passes += 1
        return summed(self.rows, self.entries, part, q.shape) / centre.n


def _lowest(cov: Covariance, width: int, random: np.random.Generator) -> float:
    """A lower bound of the spectrum: the smallest Ritz value of a Lanczos run less its residual."""
    basis, alphas, betas = [], [], []
    v = random.normal(size=width)
    v /= np.linalg.norm(v)
    for _ in range(min(LANCZOS, width)):
        basis.append(v)
        w = cov.times(v[:, None])[:, 0]
        alphas.append(float(w @ v))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(1.0, abs(alphas[0])):
            break
        v = w / betas[-1]
    ritz = np.linalg.eigvalsh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    return max(0.0, float(ritz[0]) - betas[-1])


@dataclass(frozen=True)
class Pairs:
    """Leading eigenpairs, falling, with their residuals relative to the first eigenvalue."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    rounds: int


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz in the span of the orthonormal q: values (falling), vectors, and V times these."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def leading_pairs(cov: Covariance, width: int, wanted: int, seed: int = 7) -> Pairs:
    """The `wanted` largest eigenvalues and their vectors, certified by their residuals."""
    random = np.random.default_rng(seed)
    block = min(width, wanted + SPARE)
    low = _lowest(cov, width, random) if block < width else 0.0
    q, _ = np.linalg.qr(random.normal(size=(width, block)))
    before = np.inf
    for rounds in range(MOST_ROUNDS):
        values, q, vq = _ritz(q, cov.times(q))
        scale = max(values[0], np.finfo(float).tiny)
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted] / scale
        worst = float(residuals.max())
        if worst <= CERTIFIED or block == width or (worst <= SETTLED and worst > before / 2):
            return Pairs(values[:wanted], q[:, :wanted], residuals, rounds)
        before = worst
        high = values[-1]
        low = min(low, 0.999 * high)
        middle, half = (high + low) / 2, (high - low) / 2
        if half <= 0:
            # The block's rest is null space already: nothing unwanted is left to damp.
            return Pairs(values[:wanted], q[:, :wanted], residuals, rounds)
        # T(0) = Q, T(1) = LQ, T(j+1) = 2 L T(j) - T(j-1) with L = (V - middle) / half; the first
        # product is the one at hand. All are divided by the growth at the largest value.
        ratio = half / max(values[0] - middle, half)
        sigma, last, now = ratio, q, (vq - middle * q) * (ratio / half)
        for _ in range(DEGREE - 1):
            following = 1 / (2 / ratio - sigma)
            step = 2 * following / half * (cov.times(now) - middle * now) - sigma * following * last
            last, now, sigma = now, step, following
        q, _ = np.linalg.qr(now)
    raise RuntimeError(f"no certified components after {MOST_ROUNDS} rounds; largest residual {before}")


def whiten(
    vectors: DataFrame, components: int = 8, id_: str = "vec_id", vector: str = "embedding",
    scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """`vec_id, component, n, deviation, whitened, explained, identity_error` per usable row and component.

    `deviation` is a decimal: exact at any number of rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(f"`{id_}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    lengths = rows.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("w")).count()
    common = lengths.orderBy(F.desc("count"), "w").first()
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    none = vectors.sparkSession.createDataFrame([], schema)
    if common is None:
        return none
    entries = Entries(common["w"], scale, offset)
    only = rows.select("vector")
    centre = _centre(only, entries)
    if not centre.n:
        return none
    cov = Covariance(only, entries, centre)
    pairs = leading_pairs(cov, entries.width, min(components, entries.width))

    def squares(x: np.ndarray) -> np.ndarray:
        return (centre.centred(x) ** 2).sum(keepdims=True)

    trace = float(summed(only, entries, squares, (1,))[0]) / centre.n
    kept = pairs.values > NOTHING * max(trace, np.finfo(float).tiny)
    if not kept.any():
        return none
    values = pairs.values[kept]
    turn = pairs.vectors[:, kept] / np.sqrt(values)
    k = len(values)

    def white(x: np.ndarray) -> np.ndarray:
        return centre.centred(x) @ turn

    mean = summed(only, entries, lambda x: white(x).sum(axis=0), (k,)) / centre.n

    def products(x: np.ndarray) -> np.ndarray:
        w = white(x) - mean
        return w.T @ w

    error = float(np.abs(summed(only, entries, products, (k, k)) / centre.n - np.eye(k)).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(1, len(kept) + 1, dtype=np.int32)[kept]
        for batch in batches:
            at, x = entries.of(batch["vector"])
            for lo in range(0, len(at), BATCH):
                part = x[lo : lo + BATCH]
                m = len(part)
                exact = (centre.exact(part) ** 2).sum(axis=1)
                deviation = pa.array([int(v) for v in exact], pa.decimal128(38, 0))
                copies = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].take(pa.array(at[lo : lo + BATCH])).take(copies),
                        pa.array(np.tile(numbers, m)),
                        pa.array(np.full(m * k, centre.n, np.int64)),
                        deviation.take(copies),
                        pa.array(white(part).ravel()),
                        pa.array(np.tile(values / trace, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(projected, schema)
