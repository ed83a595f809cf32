"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is placed on `CURVES` Hilbert curves: each curve looks at `DIMENSIONS`
directions of its own random rotation, cut in cells by the quantiles of a bounded sample
and shifted at random. A curve's keys are cut in cells of about equally many rows, by
quantiles over all rows. A query meets, on every curve, the cells within a window around
its own place; all found are scored on the original vectors and merged.

How wide the window is follows from the data: for `TRIALS` queries the true neighbours
are found by scoring all rows, and the window is the distance, in cells, that reaches
`REACH` of them on their best curve. Clustered data get narrow windows; on data without
any structure they grow, and so does the work.

For inner products of vectors of unequal length, a coordinate sqrt(max - |x|^2) is
appended to the indexed vectors and 0 to the queries, which makes the nearest in the
plane the largest in inner product. Equal vectors are one indexed row with their smallest
`2 * k` ids, so copies cost nothing and ties are exact. Groups are bounded: a group holds
`SUPER` cells of a curve, and salts split it beyond `GROUP_ROWS` rows or queries.

Defined results: vectors that are null, empty, zero, or hold null or non-finite parts
take no part, nor do rows without id, nor vectors whose length is not the commonest one.
Rows repeated with one id count as one (with different vectors: the best one counts). A
query with fewer candidates than k gets all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.hilbert import hilbert_keys
from recordloom.llm.ship import ship, stored

CURVES = 16
DIMENSIONS = 4
BITS = 8
SAMPLE = 4096
TRIALS = 64
REACH = 0.97
CELLS = 256
SUPER = 16
LEAST_WINDOW = 2048
GROUP_ROWS = 1 << 16


class Curves:
    """Rotations, sample quantiles and shifts of all curves."""

    def __init__(self, sample: np.ndarray, longest: float, seed: int = 11):
        random = np.random.default_rng(seed)
        self.longest = longest
        width = sample.shape[1] + 1
        axes, cuts = [], []
        extended = self.extended(sample)
        for _ in range(CURVES):
            rotation, _ = np.linalg.qr(random.normal(size=(width, width)))
            axes.append(rotation[:, :DIMENSIONS] if width >= DIMENSIONS else rotation)
            along = extended @ axes[-1]
            # The quantile grid of each direction, moved by a part of a cell.
            shift = random.random(along.shape[1])
            steps = (np.arange(1, 1 << BITS)[:, None] - shift) / (1 << BITS)
            cuts.append(
                np.stack([np.quantile(along[:, j], steps[:, j]) for j in range(along.shape[1])])
            )
        self.axes, self.cuts = axes, cuts

    def extended(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else self.longest - (x**2).sum(1)
        return np.concatenate([x, np.sqrt(np.maximum(rest, 0))[:, None]], axis=1)

    def keys(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """rows x curves."""
        extended = self.extended(x, query)
        out = np.empty((len(x), CURVES), np.int64)
        for c in range(CURVES):
            along = extended @ self.axes[c]
            cells = np.stack(
                [np.searchsorted(self.cuts[c][j], along[:, j]) for j in range(along.shape[1])], axis=1
            )
            out[:, c] = hilbert_keys(cells, BITS)
        return out


def _matrix(column) -> np.ndarray:
    """Vectors of an Arrow list column (all of one length) in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, low=None, high=None):
    """Per query the rows of its k largest inner products (ties to smaller ids), among
    the rows low..high of `x`; scores are summed alike for any position of a row."""
    for at in range(0, len(q), 256):
        part = q[at : at + 256]
        rough = part @ x.T
        for i, row in enumerate(rough):
            lo, hi = (0, len(x)) if low is None else (int(low[at + i]), int(high[at + i]))
            inside = row[lo:hi]
            if not len(inside):
                continue
            if len(inside) > k:
                limit = np.partition(inside, len(inside) - k)[len(inside) - k]
                close = np.flatnonzero(inside >= limit - 1e-9 * max(1.0, abs(limit))) + lo
            else:
                close = np.arange(lo, hi)
            exact = (x[close] * part[i]).sum(axis=1)
            order = np.lexsort((ids[close], -exact))[:k]
            yield at + i, close[order], exact[order]


def valid(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """Usable rows as `vec_id`, `x` (array<double>)."""
    rows = vectors.select(
        F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")
    ).filter(F.col("vec_id").isNotNull() & (F.size("x") > 0))
    finite = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    rows = rows.filter(finite & F.exists("x", lambda v: v != 0))
    common = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("x") == (common["n"] if common else 0))


def _window(curves, bounds, trial_x, true_rows: pd.DataFrame) -> int:
    """Cells to look at on either side so that `REACH` of the true neighbours are met."""
    if not len(true_rows):
        return 1
    near = np.stack(true_rows["x"].to_numpy()).astype(float)
    mine = _cells(curves.keys(trial_x, query=True), bounds)[true_rows["trial"].to_numpy()]
    away = np.abs(mine - _cells(curves.keys(near), bounds)).min(axis=1)
    return int(np.quantile(away, REACH, method="higher")) + 1


def _cells(keys: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(b, keys[:, c], "right") for c, b in enumerate(bounds)], axis=1)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k largest inner products found per query.

    Both tables have the columns `id_` and `vector`; a query's own id is no candidate.
    """
    spark = ship(vectors.sparkSession)
    rows = valid(vectors, id_, vector)
    # Equal vectors become one row; the limit per vector holds before the shuffle too.
    kept = 2 * k
    place = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    unique = stored(
        rows.distinct().withColumn("place", place).filter(F.col("place") <= kept)
        .groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("uid"), "ids", "x"),
        "vectors",
    )
    wanted = stored(
        valid(queries, id_, vector).select(F.col("vec_id").alias("query_id"), "x").distinct(), "queries"
    )
    squared = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    facts = unique.agg(F.count("*").alias("n"), F.max(squared).alias("longest")).first()
    n, n_queries = facts["n"], wanted.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not n_queries:
        return spark.createDataFrame([], schema)
    sample = unique.select("x").orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).toPandas()
    curves = Curves(np.stack(sample["x"].to_numpy()).astype(float), float(facts["longest"]))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = curves.keys(_matrix(batch["x"])) if batch.num_rows else np.zeros((0, CURVES), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, c]) for c in range(CURVES)], [f"k{c}" for c in range(CURVES)]
            )

    cells = CELLS * max(1, -(-n // 4_000_000))
    shares = [i / cells for i in range(1, cells)]
    names = [f"k{c}" for c in range(CURVES)]
    keys = unique.select("x").mapInArrow(keyed, ", ".join(f"{c} long" for c in names))
    found = keys.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in names]).first()
    bounds = [np.array(found[c], np.int64) for c in names]

    # True neighbours of a few queries, to learn how wide a window must be.
    trials = wanted.orderBy(F.xxhash64("query_id"), "query_id").limit(TRIALS).toPandas()
    trial_x = np.stack(trials["x"].to_numpy()).astype(float)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _matrix(batch["x"]), batch["uid"].to_numpy()
            for i, at, score in _best(trial_x, x, ids, k):
                taken = pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(at), pa.int32()), pa.array(score), batch["x"].take(pa.array(at))],
                    ["trial", "score", "x"],
                )
                yield taken

    top = F.row_number().over(Window.partitionBy("trial").orderBy(F.desc("score")))
    true_rows = (
        unique.select("uid", "x").mapInArrow(scored, "trial int, score double, x array<double>")
        .withColumn("place", top).filter(F.col("place") <= k).toPandas()
    )
    reach = max(_window(curves, bounds, trial_x, true_rows), -(-LEAST_WINDOW * cells // n))

    row_salts = max(1, -(-n * SUPER // (cells * GROUP_ROWS)))
    query_salts = max(1, -(-n_queries * min(cells, 2 * reach + SUPER) // (cells * GROUP_ROWS)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = _cells(curves.keys(_matrix(batch["x"])), bounds).astype(np.int32)
            for c in range(CURVES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), c, np.int32)), pa.array(at[:, c]), batch["uid"], batch["x"]],
                    ["curve", "cell", "uid", "x"],
                )

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = _cells(curves.keys(_matrix(batch["x"]), query=True), bounds)
            low, high = np.maximum(at - reach, 0), np.minimum(at + reach, cells - 1)
            for c in range(CURVES):
                first, last = low[:, c] // SUPER, high[:, c] // SUPER
                row = np.repeat(np.arange(len(at)), last - first + 1)
                step = np.arange(len(row)) - np.searchsorted(row, row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), c, np.int32)),
                        pa.array((first[row] + step).astype(np.int32)),
                        pa.array(low[row, c].astype(np.int32)),
                        pa.array(high[row, c].astype(np.int32)),
                        batch["query_id"].take(pa.array(row)),
                        batch["x"].take(pa.array(row)),
                    ],
                    ["curve", "super", "low", "high", "query_id", "x"],
                )

    def merged(left: pa.Table, right: pa.Table) -> pa.Table:
        none = {"query_id": pa.array([], pa.int64()), "uid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(none)
        left = left.sort_by("cell")
        cell, ids, x = left["cell"].to_numpy(), left["uid"].to_numpy(), _matrix(left["x"])
        asking, q = right["query_id"].to_numpy(), _matrix(right["x"])
        low = np.searchsorted(cell, right["low"].to_numpy(), "left")
        high = np.searchsorted(cell, right["high"].to_numpy(), "right")
        out = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
        for i, at, score in _best(q, x, ids, k + 1, low, high):
            for part, values in zip(out, (np.full(len(at), asking[i]), ids[at], score), strict=True):
                part.append(values)
        return pa.table(dict(zip(none, map(np.concatenate, out), strict=True)))

    data = (
        unique.select("uid", "x").mapInArrow(placed, "curve int, cell int, uid long, x array<double>")
        .withColumn("super", F.expr(f"cell div {SUPER}").cast("int"))
        .withColumn("rs", F.pmod(F.xxhash64("uid"), F.lit(row_salts)).cast("int"))
        .withColumn("qs", F.explode(F.sequence(F.lit(0), F.lit(query_salts - 1))))
    )
    ask = (
        wanted.mapInArrow(asked, "curve int, super int, low int, high int, query_id long, x array<double>")
        .withColumn("qs", F.pmod(F.xxhash64("query_id"), F.lit(query_salts)).cast("int"))
        .withColumn("rs", F.explode(F.sequence(F.lit(0), F.lit(row_salts - 1))))
    )
    group = ["curve", "super", "rs", "qs"]
    pairs = (
        data.groupBy(*group).cogroup(ask.groupBy(*group))
        .applyInArrow(merged, "query_id long, uid long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "uid")
    best = (
        pairs.groupBy("query_id", "uid").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    )
    named = best.join(unique.select("uid", "ids"), "uid").select(
        "query_id", "score", F.explode("ids").alias("vec_id")
    )
    single = named.filter(F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        single.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
