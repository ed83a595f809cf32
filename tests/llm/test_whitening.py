"""Whitening against a full eigendecomposition in numpy."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SF_DIR

from recordloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, whitened string, vector string"


def brute(rows, k=8):
    """Per usable row its id, deviation and whitened entries (up to sign); eigenvalue shares."""
    width = max((len(v) for _, v in rows if v), key=[len(v) for _, v in rows if v].count)
    used = [
        (i, v) for i, v in rows
        if v and len(v) == width and all(c is not None and np.isfinite(np.float32(c)) for c in v)
    ]
    x = np.floor(np.array([np.array(v, np.float32).astype(float) for _, v in used]) * 1024).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return [i for i, _ in used], deviation, y @ vectors / np.sqrt(values), values / np.trace(y.T @ y / n)


def check(got, rows, k=8, close=1e-7):
    ids, deviation, white, explained = brute(rows, k)
    k = white.shape[1]
    assert len(got) == len(ids) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, r.whitened)
        assert r.n == len(ids) and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    mine = np.array([[by[i, d][c + 1] for c in range(k)] for i, d in zip(ids, deviation, strict=True)])
    for c in range(k):
        sign = np.sign(mine[:, c] @ white[:, c])
        assert np.abs(mine[:, c] * sign - white[:, c]).max() < close, c


def frame(spark, rows, partitions=4):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(partitions)


def random_rows(n, width, seed, spread=1.0, fall=1.0):
    rng = np.random.default_rng(seed)
    scales = spread * fall ** np.arange(width)
    return [(i, [float(v) for v in row]) for i, row in enumerate(rng.normal(size=(n, width)) * scales)]


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    df = queries.QUERIES["op13_whitening"](spark, SF_DIR)
    assert dict(df.dtypes)["deviation"] == "bigint"
    check(df.collect(), rows)


def test_falling_spectrum_and_flat_spectrum(spark):
    for rows in (random_rows(400, 40, 1, fall=0.9), random_rows(900, 48, 2)):
        check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_fewer_dimensions_than_components(spark):
    rows = random_rows(60, 3, 4, fall=0.5)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    check(got, rows, 3)


def test_odd_vectors(spark):
    rows = random_rows(50, 6, 5, fall=0.7)
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [float("nan")] * 6),
           (104, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (105, [1.0] * 5), (None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1])]
    got = whitening.whiten(frame(spark, rows + odd)).collect()
    check([r for r in got], rows + odd, 6)
    assert not {100, 101, 102, 103, 104, 105} & {r.vec_id for r in got}


def test_large_entries_stay_exact(spark):
    rows = [(i, [v * 1e13 for v in row]) for i, row in random_rows(40, 3, 6)]
    got = whitening.whiten(frame(spark, rows), components=2).collect()
    _, deviation, _, _ = brute([(i, [float(np.float32(c)) for c in v]) for i, v in random_rows(40, 3, 6)], 2)
    x = [[int(np.floor(float(np.float32(c)) * 1024)) + 100000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = {i: sum((40 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got} == exact and len(deviation) == 40


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)]])
def test_nothing_to_scale(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_constant_dimensions_have_no_component(spark):
    rows = [(i, [v[0], 2.0, v[1], -1.0]) for i, v in random_rows(80, 2, 8, fall=0.5)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, rows, 2)


def test_certificate(spark):
    rows = random_rows(500, 60, 9)
    df = frame(spark, rows).selectExpr("cast(embedding as array<double>) vector")
    entries = whitening.Entries(60, 1024, 100000)
    cov = whitening.Covariance(df, entries, whitening._centre(df, entries))
    pairs = whitening.leading_pairs(cov, 60, 8)
    assert pairs.residuals.max() < 1e-11 and pairs.rounds > 1
    assert cov.passes < 150
