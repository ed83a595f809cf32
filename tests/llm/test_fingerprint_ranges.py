"""Fingerprints at other settings, with many rows without id, and of short texts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from recordloom.llm import fingerprint, queries

from .test_operators import likeness, shingles


@pytest.mark.parametrize("partitions", ["200", "2000"])
def test_any_number_of_shuffle_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = queries.QUERIES["op2_fingerprint"](spark, SF_DIR).select("doc_id", "fingerprint").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_every_row_meets_its_successor_across_ranges(spark, monkeypatch):
    """Ranges of a few rows; a third of all rows without id, another third with one id."""
    texts = [f"text number {i} of all of them" for i in range(90)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    both, window = fingerprint.with_next(docs, range_rows=6)
    found = both.withColumn("after", F.lead("text").over(window)).filter("NOT ghost").collect()
    after = {r.text: r.after for r in found}
    ids = {t: i for i, t in rows}
    # One round through all rows, ascending by id with null first.
    walk, text = [], "text number 0 of all of them"
    for _ in rows:
        walk.append(text)
        text = after[text]
    assert text == walk[0] and len(set(walk)) == len(rows) == len(found)
    numbers = [-1 if ids[t] is None else ids[t] for t in walk]
    turn = next(k for k in range(len(walk)) if numbers[k] < numbers[k - 1])
    assert numbers[turn:] + numbers[:turn] == sorted(numbers)
    assert len({r.bucket for r in found}) > 5


def test_many_rows_without_id(spark):
    docs = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"))
    got = fingerprint.edited_neighbours(docs)
    assert got.filter("doc_id IS NULL").count() == 10_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_likeness_of_short_texts(spark):
    """Few shingles leave most bins empty: what they borrow must not bend the estimate."""
    rng = random.Random(8)
    rows = []
    for k in range(600):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(7, 16))]
        other = list(words)
        for at in rng.sample(range(len(words)), rng.randint(0, 2)):
            other[at] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(words), " ".join(other)))
    bins = [fingerprint.bin_values(F.col(c)) for c in ("a", "b")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = {r.k: r.v for r in df.select("k", fingerprint.likeness(*bins).alias("v")).collect()}
    true = {k: likeness(shingles(a), shingles(b)) for k, a, b in rows}
    errors = np.array([got[k] - true[k] for k in true])
    assert abs(errors.mean()) < 0.02 and errors.std() < 0.17
    assert all(got[k] == 1.0 for k in true if true[k] == 1.0)
