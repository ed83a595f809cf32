"""Pipeline stages with extra columns named like their own, which are kept unchanged."""

from __future__ import annotations

import corpus_pipeline
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

NAMES = ["key", "kinds", "spans", "size", "order", "ids", "score", "predicted", "a.b", "bytes", "cid", "rep", "label", "toxic"]
NAMES += [f"__{n}" for n in ("key", "order", "times", "copy", "row", "cid", "none", "id", "text", "clean", "range")]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = [F.concat(F.lit(n + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(n) for n in NAMES]
    return docs.select("*", *extra)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage(spark, clashing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    plain = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got, bare = stage(spark, clashing, SF_DIR), stage(spark, plain, SF_DIR)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in bare.select("doc_id").collect())
    if name != "bpe":
        assert got.columns == clashing.columns
        for row in got.select("doc_id", *[f"`{n}`" for n in NAMES]).collect():
            assert all(row[n] == f"{n}:{row.doc_id}" for n in NAMES)
