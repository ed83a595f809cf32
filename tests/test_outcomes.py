"""Pieces of a broken outcome cell, against a plain look-ahead split."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from recordloom.functions import outcomes as ox


def split_slowly(text: str) -> list[str]:
    parts = re.split(r',(?=(?:[^"]*"[^"]*")*[^"]*\Z)', text)
    return [p for p in parts if p]


def test_pieces_between_commas(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice('ab, "') for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", ox._between_commas(F.col("t")).alias("got")).collect():
        assert row.got == split_slowly(row.t), row.t


def test_long_cells_stay_linear(spark):
    cell = '{"additionalNote": [' + "a," * 200_000 + "b]"
    df = spark.createDataFrame([(cell,)], "cell string")
    begin = time.time()
    assert len(df.select(ox.notes_text(F.col("cell")).alias("n")).first().n) > 200_000
    assert time.time() - begin < 60
