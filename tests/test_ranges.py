"""Numbering by key ranges against sorted lists, with small ranges and a hot group."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import ranges


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 50)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    groups = ["hot"] * 700 + [None] * 60 + [f"g{rng.randrange(30)}" for _ in range(900)] + ['q"\\é'] * 9
    ids = rng.sample(range(-5000, 5000), len(groups))
    return [(g, i, f"x{i}") for g, i in zip(groups, ids, strict=True)]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_numbers_and_totals(spark, small_ranges, rows):
    df = spark.createDataFrame(rows, "`g.g` string, id long, __range string").repartition(5)
    df = df.withColumnRenamed("__range", "payload")
    got = ranges.numbered(df, ["id"], ["g.g"], "rn", "n").collect()
    by = {}
    for g, i, _ in sorted(rows, key=lambda r: r[1]):
        by.setdefault(g, []).append(i)
    assert len(got) == len(rows)
    for r in got:
        assert by[r["g.g"]][r.rn - 1] == r.id and r.n == len(by[r["g.g"]]) and r.payload == f"x{r.id}"


def test_hot_group_spreads_and_nothing_is_written(spark, small_ranges, rows):
    df = spark.createDataFrame(rows, "g string, id long, payload string")
    limits = ranges.range_limits(df, ["g", "id"])
    placed = df.withColumn("r", ranges.range_of(df, ["g", "id"], limits))
    hot = [r["count"] for r in placed.filter("g = 'hot'").groupBy("r").count().collect()]
    assert len(hot) > 8 and max(hot) < 200
    again = df.repartition(7).withColumn("r", ranges.range_of(df, ["g", "id"], limits))
    assert placed.exceptAll(again).isEmpty()
    text = plan(ranges.numbered(df, ["id"], ["g"]))
    assert "parquet" not in text.lower() and "Join" not in text


def test_ranges_follow_the_order(spark, small_ranges, rows):
    df = spark.createDataFrame(rows, "g string, id long, payload string")
    placed = df.select("g", "id", ranges.range_of(df, ["g", "id"], ranges.range_limits(df, ["g", "id"])).alias("r"))
    got = [r.r for r in placed.orderBy("g", "id").collect()]
    assert got == sorted(got) and got[0] == 0


@pytest.mark.parametrize("first,last", [(1, 10), (455, 470), (990, 1100), (1001, 1010), (-4, 3)])
def test_stretch(spark, small_ranges, first, last):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"), F.lit("x").alias("p"))
    got = [r.id for r in ranges.stretch_of(df, ["id"], first, last).collect()]
    assert got == list(range(1000))[max(0, first - 1) : last]


def test_stretch_sorts_only_its_ranges(spark, small_ranges):
    df = ranges.stretch_of(spark.range(2000), ["id"], 501, 510)
    met = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in met.split("Window")[-1]


def test_empty_and_equal_rows(spark, small_ranges):
    assert ranges.numbered(spark.range(0), ["id"]).collect() == []
    assert ranges.stretch_of(spark.range(0), ["id"], 1, 5).collect() == []
    same = spark.range(300).select(F.lit(4).alias("k"), F.lit("a").alias("g"))
    assert sorted(r.rn for r in ranges.numbered(same, ["k"], ["g"]).collect()) == list(range(1, 301))
