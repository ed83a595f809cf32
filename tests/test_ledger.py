"""Ledger operators against brute force, with a third of all rows in one group."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recordloom.operators import ledger, quality


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(1)
    groups = ["hot"] * 1000 + [f"g{rng.randint(0, 40)}" for _ in range(2000)]
    rng.shuffle(groups)
    rows = [(i * 3, g, rng.choice(["saved", "failed"])) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "seq bigint, country string, status string").repartition(6)
    return df, rows


def test_running_number(log):
    df, rows = log
    got = {(r.seq): r.rn for r in ledger.running_number(df, ["seq"], ["country"]).collect()}
    seen, expected = Counter(), {}
    for seq, g, _ in rows:
        seen[g] += 1
        expected[seq] = seen[g]
    assert got == expected


def test_running_number_spreads_the_hot_group(spark, log):
    df, _ = log
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = (
        df.repartitionByRange("country", "seq")
        .filter("country = 'hot'")
        .select(F.spark_partition_id().alias("p"))
        .distinct()
        .count()
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_milestones(log):
    df, rows = log
    got = {(r.country, r.status, r.seq, r.n) for r in ledger.milestones(df).collect()}
    seen, expected = Counter(), set()
    for seq, g, s in rows:
        seen[g, s] += 1
        if seen[g, s] % 100 == 0:
            expected.add((g, s, seq, seen[g, s]))
    assert got == expected and expected


@pytest.mark.parametrize("limit", [5, 1200])
def test_recent_rows(log, limit):
    df, rows = log
    got = {(r.country, r.seq) for r in ledger.recent_rows(df, by=["country"], limit=limit).collect()}
    by_group = defaultdict(list)
    for seq, g, _ in rows:
        by_group[g].append(seq)
    assert got == {(g, s) for g, seqs in by_group.items() for s in seqs[-limit:]}


def test_recent_rows_limit_before_the_shuffle(log):
    plan = ledger.recent_rows(log[0])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]


def test_shards_are_exact(spark):
    for n, size, sizes in [(25, 10, [10, 10, 5]), (20, 10, [10, 10]), (7, 0, [7]), (7, None, [7])]:
        df = ledger.shard_rows(spark.range(n).repartition(3), ["id"], size)
        assert [r["count"] for r in df.groupBy("shard").count().orderBy("shard").collect()] == sizes


def test_first_seen_null_policies(spark):
    ids = ["a", "a", None, None, "b", "", ""]
    rows = [(i // 3, i % 3, x) for i, x in enumerate(ids)]
    items = spark.createDataFrame(rows, "`from` int, pos int, id string").repartition(4)
    order = ["from", "pos"]
    kept = ledger.first_seen(items, "id", order, keep_missing=True).orderBy(*order).collect()
    assert [r.id for r in kept] == ["a", None, None, "b", "", ""]
    dropped = ledger.first_seen(items, "id", order).orderBy(*order).collect()
    assert [r.id for r in dropped] == ["a", "b"]


def test_first_seen_moves_no_payload_in_its_aggregate(log):
    df = log[0].withColumn("payload", F.repeat(F.lit("x"), 50))
    for missing in (False, True):
        found = ledger.first_seen(df, "country", ["seq"], ["status"], keep_missing=missing)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # A hash join sorts no rows, and the aggregates hold keys and places only.
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        aggregates = [line for line in plan.splitlines() if "Aggregate(" in line]
        assert "partial_min" in plan and all("payload" not in line for line in aggregates)


def test_first_seen_with_a_hot_key(log):
    df, rows = log
    got = {(r.country, r.status, r.seq) for r in ledger.first_seen(df, "country", ["seq"], ["status"]).collect()}
    expected = {}
    for seq, g, s in rows:
        expected.setdefault((g, s), seq)
    assert got == {(g, s, seq) for (g, s), seq in expected.items()}


def test_stall_gaps(spark):
    rng = random.Random(5)
    times = sorted(rng.sample(range(200_000), 400))
    rows = [(rng.choice(["hot", "hot", "x", "y"]), t * 1_000_000) for t in times]
    df = spark.createDataFrame(rows, "country string, t bigint")
    got = {(r.country, r.idle_from, r.idle_to) for r in ledger.stall_gaps(df, F.col("t"), ["country"]).collect()}
    last, expected = {}, set()
    for g, t in rows:
        if g in last and t - last[g] > 300_000_000:
            expected.add((g, last[g], t))
        last[g] = t
    assert got == expected and expected


def test_stall_gaps_across_spans(spark):
    rng = random.Random(6)
    times = sorted(rng.sample(range(100_000), 8_000)) + [400_000, 400_001, 900_000]
    df = spark.createDataFrame([(t * 1_000_000,) for t in times], "t bigint").repartition(5)
    gaps = ledger.stall_gaps(df, F.col("t"), seconds=7)
    got = {(r.idle_from // 1_000_000, r.idle_to // 1_000_000) for r in gaps.collect()}
    expected = {(a, b) for a, b in zip(times, times[1:], strict=False) if b - a > 7}
    assert got == expected and expected
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_resume_offsets(spark):
    grid = spark.createDataFrame([(c,) for c in "abcd"], "cell string")
    stored = spark.createDataFrame([(c,) for c, n in zip("bcd", [9, 10, 25], strict=True) for _ in range(n)], "cell string")
    got = {r.cell: r["from"] for r in ledger.resume_offsets(grid, stored, ["cell"]).collect()}
    assert got == {"a": 0, "b": 0, "c": 10, "d": 20}


def test_grid_and_filter(spark):
    grid = ledger.work_grid(ledger.countries(spark))
    assert grid.count() == 43 * 8
    assert ledger.wanted_countries(grid, " deu,,fra ").select("country").distinct().count() == 2
    assert ledger.wanted_countries(grid, " , ").count() == 43 * 8
    assert ledger.wanted_countries(grid, None).count() == 43 * 8


def test_completion(spark):
    rows = [("empty", True, 0, None, None), ("last", True, 5, 3, 3), ("open", True, 5, 1, 3),
            ("broken", False, 0, None, None), ("capped", True, 1, 1, 9), ("capped", True, 1, 2, 9)]
    schema = "cell string, readable boolean, n_items bigint, page_number bigint, page_count bigint"
    pages = spark.createDataFrame(rows, schema).withColumn("from", F.lit(0))
    got = {r.cell: (r.completed, r.capped) for r in ledger.completed_cells(pages, ["cell"], max_pages=2).collect()}
    no = (False, False)
    assert got == {"empty": (True, False), "last": (True, False), "open": no, "broken": no, "capped": (False, True)}
    assert "capped" not in ledger.completed_cells(pages, ["cell"]).columns


def test_positional_union_checks_width(spark):
    a, b = spark.range(1).selectExpr("id a", "id b"), spark.range(1)
    with pytest.raises(ValueError):
        ledger.positional_union(a, b)


def test_columns(spark):
    df = spark.createDataFrame([("x", "y")], "`a.b` string, c string")
    assert quality.ensure_columns(df, ["a.b", "d"]).columns == ["a.b", "c", "d"]
    with pytest.raises(quality.MissingColumns):
        quality.ensure_columns(df, ["d"], on_missing="error")
    with pytest.raises(quality.MissingColumns):
        quality.insert_after(df, "nope", "n", F.lit(1))
    assert quality.insert_after(df, "a.b", "n", F.lit(1)).columns == ["a.b", "n", "c"]
    assert quality.drop_columns(df, "a.b", "zz").columns == ["c"]
    assert df.select(quality.first_present(df, "zz", "a.b", "c").alias("v")).first().v == "x"
    assert df.select(quality.first_present(df, "zz").alias("v")).first().v == ""


def test_accounting_adds_up(log):
    df, rows = log
    r = quality.accounting(df, F.col("status") == "saved").first()
    assert r.total == len(rows) == r.kept + r.dropped
