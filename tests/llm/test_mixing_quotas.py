"""Quotas per shard against seats given one by one, and shards against the whole mix."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from recordloom.llm import mixing


def seats_one_by_one(due: dict, n: int) -> list:
    """Sources of the first n seats: always the highest quotient, ties to the smaller source."""
    got, order = collections.Counter(), []
    for _ in range(n):
        best = min(due, key=lambda s: (-due[s] / (2 * got[s] + 1), s is None, s or ""))
        got[best] += 1
        order.append(best)
    return order


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_those_of_seats_given_one_by_one(spark, seed):
    rng = random.Random(seed)
    due = {f"s{i}": rng.choice([0.3, 1.0, 7.5, 7.5, rng.uniform(0, 400)]) for i in range(12)} | {None: 3.2}
    rows = [("n" if s is None else f"v{s}", s, d) for s, d in due.items()]
    frame = spark.createDataFrame(rows, "key string, source string, due double")
    size = rng.choice([1, 7, 50])
    given = seats_one_by_one(due, round(sum(due.values())))
    expected = collections.Counter((i // size, s) for i, s in enumerate(given))
    got = mixing.shard_quotas(frame, size).collect()
    assert {(r.shard, r.source): r.blocks for r in got} == expected
    firsts = {(r.shard, r.source): r.first for r in got}
    assert all(first == sum(n for (h, t), n in expected.items() if t == s and h < shard)
               for (shard, s), first in firsts.items())


def test_no_quota_without_dues(spark):
    none = spark.createDataFrame([("va", "a", 0.0)], "key string, source string, due double")
    assert mixing.shard_quotas(none).collect() == []
    assert mixing.shard_quotas(none.limit(0)).collect() == []


def test_shards_hold_what_the_mix_takes(spark):
    # One source holds a third of all rows; source c is taken more than once.
    rows = [(i, " w" * (i % 90), "a" if i % 3 else ("b" if i % 2 else "c")) for i in range(500)]
    docs = spark.createDataFrame([*rows, (None, None, None)], "doc_id long, text string, source string")
    mixed = {r.doc_id: r for r in mixing.mix(docs, ["doc_id"]).collect()}
    shards = mixing.shard_words(docs, ["doc_id"], shard_blocks=100).collect()
    sums = collections.Counter()
    per_shard = collections.Counter()
    for r in shards:
        sums[r.doc_id] += r.words
        per_shard[r.shard] += r.words
    assert sums == {d: r.taken for d, r in mixed.items() if r.taken}
    assert len(per_shard) > 5
    assert all(abs(n - 1600) <= 3 * 16 for shard, n in per_shard.items() if shard < max(per_shard))


def test_seeded_order_of_many_blocks(spark):
    prime = 2_147_483_647
    sizes = [1, 2, 17, prime - 1, prime, prime + 1, 2 * prime, (1 << 42) - 1]
    cases = [(n, b % n, s % n) for n in sizes for b in (0, 1, n // 2, n - 1) for s in (0, 0xFFFFFFFF)]
    frame = spark.createDataFrame(cases, "n long, b long, s long")
    got = frame.select("*", mixing.seeded_rank(F.col("b"), F.col("n"), F.col("s")).alias("rank")).collect()
    for r in got:
        step = prime if r.n % prime else 2_147_483_629
        assert r["rank"] == (r.b * (step % r.n) + r.s) % r.n
    whole = spark.range(1000).select(mixing.seeded_rank(F.col("id"), F.lit(1000).cast("long"), F.lit(7).cast("long")))
    assert sorted(r[0] for r in whole.collect()) == list(range(1000))


def test_kept_columns_of_any_name(spark):
    names = ["doc_id", "text", "source", "key", "size", "order", "bucket", "begin", "target", "a.b"]
    docs = spark.createDataFrame([(1, "one two", "s", *"abcdefg")], names)
    (row,) = mixing.mix(docs, names).collect()
    assert tuple(row) == (1, "one two", "s", *"abcdefg", 2, 2, 2.0, 2)
    (row,) = mixing.shard_words(docs, names).collect()
    assert tuple(row) == (1, "one two", "s", *"abcdefg", 0, 2)
