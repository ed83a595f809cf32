"""Rows numbered by ranges of their keys, without a stored copy of the rows.

The limits of the ranges are taken once from a bounded, seeded sample and stand in the plan as
literals. The range of a row is therefore a function of its keys alone: it comes out the same
however often, and on whichever executor, the row is computed. A bad sample makes ranges of
unequal length, never a wrong number.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# About as many rows in one range, up to so many ranges, from so many sampled rows each.
RANGE_ROWS = 1 << 14
MOST_RANGES = 1 << 12
SAMPLED = 32
SEED = 42


def _key(keys: Sequence[str]) -> Column:
    """The keys as one value; null comes first, as in an ascending order."""
    return F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])


def range_limits(df: DataFrame, keys: Sequence[str], range_rows: int | None = None) -> list[str]:
    """Ascending limits between the ranges of `keys`, each as JSON."""
    rows = df.count()
    ranges = min(MOST_RANGES, -(-rows // (range_rows or RANGE_ROWS)))
    if ranges < 2:
        return []
    share = min(1.0, SAMPLED * ranges / rows)
    taken = df.select(_key(keys).alias("k")).sample(fraction=share, seed=SEED)
    found = [r.j for r in taken.orderBy("k").select(F.to_json("k").alias("j")).collect()]
    cuts = [found[i * len(found) // ranges] for i in range(1, ranges)] if found else []
    return list(dict.fromkeys(cuts))


def range_of(df: DataFrame, keys: Sequence[str], limits: list[str]) -> Column:
    """Number of limits at or below the keys, found by halving steps."""
    if not limits:
        return F.lit(0)
    key_type = df.select(_key(keys).alias("k")).schema["k"].dataType.simpleString()
    table = F.from_json(F.lit(json.dumps([json.loads(x) for x in limits])), f"array<{key_type}>")
    steps = [1 << b for b in range(len(limits).bit_length() - 1, -1, -1)]

    def descend(low: Column, step: Column) -> Column:
        reached = low + step
        # Beyond the table `get` is null, and so is the comparison.
        return F.when(F.get(table, reached - 1) <= _key(keys), reached).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), descend)


def numbered(
    df: DataFrame,
    order: Sequence[str],
    groups: Sequence[str] = (),
    out: str = "rn",
    total: str | None = None,
) -> DataFrame:
    """`out`: the row's number by `order` within `groups`, from 1; `total`: the group's rows.

    Each (group, range) is numbered in a task of its own and the lengths of the group's earlier
    ranges are added, so a group that holds a third of all rows spreads over many tasks. The
    lengths travel as one row per (group, range) in the same shuffle as the rows: no join, and
    nulls group like any other value. `order` should be unique within a group; equal rows
    are numbered in any order. The plan of `df` runs four times, the first three
    times for its keys alone; a costly input should be a stored table.
    """
    keys = [*groups, *order]
    named = [F.col(f"`{c}`") for c in df.columns]
    by = [F.col(f"`{g}`") for g in groups]
    ranged = df.select(*named, range_of(df, keys, range_limits(df, keys)).alias("__range"))
    lengths = ranged.groupBy(*by, "__range").agg(F.count("*").alias("__n"))
    one = Window.partitionBy(*by) if groups else Window.partitionBy(F.lit(0))
    earlier = one.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    heads = lengths.select(
        *by,
        "__range",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(one).alias("__total"),
    )
    both = ranged.withColumns({"__before": F.lit(None).cast("long"), "__total": F.lit(None).cast("long")})
    both = both.unionByName(heads, allowMissingColumns=True)
    head = F.col("__before").isNotNull()
    stretch = Window.partitionBy(*by, "__range").orderBy(head.desc(), *[F.col(f"`{c}`") for c in order])
    placed = both.select(
        *named,
        head.alias("__head"),
        (F.first("__before").over(stretch) + F.row_number().over(stretch) - 1).alias("__rn"),
        F.first("__total").over(stretch).alias("__total"),
    )
    extra = [F.col("__rn").cast("long").alias(out)]
    if total:
        extra.append(F.col("__total").alias(total))
    return placed.filter("NOT __head").select(*named, *extra)


def stretch_of(df: DataFrame, order: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows number `first` to `last` (from 1) by `order`, in that order.

    The lengths of the ranges, a bounded list, tell which ranges hold these numbers; no row of
    another range is shuffled or sorted.
    """
    named = [F.col(f"`{c}`") for c in df.columns]
    place = range_of(df, order, range_limits(df, order))
    ranged = df.select(*named, place.alias("__range"))
    before, low, high, skipped = 0, None, -1, 0
    for r in sorted(ranged.groupBy("__range").count().collect()):
        if before < last and before + r["count"] >= first:
            if low is None:
                low, skipped = r["__range"], before
            high = r["__range"]
        before += r["count"]
    if low is None:
        return df.limit(0)
    keys = [F.col(f"`{c}`") for c in order]
    met = ranged.filter(F.col("__range").between(low, high))
    rn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*keys)) + skipped
    return met.withColumn("__rn", rn).filter(F.col("__rn").between(first, last)).orderBy("__rn").select(*named)
