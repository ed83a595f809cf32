"""Crawl ledger: request grid, first-seen rows, counters, running numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.constants import (
    COUNTRY_CODES,
    COUNTRY_URI,
    LEVEL_URI,
    LEVELS,
    MILESTONE_STEP,
    PAGE_SIZE,
    RECENT_LIMIT,
    REQUEST_LANGUAGE,
    REQUEST_VERSION,
    STALL_SECONDS,
)
from recordloom.functions import text as tx
from recordloom.operators import ranges

SPAN_SLOTS = 4096

# --- grid and requests ------------------------------------------------------


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in COUNTRY_CODES], "country string")


def wanted_countries(df: DataFrame, wanted: str | None, column: str = "country") -> DataFrame:
    """Restrict to a comma list (any case, blanks ignored); an empty list keeps all."""
    names = [w.strip().upper() for w in (wanted or "").split(",") if w.strip()]
    return df.filter(F.col(column).isin(names)) if names else df


def work_grid(countries_df: DataFrame) -> DataFrame:
    """Every country with every level: eight rows per country, without a join."""
    return countries_df.select("*", F.explode(F.array(*map(F.lit, LEVELS))).alias("level"))


def page_offsets(grid: DataFrame, last_offset: Column, size: int = PAGE_SIZE) -> DataFrame:
    """One row per result page: offsets 0, size, 2*size ... up to `last_offset`."""
    offsets = F.sequence(F.lit(0).cast("bigint"), last_offset.cast("bigint"), F.lit(size).cast("bigint"))
    return grid.select("*", F.explode(offsets).alias("from"))


def search_url(
    base_url: str, kind: str, country: Column, level: Column, offset: Column, size: int = PAGE_SIZE
) -> Column:
    """Request for one result page of a (country, level) cell."""
    head = f"{base_url}?keywords=&size={size}&from="
    middle = (
        f"&sortType=publication%20date&language={REQUEST_LANGUAGE}&type={kind}"
        f"&location={COUNTRY_URI}"
    )
    return F.concat(
        F.lit(head), offset.cast("string"), F.lit(middle), country,
        F.lit(f"&eqfLevel={LEVEL_URI}"), level.cast("string"),
        F.lit(f"&version={REQUEST_VERSION}"),
    )


def level_url(base_url: str, kind: str, level: Column, offset: Column, size: int) -> Column:
    """Request for one result page of a level, form-encoded."""
    return F.concat(
        F.lit(f"{base_url}?keywords=&size={size}&from="), offset.cast("string"),
        F.lit(f"&sortType=publication+date&language={REQUEST_LANGUAGE}&type={kind}&eqfLevel="),
        F.url_encode(F.concat(F.lit(LEVEL_URI), level.cast("string"))),
        F.lit(f"&version={REQUEST_VERSION}"),
    )


def detail_url(base_url: str, uri: Column) -> Column:
    """Request for the document of one uri, percent-encoded."""
    encoded = F.replace(F.url_encode(uri), F.lit("+"), F.lit("%20"))
    return F.concat(
        F.lit(f"{base_url}?uri="), encoded,
        F.lit(f"&language={REQUEST_LANGUAGE}&version={REQUEST_VERSION}"),
    )


# --- membership -------------------------------------------------------------


def skip_done(todo: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `todo` whose key is not stored yet.

    The stored keys are reduced to one row each before they move, so a key that
    was stored many times weighs no more than any other.
    """
    return todo.join(done.select(*on).distinct(), list(on), "left_anti")


def only_listed(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(allowed.select(*on).distinct(), list(on), "left_semi")


# --- first seen -------------------------------------------------------------


def first_seen(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    scope: Sequence[str] = (),
    keep_missing: bool = False,
) -> DataFrame:
    """First row of every (scope, key) by `order`; same columns as `df`.

    The winners are found among the keys and `order` alone, combined on the map side; whole rows
    only meet the winners, by key and `order`, so a key held by a third of all rows
    spreads and no row is sorted. `order` must be unique within a key. Rows without a
    key are kept one by one, or dropped.
    """
    missing = tx.or_empty(F.col(key).cast("string")) == ""
    if not keep_missing:
        df = df.filter(~missing)
    names = list(dict.fromkeys([*scope, key]))
    place = F.min(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])).alias("__o")
    winners = (
        df.filter(~missing)
        .groupBy(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(names)])
        .agg(place)
        .select("*", "__o.*")
        .drop("__o")
    )
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & df[c].eqNullSafe(F.col(f"__g{i}"))
    for i, c in enumerate(order):
        same = same & df[c].eqNullSafe(F.col(f"__o{i}"))
    # Each task holds the winners of its keys in a hash table: narrow rows.
    winners = winners.hint("shuffle_hash")
    if not keep_missing:
        return df.join(winners, same, "left_semi")
    won = winners.withColumn("__won", F.lit(True))
    return df.join(won, same, "left").filter(missing | F.col("__won")).select(*[df[c] for c in df.columns])


# --- counters ---------------------------------------------------------------


def cell_counters(
    pages: DataFrame, cell: Sequence[str] = ("country", "level"), size: int = PAGE_SIZE
) -> DataFrame:
    """Pages, items, next offset and last update per cell, from page rows
    with columns `from`, `n_new`, `ts`."""
    return pages.groupBy(*cell).agg(
        F.count("*").alias("total_pages"),
        F.sum("n_new").cast("bigint").alias("total_items"),
        (F.max("from") + size).cast("bigint").alias("next_from"),
        F.max("ts").alias("last_updated"),
    )


def crawl_counters(log: DataFrame, by: Sequence[str] = ("country",)) -> DataFrame:
    """Attempted, succeeded, failed, skipped and last line from an outcome log
    with columns `seq`, `status`, `reason`, `ts`."""
    failed = F.col("status") == "failed"
    saved = F.col("status") == "saved"
    unusable = F.coalesce(F.col("reason").isin("no uri", "bad id"), F.lit(False))
    return log.groupBy(*by).agg(
        F.count_if(saved | (failed & ~unusable)).alias("attempted"),
        F.count_if(saved).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.max("seq").alias("last_line"),
        F.max("ts").alias("last_updated"),
    )


def outcome_counts(log: DataFrame, by: Sequence[str] = ("level",)) -> DataFrame:
    return log.groupBy(*by).agg(
        F.count_if(F.col("status") == "saved").alias("saved"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def completed_cells(
    pages: DataFrame,
    cell: Sequence[str] = ("country", "level"),
    max_pages: int | None = None,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """A cell is complete after an empty page or its last page.

    With `max_pages`, a column `capped` tells which cells have reached so many pages
    without being complete; they stay open.

    Input: the facts per page (`from`, `readable`, `n_items`, `page_number`,
    `page_count`).
    """
    empty = F.col("readable") & (F.col("n_items") == 0)
    last = F.coalesce(F.col("page_number") >= F.col("page_count"), F.lit(False))
    cells = pages.groupBy(*cell).agg(
        F.count("*").alias("pages"),
        F.sum("n_items").cast("bigint").alias("items"),
        (F.max("from") + size).cast("bigint").alias("next_from"),
        F.bool_or(empty | last).alias("completed"),
    )
    if max_pages is None:
        return cells
    return cells.withColumn("capped", ~F.col("completed") & (F.col("pages") >= max_pages))


def crawl_summary(cells: DataFrame) -> DataFrame:
    return cells.agg(
        F.count_if("completed").alias("levels_completed"),
        F.count("*").alias("levels_total"),
        F.coalesce(F.sum("items"), F.lit(0)).cast("bigint").alias("items_total"),
    )


def resume_offsets(
    grid: DataFrame, stored: DataFrame, cell: Sequence[str], size: int = PAGE_SIZE
) -> DataFrame:
    """Offset to go on from: stored lines rounded down to whole pages, 0 if none."""
    lines = stored.groupBy(*cell).agg(F.count("*").alias("lines"))
    n = F.coalesce(F.col("lines"), F.lit(0))
    return grid.join(lines, list(cell), "left").select(
        *cell, n.cast("bigint").alias("lines"), (n - n % size).cast("bigint").alias("from")
    )


def country_totals(df: DataFrame, country: str = "country") -> DataFrame:
    """Records per country and the grand total (country NULL, grand_total 1)."""
    return df.rollup(country).agg(
        F.count("*").alias("records"), F.grouping(country).cast("int").alias("grand_total")
    )


def country_files(files: DataFrame) -> DataFrame:
    """Files of each country as one list, by level and then name.

    One file per (country, level), so a list has as many entries as there are levels.
    """
    distinct = files.select("country", "level", "file").distinct()
    listed = F.array_sort(F.collect_list(F.struct("level", "file")))
    return distinct.groupBy("country").agg(
        F.transform(listed, lambda x: x["file"]).alias("files")
    )


# --- numbering --------------------------------------------------------------


def running_number(
    df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), out: str = "rn"
) -> DataFrame:
    """`row_number` over (groups, order) that never puts a group into one task.

    See `ranges.numbered`; `order` must be unique within a group.
    """
    return ranges.numbered(df, order, groups, out)


def numbered_pages(
    df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), size: int = PAGE_SIZE
) -> DataFrame:
    """Page offset and position within the page for every row."""
    rn = F.col("__rn")
    return running_number(df, order, groups, "__rn").select(
        *df.columns,
        (F.floor((rn - 1) / size) * size).cast("bigint").alias("from"),
        ((rn - 1) % size).cast("bigint").alias("pos"),
    )


def page_of(df: DataFrame, order: Sequence[str], offset: int, size: int = PAGE_SIZE) -> DataFrame:
    """One result page, in order. Only the ranges that hold the page are sorted, since a
    sorted limit would bring all rows before it to the driver."""
    return ranges.stretch_of(df, order, offset + 1, offset + size)


def shard_rows(
    df: DataFrame, order: Sequence[str], rows_per_shard: int | None, out: str = "shard"
) -> DataFrame:
    """Shard number of every row: `rows_per_shard` rows each, in order."""
    if not rows_per_shard or rows_per_shard <= 0:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    shard = F.floor((F.col("__rn") - 1) / rows_per_shard).cast("bigint")
    return running_number(df, order, (), "__rn").select(*df.columns, shard.alias(out))


def milestones(
    log: DataFrame,
    order: Sequence[str] = ("seq",),
    by: Sequence[str] = ("country", "status"),
    step: int = MILESTONE_STEP,
) -> DataFrame:
    """Rows at which the running count of their group passes a multiple of `step`."""
    numbered = running_number(log, order, by, "n")
    return numbered.filter(F.col("n") % step == 0)


def recent_rows(
    log: DataFrame,
    order: Sequence[str] = ("seq",),
    by: Sequence[str] = ("country", "status"),
    limit: int = RECENT_LIMIT,
) -> DataFrame:
    """Last `limit` rows per group, with their age (1 = newest).

    Groups are first cut in slices, and only the last `limit` rows of a slice go on, so
    that no task orders a whole group however large it is.
    """
    newest = [F.col(c).desc() for c in order]

    def ranked(df: DataFrame, *parts: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy(*newest))
        return df.withColumn("age", rank.cast("bigint")).filter(F.col("age") <= limit)

    sliced = log.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(256)))
    return ranked(ranked(sliced, *by, "__slice").drop("__slice", "age"), *by)


def stall_gaps(
    log: DataFrame, ts_micros: Column, by: Sequence[str] = (), seconds: int = STALL_SECONDS
) -> DataFrame:
    """Stretches of more than `seconds` without a row.

    Time is cut into slots as long as the limit. Two neighbours further apart
    than that cannot share a slot, so first and last row of each slot decide.
    A window runs over each span of `SPAN_SLOTS` slots; from one span to the next, only
    its first and last slot are compared, so no task orders all slots of a group.
    """
    width = seconds * 1_000_000
    slots = (
        log.withColumn("__t", ts_micros)
        .groupBy(*by, F.floor(F.col("__t") / width).alias("__slot"))
        .agg(F.min("__t").alias("__first"), F.max("__t").alias("__last"))
        .withColumn("__span", F.floor(F.col("__slot") / SPAN_SLOTS))
    )
    inside = Window.partitionBy(*by, "__span").orderBy("__slot")
    near = slots.select(
        "*", F.lag("__last").over(inside).alias("__before"), F.lead("__slot").over(inside).alias("__next")
    )
    edge = F.col("__before").isNull() | F.col("__next").isNull()
    kept = near.filter(edge | (F.col("__first") - F.col("__before") > width))
    # Edges of all spans of a group meet, the other rows stay with their span.
    across = Window.partitionBy(*by, F.when(~edge, F.col("__span"))).orderBy("__slot")
    before = F.coalesce("__before", F.lag("__last").over(across))
    return (
        kept.select(*by, before.alias("idle_from"), F.col("__first").alias("idle_to"))
        .withColumn("idle_micros", F.col("idle_to") - F.col("idle_from"))
        .filter(F.col("idle_micros") > width)
    )


# --- union ------------------------------------------------------------------


def positional_union(first: DataFrame, second: DataFrame, source: str | None = None) -> DataFrame:
    """Rows of both, columns matched by position under the names of the first."""
    if len(first.columns) != len(second.columns):
        raise ValueError(f"{len(first.columns)} columns against {len(second.columns)}")
    second = second.toDF(*first.columns)
    if source:
        first = first.withColumn(source, F.lit(1))
        second = second.withColumn(source, F.lit(2))
    return first.union(second)
