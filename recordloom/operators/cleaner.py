"""Boilerplate cleaning with audit, built in or by a user's own function."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import text as tx
from recordloom.functions.text import let

TEXT_COLUMNS = ("description", "learningOutcomes")
MISSING = "the cleaner left out a text column"
# Most that a hook gets at once: rows, and bytes of their texts unless one row has more.
HOOK_ROWS, HOOK_BYTES = 1000, 1 << 22


def clean_text(c: Column) -> Column:
    """struct(cleaned, removed): filler, then lone contacts, then bullets taken out."""

    def bullets(s: Column) -> Column:
        return F.struct(
            tx.strip_bullets(s["cleaned"]).alias("cleaned"),
            F.concat(s["removed"], tx.removed_bullets(s["cleaned"])).alias("removed"),
        )

    def contacts(s: Column) -> Column:
        return F.struct(
            tx.strip_contacts(s["cleaned"]).alias("cleaned"),
            F.concat(s["removed"], tx.removed_contacts(s["cleaned"])).alias("removed"),
        )

    text = tx.or_empty(c)
    filler = F.struct(
        tx.strip_filler(text).alias("cleaned"), tx.removed_filler(text).alias("removed")
    )
    return let(let(filler, contacts), bullets)


def audit_rows(df: DataFrame, key: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Key with original, cleaned and removed texts of every column."""
    cleaned = df.select(
        key,
        *[tx.or_empty(F.col(c)).alias(c) for c in columns],
        *[clean_text(F.col(c)).alias(f"__{c}") for c in columns],
    )
    return cleaned.select(
        key,
        F.struct(*columns).alias("original"),
        F.struct(*[F.col(f"__{c}.cleaned").alias(c) for c in columns]).alias("cleaned"),
        F.struct(*[F.col(f"__{c}.removed").alias(c) for c in columns]).alias("removed"),
    )


def clean_columns(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """The rows with their text columns cleaned."""
    return df.withColumns({c: clean_text(F.col(c))["cleaned"] for c in columns})


def rule_results(df: DataFrame, key: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """The fixed rules in the form of a hook's results: each text cleaned once, with what was removed."""
    cleaned = df.select(
        key,
        *[tx.or_empty(F.col(f"`{c}`")).alias(c) for c in columns],
        *[clean_text(F.col(f"`{c}`")).alias(f"__{c}") for c in columns],
    )
    both = [(f"__{c}", c) for c in columns]
    return cleaned.select(
        key,
        *[
            x
            for nested, c in both
            for x in (
                F.col(f"`{c}`"),
                F.col(f"`{nested}`")["cleaned"].alias(f"{c}_cleaned"),
                F.col(f"`{nested}`")["removed"].alias(f"{c}_removed"),
            )
        ],
        F.lit(None).cast("string").alias("error"),
    )


RowCleaner = Callable[[pd.DataFrame], pd.DataFrame]


def hook_schema(key: str, key_type: str, columns: Sequence[str]) -> str:
    fields = [f"`{key}` {key_type}"]
    for c in columns:
        fields += [f"`{c}` string", f"`{c}_cleaned` string", f"`{c}_removed` array<string>"]
    return ", ".join([*fields, "error string"])


def apply_hook(
    df: DataFrame, key: str, hook: RowCleaner, columns: Sequence[str] = TEXT_COLUMNS
) -> DataFrame:
    """Run a user's cleaner over parts of Arrow batches; one result row per input row.

    The hook gets a few rows with the text columns (`HOOK_ROWS`, `HOOK_BYTES`), so that only
    they are Python objects at a time, however many rows a batch has. It returns, in the same order,
    those columns cleaned plus `<column>_removed` lists, and if it likes an `error`
    column that names the rows it could not clean. A batch that raises is halved until
    the failing rows stand alone, and only those carry the `error`.
    """
    texts = list(columns)
    wanted = [*texts, *[f"{c}_removed" for c in texts], "error"]

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        result = hook(batch[texts].copy())
        if len(result) != len(batch):
            raise ValueError("row count changed")
        out = result.reindex(columns=wanted).reset_index(drop=True)
        return out.assign(error=[None if pd.isna(e) else str(e) for e in out["error"]])

    def by_halves(batch: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(batch)
        except Exception as e:  # a failing row becomes a dead letter
            if len(batch) < 2:
                return pd.DataFrame(None, batch.index, wanted, object).assign(error=str(e))
        middle = len(batch) // 2
        halves = [batch.iloc[:middle], batch.iloc[middle:]]
        return pd.concat([by_halves(h.reset_index(drop=True)) for h in halves], ignore_index=True)

    def removed_list(value: object) -> list[str]:
        is_list = not isinstance(value, str) and hasattr(value, "__iter__")
        return [str(v) for v in value] if is_list else []

    most_rows, most_bytes = HOOK_ROWS, HOOK_BYTES

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = sum(pc.binary_length(batch[c]).to_numpy().astype("int64") for c in texts).cumsum()
        lo = 0
        while lo < batch.num_rows:
            fit = ends.searchsorted((ends[lo - 1] if lo else 0) + most_bytes, "right")
            hi = min(max(lo + 1, int(fit)), lo + most_rows, batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in rows for p in parts(batch)):
            result = by_halves(part.select(texts).to_pandas())
            out = [part[key]]
            for c in texts:
                cleaned = [None if pd.isna(v) else str(v) for v in result[c]]
                removed = [removed_list(v) for v in result[f"{c}_removed"]]
                out += [part[c], pa.array(cleaned, part[c].type), pa.array(removed, pa.list_(part[c].type))]
            errors = [None if pd.isna(e) else e for e in result["error"]]
            yield pa.RecordBatch.from_arrays([*out, pa.array(errors, part[c].type)], names)

    names = [key, *[n for c in texts for n in (c, f"{c}_cleaned", f"{c}_removed")], "error"]
    key_type = df.schema[key].dataType.simpleString()
    source = df.select(key, *[tx.or_empty(F.col(c)).alias(c) for c in columns])
    return source.mapInArrow(batches, hook_schema(key, key_type, columns))


def checked(results: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Contract of a cleaner: every text column must come back."""
    missing = reduce(or_, [F.col(f"{c}_cleaned").isNull() for c in columns])
    return results.withColumn("error", F.coalesce("error", F.when(missing, MISSING)))


def hook_audit(results: DataFrame, key: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    good = checked(results, columns).filter(F.col("error").isNull())
    return good.select(
        key,
        F.struct(*columns).alias("original"),
        F.struct(*[F.col(f"{c}_cleaned").alias(c) for c in columns]).alias("cleaned"),
        F.struct(*[F.col(f"{c}_removed").alias(c) for c in columns]).alias("removed"),
    )


def hook_rows(results: DataFrame, key: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Cleaned rows; a failed row keeps its original texts and its error."""
    c = checked(results, columns)
    ok = F.col("error").isNull()
    return c.select(
        key,
        *[F.when(ok, F.col(f"{x}_cleaned")).otherwise(F.col(x)).alias(x) for x in columns],
        "error",
    )


def dead_rows(results: DataFrame, key: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Rows that could not be cleaned, with their error and their texts."""
    return checked(results, columns).filter(F.col("error").isNotNull()).select(key, "error", *columns)
