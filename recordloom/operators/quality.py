"""Row rules: completeness, required columns, outcome classes, accounting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import text as tx


def name(column: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col(f"`{column}`")


def all_filled(columns: Sequence[str], null_words: tuple[str, ...] = ()) -> Column:
    return reduce(and_, [tx.is_filled(name(c), null_words) for c in columns])


def complete_rows(
    df: DataFrame, columns: Sequence[str], null_words: tuple[str, ...] = ()
) -> DataFrame:
    return df.filter(all_filled(columns, null_words))


def accounting(df: DataFrame, keep: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows in total, kept and dropped, in one pass."""
    kept = F.count_if(keep)
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        kept.alias("kept"),
        (F.count("*") - kept).alias("dropped"),
    )


def changed_rows(df: DataFrame, before: Column, after: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(~before.eqNullSafe(after)).alias("changed"),
    )


# --- columns ----------------------------------------------------------------


class MissingColumns(ValueError):
    pass


def ensure_columns(df: DataFrame, required: Sequence[str], on_missing: str = "empty") -> DataFrame:
    """Add missing columns as '' (`empty`) or refuse the input (`error`)."""
    missing = [c for c in required if c not in df.columns]
    if missing and on_missing == "error":
        raise MissingColumns(", ".join(missing))
    return df.select("*", *[F.lit("").alias(c) for c in missing])


def first_present(df: DataFrame, *names: str) -> Column:
    """The first of several spellings the input has; '' if it has none."""
    for candidate in names:
        if candidate in df.columns:
            return tx.or_empty(name(candidate))
    return F.lit("")


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[name(c) for c in df.columns if c not in names])


def insert_after(df: DataFrame, anchor: str, column: str, value: Column) -> DataFrame:
    if anchor not in df.columns:
        raise MissingColumns(anchor)
    out: list[Column] = []
    for c in df.columns:
        out.append(name(c))
        if c == anchor:
            out.append(value.alias(column))
    return df.select(*out)


# --- reasons ----------------------------------------------------------------


def key_reason(uri: Column) -> Column:
    """Why an item cannot be followed: `no uri`, `bad id`; NULL if it can."""
    return F.when(tx.or_empty(uri) == "", "no uri").when(
        tx.last_path_segment(uri).isNull(), "bad id"
    )


def url_reason(url: Column) -> Column:
    """Why an index entry cannot be followed: `invalid-url`, `bad-url`."""
    return F.when(tx.or_empty(url) == "", "invalid-url").when(
        tx.last_slash_part(url).isNull(), "bad-url"
    )


def _unusable(reason: Column | None) -> Column:
    return F.lit(None).cast("string") if reason is None else reason


def outcome_class(
    http_status: Column, exists: Column, reason: Column | None = None, error: Column | None = None
) -> Column:
    """`skipped` for an entry that cannot be followed (`reason`, see `url_reason`) or whose id is
    stored, `saved` on 200 or 201, else `failed`, as with an `error` raised by the request."""
    skipped = _unusable(reason).isNotNull() | F.coalesce(exists, F.lit(False))
    saved = http_status.isin(200, 201) & _unusable(error).isNull()
    return F.when(skipped, "skipped").when(saved, "saved").otherwise("failed")


def outcome_reason(
    http_status: Column, exists: Column, reason: Column | None = None, error: Column | None = None
) -> Column:
    """`invalid-url` or `bad-url` (as `reason` says), `exists`, `exception`, `status-<n>`; NULL if saved."""
    status = F.coalesce(http_status.cast("string"), F.lit("noresp"))
    return (
        F.when(_unusable(reason).isNotNull(), _unusable(reason))
        .when(F.coalesce(exists, F.lit(False)), "exists")
        .when(_unusable(error).isNotNull(), "exception")
        .when(~F.coalesce(http_status.isin(200, 201), F.lit(False)), F.concat(F.lit("status-"), status))
    )


def split_by(df: DataFrame, reason: Column, out: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and the dead letters with theirs."""
    marked = df.withColumn(out, reason)
    return marked.filter(F.col(out).isNull()).drop(out), marked.filter(F.col(out).isNotNull())
