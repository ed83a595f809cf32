"""The composite jobs, each one lazy plan from records to a flat dataset.

Where a chain of file stages would hand outcome lists over as JSON text inside
CSV cells, these plans keep them as arrays; the text form appears at a sink only.
The `*_rows` functions take flat text rows, for data that is already in CSV.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordloom.constants import (
    LO_REQUIRED,
    NOTE_SEMICOLON,
    PAGE_SIZE,
    QUAL_REQUIRED,
)
from recordloom.functions import outcomes as ox
from recordloom.functions import text as tx
from recordloom.functions import variants as vx
from recordloom.operators import cleaner, extract, ledger, quality
from recordloom.operators.quality import name
from recordloom.sources import files, readers, writers

LO_TEXT = [c for c in LO_REQUIRED if c != "learningOutcome"]
QUAL_TEXT = [c for c in QUAL_REQUIRED if c != "learningOutcomes"]

# --- learning opportunities -------------------------------------------------


def _lo_columns(df: DataFrame, notes: Column) -> DataFrame:
    level = quality.first_present(df, "EQFLevel_prefLabel", "EQFLevel.prefLabel", "EQFLevel")
    return df.select(
        quality.first_present(df, "title").alias("title"),
        quality.first_present(df, "countryCode.prefLabel", "countryCode_prefLabel").alias(
            "countryCode.prefLabel"
        ),
        level.alias("EQFLevel_prefLabel"),
        tx.first_integer(level).alias("EQFLevel_numeric"),
        quality.first_present(
            df, "learningOutcomeSummary.noteLiteral", "learningOutcomeSummary_noteLiteral"
        ).alias("learningOutcomeSummary.noteLiteral"),
        notes.alias("learningOutcome_additionalNote"),
    )


def lo_dataset(
    docs: DataFrame, markers_per_note: bool = False, watch: Observation | None = None
) -> DataFrame:
    """Documents (`file, body`) to complete, clean learning-opportunity rows.

    `markers_per_note` removes list markers from every note instead of from the
    start of each line of the joined text.
    """
    flat = extract.lo_records(docs, outcomes_as_json=False, watch=watch)
    kept = vx.keep_rows(flat, quality.all_filled(LO_TEXT) & (F.size("learningOutcome") > 0))
    notes = F.transform(
        F.flatten(F.transform("learningOutcome", lambda x: x["additionalNote"])), tx.trim_ws
    )
    if markers_per_note:
        notes = F.transform(notes, tx.strip_enumeration)
    joined = F.array_join(F.filter(notes, lambda t: t != ""), NOTE_SEMICOLON)
    return _lo_columns(kept, joined if markers_per_note else tx.strip_enumeration(joined))


def lo_rows(flat: DataFrame) -> DataFrame:
    """Flat text rows (outcomes as JSON text) to the same result."""
    kept = quality.complete_rows(flat, LO_REQUIRED)
    return _lo_columns(kept, tx.strip_enumeration(ox.notes_text(F.col("learningOutcome"))))


# --- qualifications ---------------------------------------------------------


def _with_level_number(df: DataFrame) -> DataFrame:
    return quality.insert_after(
        df,
        "qualificationLevel",
        "qualificationLevelNum",
        tx.level_number(F.col("qualificationLevel")),
    )


def _replaced(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(
        *[columns[c].alias(c) if c in columns else name(c) for c in df.columns]
    )


def qual_dataset(docs: DataFrame, watch: Observation | None = None) -> DataFrame:
    """Documents (`file, body`) to complete, clean qualification rows."""
    flat = extract.qual_records(docs, outcomes_as_json=False, watch=watch)
    filled = quality.all_filled(QUAL_TEXT, ("null",)) & (F.size("learningOutcomes") > 0)
    kept = quality.drop_columns(vx.keep_rows(flat, filled), "sourceFile")
    items = F.transform(
        "learningOutcomes",
        lambda x: F.struct(x["title"].alias("title"), x["additionalNotes"].alias("notes")),
    )
    cleaned = _replaced(
        kept,
        description=tx.strip_html(F.col("description")),
        learningOutcomes=ox.compose_outcomes(items),
    )
    return _with_level_number(cleaned)


def qual_rows(flat: DataFrame) -> DataFrame:
    """Flat text rows (outcomes as JSON text) to the same result."""
    rows = quality.ensure_columns(flat, QUAL_REQUIRED)
    kept = quality.complete_rows(rows, QUAL_REQUIRED, ("null",))
    pruned = quality.drop_columns(kept, "sourceFile", "entryRequirement")
    return _with_level_number(clean_qual_rows(pruned))


def clean_qual_rows(rows: DataFrame) -> DataFrame:
    """Readable description and outcomes; no row is dropped."""
    rows = quality.ensure_columns(rows, ["description", "learningOutcomes"])
    return _replaced(
        rows,
        description=tx.strip_html(F.col("description")),
        learningOutcomes=ox.outcomes_text(F.col("learningOutcomes")),
    )


# --- multilingual qualifications ----------------------------------------------


def listed_items(pages: DataFrame, scope: list[str], courses_only: bool = False) -> DataFrame:
    """Items of captured result pages, first seen per scope, with id and JSON text."""
    items = extract.unnest_items(pages, courses_only=courses_only)
    rows = items.select(
        *[c for c in items.columns if c != "item"],
        extract.item_key(F.col("item")).alias("id"),
        F.to_json("item").alias("item"),
    )
    return ledger.first_seen(rows, "id", ["from", "pos"], scope, keep_missing=True)


def multilingual_dataset(
    pages: DataFrame, docs: DataFrame, scope: list[str], require_outcome: bool = True
) -> DataFrame:
    """Pages and the stored documents (`id, country, body`) to flat rows."""
    items = extract.unnest_items(pages).select(extract.item_key(F.col("item")).alias("id"))
    wanted = ledger.only_listed(docs, items.filter(F.col("id").isNotNull()), ["id"])
    return extract.multilingual_records(wanted, require_outcome=require_outcome)


# --- cleaning, publishing, ledger ---------------------------------------------


def cleaned_with_audit(
    rows: DataFrame, key: str, done: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows not cleaned before, with boilerplate removed, and their audit."""
    todo = rows if done is None else ledger.skip_done(rows, done, [key])
    return cleaner.clean_columns(todo), cleaner.audit_rows(todo, key)


def published(lo: DataFrame, qual: DataFrame, source: str | None = None) -> DataFrame:
    return ledger.positional_union(lo, qual, source)


def open_requests(
    grid: DataFrame, completed: DataFrame, stored: DataFrame, cell: list[str], size: int = PAGE_SIZE
) -> DataFrame:
    """Cells still to be crawled, with the offset to go on from."""
    todo = ledger.skip_done(grid, completed, cell)
    return ledger.resume_offsets(todo, stored, cell, size)


def crawl_ledger(
    pages: DataFrame, cell: list[str], size: int = PAGE_SIZE, courses_only: bool = True
) -> DataFrame:
    """State of every cell from its captured pages (`cell, from, payload`):
    pages, items, first-seen items, offset to go on from, complete or not.

    Pages hold their items under `courses`, or with `courses_only=False` in any of the
    known forms. Only ids are shuffled: distinct ones count once, items without id each.
    """
    facts = extract.page_facts(pages, courses_only=courses_only)
    state = ledger.completed_cells(facts, cell, size=size)
    items = extract.unnest_items(pages, courses_only=courses_only)
    ids = items.select(*cell, extract.item_key(F.col("item")).alias("id"))
    counts = ids.groupBy(*cell).agg(
        (F.countDistinct("id") + F.count_if(F.col("id").isNull())).alias("new_items")
    )
    return state.join(counts, cell, "left").fillna(0, ["new_items"])


# --- from files to files --------------------------------------------------------

Accounts = dict[str, int]


def filed(
    docs: DataFrame,
    to_rows: Callable[[Observation], DataFrame],
    write: Callable[[DataFrame], None],
    dead: str,
) -> Accounts:
    """Write the rows of documents; how many were read, kept, dropped by a rule, and dead.

    The counts come from the pass that writes. Documents that cannot be read go to `dead` with
    reason and body; they are looked for only if there are any.
    """
    seen, left = Observation("documents"), Observation("rows")
    write(to_rows(seen).observe(left, F.count(F.lit(1)).alias("kept")))
    counts = {"read": seen.get["read"], "kept": left.get["kept"], "dead": seen.get["dead"]}
    counts["dropped"] = counts["read"] - counts["dead"] - counts["kept"]
    if counts["dead"]:
        writers.write_dead_documents(docs, dead)
    return counts


def lo_files_to_csv(spark: SparkSession, folder: str, out: str, dead: str | None = None) -> Accounts:
    """A folder of learning-opportunity documents to CSV, quotes where needed.

    Documents that cannot be read go to `dead`, by default `<out>_dead`."""
    docs = readers.read_documents(spark, folder, recursive=False)
    named = docs.withColumn("file", F.col("name"))
    return filed(
        docs,
        lambda seen: lo_dataset(named, watch=seen),
        lambda rows: writers.write_csv(rows, out),
        dead or f"{out}_dead",
    )


def qual_files_to_csv(
    spark: SparkSession,
    folder: str,
    out: str,
    rows_per_file: int | None = None,
    dead: str | None = None,
) -> Accounts:
    """A tree of qualification documents to CSV, every cell quoted.

    Documents that cannot be read go to `dead`, by default `<out>_dead`."""
    docs = readers.read_documents(spark, folder)
    return filed(
        docs,
        lambda seen: qual_dataset(docs, watch=seen),
        lambda rows: writers.write_csv(rows, out, quote_all=True, rows_per_file=rows_per_file),
        dead or f"{out}_dead",
    )


def multilingual_files_to_csv(
    spark: SparkSession,
    root: str,
    out: str,
    require_outcome: bool = True,
    dead: str | None = None,
) -> Accounts:
    """Folders named by country, with multilingual documents, to CSV.

    Documents that cannot be read go to `dead`, by default `<out>_dead`."""
    docs = readers.read_documents(spark, f"{root}/*", recursive=False)
    return filed(
        docs,
        lambda seen: extract.multilingual_records(
            docs, folder="folder", require_outcome=require_outcome, watch=seen
        ),
        lambda rows: writers.write_csv(rows, out),
        dead or f"{out}_dead",
    )


def clean_in_batches(
    rows: DataFrame,
    key: str,
    out: str,
    hook: cleaner.RowCleaner | None = None,
    batches: int = 8,
    columns: Sequence[str] = cleaner.TEXT_COLUMNS,
) -> None:
    """Clean the rows whose key is not done yet, in `batches` that are committed one by one.

    A batch is one table of keys, texts before and after, what was removed, and errors. So
    cleaned rows, audit, dead letters and done keys are committed in one step, and
    a run that is killed loses the batch at hand only; the next one goes on with the rest. `key` names
    a row. Without a `hook` the fixed rules clean. A row that the hook fails on, or gives back
    without all its texts, is done too: a dead letter, with its error and its texts as they were.
    """
    spark = rows.sparkSession
    texts = rows.select(key, *[tx.or_empty(F.col(f"`{c}`")).alias(c) for c in columns])
    done = cleaned_batches(spark, out)
    todo = texts if done is None else ledger.skip_done(texts, done, [key])
    part = F.pmod(F.xxhash64(key), F.lit(batches))
    run = uuid.uuid4().hex[:12]
    for k in range(batches):
        batch = todo.filter(part == k)
        if hook is None:
            results = cleaner.rule_results(batch, key, columns)
        else:
            results = cleaner.checked(cleaner.apply_hook(batch, key, hook, columns), columns)
        results.write.parquet(f"{out}/batch={run}-{k}")


def cleaned_batches(spark: SparkSession, out: str) -> DataFrame | None:
    """Results of all committed batches (for `cleaner.hook_rows`, `hook_audit`, `dead_rows`); None if there are none.

    A batch whose writing was cut off has no mark of success and is passed over.
    """
    paths = files.folders_with(spark, out, "_SUCCESS")
    return spark.read.parquet(*paths) if paths else None


def clean_csv(
    spark: SparkSession,
    path: str,
    columns: list[str],
    key: str,
    out: str,
    audit: str,
    hook: cleaner.RowCleaner | None = None,
    batches: int = 8,
    dead: str | None = None,
) -> Accounts:
    """Remove boilerplate from CSV rows by the fixed rules or a hook; audit and dead letters beside the result.

    Columns are found by the header's names, in any order. `key` names a row. A run that was
    cut off is taken up where it ended: batches are kept in `<out>_batches`."""
    rows = readers.read_csv(spark, path, columns)
    texts = [c for c in cleaner.TEXT_COLUMNS if c in columns]
    state = f"{out}_batches"
    clean_in_batches(rows, key, state, hook, batches, texts)
    results = cleaned_batches(spark, state)
    # All at once from the committed batches, so a rerun replaces whole results.
    cleaned = rows.select(*[f"`{c}`" for c in columns if c not in texts]).join(
        cleaner.hook_rows(results, key, texts).drop("error"), key
    )
    seen = Observation("rows")
    cleaned = cleaned.select(*[f"`{c}`" for c in columns]).observe(seen, F.count(F.lit(1)).alias("kept"))
    writers.write_csv(cleaned, out, quote_all=True)
    cleaner.hook_audit(results, key, texts).write.mode("overwrite").parquet(audit)
    lost = Observation("dead")
    failed = cleaner.dead_rows(results, key, texts).observe(lost, F.count(F.lit(1)).alias("dead"))
    failed.write.mode("overwrite").json(dead or f"{out}_dead")
    return {"read": seen.get["kept"], "kept": seen.get["kept"], "dropped": 0, "dead": lost.get["dead"]}


def merge_csv(spark: SparkSession, first: str, second: str, out: str) -> None:
    """One CSV dataset of two, columns by position under the first one's header.

    Raises an error if their headers have different numbers of columns."""
    both = published(readers.read_csv(spark, first), readers.read_csv(spark, second))
    writers.write_csv(both, out)
