"""Readers. Every reader returns a DataFrame and starts no job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import text as tx
from recordloom.functions import variants as vx

# Names of grid files (AUT_eqf3.ndjson) and of index files.
GRID_FILE = r"(?i)^([A-Z]{3})_eqf(\d+)\.ndjson$"
INDEX_FILE = r"level=?(\d+)(?:\.index\.json|/)"
SPLITS = 16


def base_name(file: Column) -> Column:
    return F.substring_index(file, "/", -1)


def folder_name(file: Column) -> Column:
    return F.substring_index(F.substring_index(file, "/", -2), "/", 1)


def grid_columns(file: Column) -> tuple[Column, Column]:
    """Country and level named by a grid file; NULL when the name is another."""
    name = base_name(file)
    country = F.upper(F.nullif(F.regexp_extract(name, GRID_FILE, 1), F.lit("")))
    level = F.nullif(F.regexp_extract(name, GRID_FILE, 2), F.lit("")).cast("int")
    return country, level


def is_ndjson_name(file: Column) -> Column:
    return F.lower(file).endswith(".ndjson")


def country_of_file(file: Column) -> Column:
    """Base name without its extension, in upper case."""
    return F.upper(F.regexp_replace(base_name(file), r"\.[^.]*$", ""))


def _text(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    return spark.read.options(**options).text(path)


def read_lines(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Trimmed non-blank lines with their file; big files are split over tasks."""
    lines = _text(spark, path, **options).select(
        F.col("_metadata.file_path").alias("file"), tx.trim_ws(F.col("value")).alias("line")
    )
    return lines.filter(F.col("line") != "")


def read_ndjson(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """One parsed object per line; a malformed line keeps its row with item NULL."""
    return vx.with_json(read_lines(spark, path, **options), "line", "item")


def numbered_lines(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Every line, blank ones included, with its number within its file from 1.

    A file may be read as many blocks. The lines of a block have running ids, so a line's
    distance from the block's first is its number there, and no line is sorted; the line counts
    of the file's earlier blocks are added.
    """
    lines = _text(spark, path, **options).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    skipped = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = blocks.select("file", "block", (skipped - F.col("first") + 1).alias("shift"))
    # One row per block: each task holds those of its blocks in a hash table.
    return lines.join(starts.hint("shuffle_hash"), ["file", "block"]).select(
        "file", (F.col("at") + F.col("shift")).alias("line_no"), "line"
    )


def lines_after(lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """Lines beyond the last one the ledger (`file`, `last_line`) has seen."""
    last = F.coalesce(F.col("last_line"), F.lit(0))
    return (
        lines.join(ledger.select("file", "last_line"), "file", "left")
        .filter(F.col("line_no") > last)
        .drop("last_line")
    )


def read_documents(
    spark: SparkSession, path: str | list[str], recursive: bool = True
) -> DataFrame:
    """One row per JSON file: `file` path, `name`, `folder`, `body` text.

    Read as binary files: Spark's text source copies the Hadoop settings anew for every file.
    Spark plans a task for a few small files, as if each had 4 MB; `SPLITS` such splits share one,
    as long as every core has some tasks.
    """
    options = {"recursiveFileLookup": recursive, "pathGlobFilter": "*.[jJ][sS][oO][nN]"}
    docs = spark.read.format("binaryFile").options(**options).load(path)
    splits = docs.select("path").rdd.getNumPartitions()
    tasks = max(splits // SPLITS, 4 * spark.sparkContext.defaultParallelism)
    file = F.col("_metadata.file_path")
    return docs.select(
        file.alias("file"),
        base_name(file).alias("name"),
        folder_name(file).alias("folder"),
        F.col("content").cast("string").alias("body"),
    ).coalesce(min(tasks, max(1, splits)))


def read_index(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Uris of index files (JSON arrays) by level, and the files that hold none.

    The level stands in the file name or its folder. An array is read element by element, each a
    value of its own, so its length is not bound by the size of one VARIANT; one task
    reads one file, and a level may have any number of files.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")
    )
    # The parser takes no notice of what follows the array, so the text must end with it.
    whole = F.rtrim(F.col("body"), F.lit(" \t\r\n")).endswith("]")
    parsed = files.select(
        "file",
        F.regexp_extract("file", INDEX_FILE, 1).cast("int").alias("level"),
        F.when(whole, F.from_json("body", "array<variant>")).alias("uris"),
    )
    uris = parsed.select("file", "level", F.posexplode("uris").alias("pos", "v"))
    good = uris.select(
        "file", "level", "pos", F.when(vx.is_text(F.col("v")), vx.text_at(F.col("v"), "$")).alias("uri")
    )
    return good, vx.keep_rows(parsed, F.col("uris").isNull()).select("file", "level")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    surplus: str | None = None,
) -> DataFrame:
    """CSV with header, quoted line breaks allowed; all text, '' for empty cells.

    The header names the columns; of several files all must have the first one's header.
    With `columns`, those are taken by name in that order, and one that the header lacks
    is ''. Short rows are padded. Cells beyond the header have no name: a column
    `surplus`, if wanted, has the whole line of such rows and NULL for others.
    """
    options = {
        "header": True, "multiLine": True, "escape": '"', "enforceSchema": False,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    found = spark.read.options(**options).csv(path)
    # Names come from the header alone, so reading them starts no job over the rows.
    names = found.columns
    if surplus:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, surplus]])
        marked = spark.read.schema(schema).options(**options, columnNameOfCorruptRecord=surplus)
        found = marked.csv(path)
    cells = [
        tx.or_empty(F.col(f"`{c}`")).alias(c) if c in names else F.lit("").alias(c)
        for c in (names if columns is None else columns)
    ]
    short = F.col(f"`{names[-1]}`").isNull() if names else F.lit(True)
    extra = [F.when(~short, F.col(f"`{surplus}`")).alias(surplus)] if surplus else []
    return found.select(*cells, *extra)
