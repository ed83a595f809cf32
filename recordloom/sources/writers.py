"""Writers. Ordered outputs are range-partitioned, never gathered in one task."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import text as tx
from recordloom.operators import extract, ledger
from recordloom.session import written_table
from recordloom.sources import files


def write_ndjson(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append"
) -> None:
    """Append rows as JSON lines, one folder per partition value.

    The rebalance hint lets a large folder be written by many tasks and small
    ones by few.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).json(path)


def write_documents(df: DataFrame, path: str, per_folder: int = 1000) -> None:
    """One JSON file per row, `per_folder` of them in a folder, so that many tasks list them.

    On a mounted folder the tasks write the files themselves: there Hadoop starts several processes
    for every file it creates, to set its mode. A file gets its name when it is whole; a task that
    is run again writes the same names.
    """
    place = files.mounted(df.sparkSession, path)
    if place is None:
        df.write.option("maxRecordsPerFile", 1).json(path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        nr = 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                folder = f"{place}/{task.partitionId():05d}-{nr // per_folder:05d}"
                if nr % per_folder == 0:
                    os.makedirs(folder, exist_ok=True)
                fresh = f"{folder}/.{nr}-{task.taskAttemptId()}"
                with open(fresh, "w", encoding="utf-8", newline="") as out:
                    out.write(text + "\n")
                os.replace(fresh, f"{folder}/{nr}.json")
                nr += 1
        yield pa.RecordBatch.from_arrays([pa.array([nr])], ["n"])

    os.makedirs(place, exist_ok=True)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    df.select(F.to_json(row).alias("text")).mapInArrow(write, "n long").agg(F.sum("n")).collect()


def country_lines(lines: DataFrame) -> DataFrame:
    """Trimmed non-blank lines (`country, level, file, line_no, line`) in merge order."""
    trimmed = lines.withColumn("line", tx.trim_ws(F.col("line"))).filter(F.col("line") != "")
    # A folder column that may be null would be sorted once more at the sink.
    trimmed = trimmed.withColumn("country", tx.or_empty(F.col("country")))
    return trimmed.repartitionByRange("country", "level", "file", "line_no").sortWithinPartitions(
        "country", "level", "file", "line_no"
    )


def write_country_files(lines: DataFrame, path: str) -> None:
    """One folder per country; its part files, in name order, hold the merged lines."""
    country_lines(lines).select("country", "line").write.mode("overwrite").partitionBy(
        "country"
    ).text(path)


def store_new(docs: DataFrame, path: str, key: str, order: Sequence[str]) -> DataFrame:
    """Append the documents whose key is not stored yet; returns the store."""
    spark = docs.sparkSession
    fresh = docs
    try:
        # What is stored already leaves before its bodies would be shuffled.
        stored = spark.read.schema(docs.schema).parquet(path)
        fresh = ledger.skip_done(docs, stored, [key])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    ledger.first_seen(fresh, key, order).write.mode("append").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def level_document_lines(items: DataFrame, item: str = "item") -> DataFrame:
    """Lines of `{"metadata": .., "courses": [ .. ]}` per level, as ordered rows.

    Input columns `level, from, pos` and the item's JSON text. A level's lines in
    order of (`section`, `from`, `pos`) are one valid JSON document; the items
    stay spread over tasks.
    """
    per_level = items.groupBy("level").agg(
        F.max("from").alias("last_from"),
        F.count("*").alias("total"),
        F.min(F.struct("from", "pos")).alias("first"),
    )
    head = F.format_string(
        '{"metadata": {"lastFrom": %d, "totalSaved": %d}, "courses": [', "last_from", "total"
    )
    zero = F.lit(0).cast("bigint")

    def edge(section: int, line: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), line.alias("line"))

    edges = per_level.select("level", F.explode(F.array(edge(0, head), edge(2, F.lit("]}")))).alias("e")).select(
        "level", "e.section", zero.alias("from"), zero.alias("pos"), "e.line"
    )
    is_first = (F.col("from") == F.col("first.from")) & (F.col("pos") == F.col("first.pos"))
    body = items.join(per_level, "level").select(
        "level",
        F.lit(1).alias("section"),
        F.col("from").cast("bigint").alias("from"),
        F.col("pos").cast("bigint").alias("pos"),
        F.concat(F.when(is_first, "").otherwise(","), F.col(item)).alias("line"),
    )
    return edges.unionByName(body)


def write_level_documents(items: DataFrame, path: str, item: str = "item") -> None:
    """One folder per level; its part files, in name order, form the JSON document."""
    order = ["level", "section", "from", "pos"]
    lines = level_document_lines(items, item=item)
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "level", "line"
    ).write.mode("overwrite").partitionBy("level").text(path)


def as_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as text, nested ones as JSON; columns in `keep` as they are."""

    def cell(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if field.name in keep:
            return c
        nested = isinstance(field.dataType, T.ArrayType | T.StructType | T.MapType | T.VariantType)
        return (F.to_json(c) if nested else c.cast("string")).alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def write_csv(
    df: DataFrame,
    path: str,
    quote_all: bool = False,
    rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """CSV with header. Quotes only where needed, or around every cell.

    Null and empty are both written as an empty cell; edge spaces survive.
    """
    writer = (
        as_text(df, partition_by)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quoteAll", quote_all)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if rows_per_file and rows_per_file > 0:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*partition_by).csv(path)


def write_shards(
    df: DataFrame, path: str, order: Sequence[str], rows_per_shard: int, quote_all: bool = True
) -> None:
    """One folder per shard of exactly `rows_per_shard` rows, in order."""
    sharded = ledger.shard_rows(df, order, rows_per_shard)
    placed = sharded.repartition("shard").sortWithinPartitions("shard", *order)
    write_csv(placed, path, quote_all, partition_by=["shard"])


def write_split(df: DataFrame, reason: str, good_path: str, dead_path: str) -> None:
    """Rows without a reason to one table, dead letters to another.

    The marked rows are stored first, so that the plan behind them runs once and both
    tables come from the same rows.
    """
    df = written_table(df, "marked")
    df.filter(F.col(reason).isNull()).drop(reason).write.mode("append").parquet(good_path)
    df.filter(F.col(reason).isNotNull()).write.mode("append").parquet(dead_path)


def write_dead_documents(docs: DataFrame, path: str) -> None:
    """Files whose body is no record, as JSON lines with the reason and the body.

    A body as large as no JSON reader takes is left where it is, in `file`. The lines replace those
    of an earlier run.
    """
    body = F.when(F.octet_length("body") <= extract.VARIANT_BYTES, F.col("body")).alias("body")
    dead = extract.malformed(docs).select("file", extract.dead_reason(F.col("body")).alias("reason"), body)
    dead.write.mode("overwrite").json(path)


def write_audit(audit: DataFrame, path: str) -> None:
    """Audit rows keep their nested form."""
    audit.write.mode("append").parquet(path)
