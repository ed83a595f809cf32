"""Structured Streaming jobs that process what has arrived and then stop.

Each job keeps its progress in a checkpoint folder, so a rerun goes on after
the files it has seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import text as tx
from recordloom.sources import files


def list_item_stream(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of JSON lines with a fixed schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def ingest_files(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Land every new row exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()


def list_item_files(spark: SparkSession, files: list[str], schema: str) -> DataFrame:
    """The rows of some of the stream's files."""
    return spark.read.schema(schema).json(files)


def first_seen_stream(
    stream: DataFrame,
    read_files: Callable[[list[str]], DataFrame],
    out: str,
    checkpoint: str,
    key: str,
    order: Sequence[str],
    scope: Sequence[str] = (),
) -> None:
    """Keep the first row per (scope, key) over all batches and reruns.

    State are the keys seen, each with its first and its latest batch and the place of its first
    row (`order` and file), however wide the rows are. A key is new if its first and its
    latest batch are the same; its row is then taken from the batch's files, by
    `read_files`. A batch is reduced to one place per key before the shuffle, however
    often a key is repeated. Every batch writes its own folder, which a repeated batch
    overwrites: rows to `out`, keys to `<out>_keys`.
    """
    names = [*scope, key]
    places = (
        stream.filter(tx.or_empty(F.col(key).cast("string")) != "")
        .select(*names, F.struct(*order, F.col("_metadata.file_path").alias("__file")).alias("__place"))
        .withColumn("__arrived", F.current_timestamp())
        .groupBy(*names)
        .agg(
            F.min("__place").alias("__place"),
            F.min("__arrived").alias("__first"),
            F.max("__arrived").alias("__latest"),
        )
    )

    def keep_new(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.filter(F.col("__first") == F.col("__latest")).select(*names, "__place")
        path = f"{out}_keys/batch={batch_id}"
        fresh.write.mode("overwrite").parquet(path)
        fresh = spark.read.schema(fresh.schema).parquet(path)
        # At most the files of one batch.
        met = [r[0] for r in fresh.select("__place.__file").distinct().collect()]
        target = f"{out}/batch={batch_id}"
        if not met:
            spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(target)
            return
        rows = read_files(met)
        won = fresh.select(*[F.col(c).alias(f"__k_{c}") for c in names], "__place")
        same = F.lit(True)
        for c in names:
            same = same & rows[c].eqNullSafe(F.col(f"__k_{c}"))
        for c in order:
            same = same & rows[c].eqNullSafe(F.col(f"__place.{c}"))
        whole = F.struct(*[rows[c] for c in rows.columns])
        first = rows.join(won, same).groupBy("__k_" + key, *[f"__k_{c}" for c in scope]).agg(F.min(whole).alias("__row"))
        first.select("__row.*").write.mode("overwrite").parquet(target)

    query = (
        places.writeStream.outputMode("update")
        .foreachBatch(keep_new)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


_POINTER = "_current"


def _switch(spark: SparkSession, out: str, version: str) -> None:
    """Let the pointer of `out` name `version`, in one rename over the old pointer."""
    files.put_mark(spark, f"{out}/{_POINTER}", version)


def _drop_versions(spark: SparkSession, out: str, kept: set[str]) -> None:
    for folder in files.folders(spark, out):
        name = folder.rpartition("/")[2]
        if name.startswith("version=") and name not in kept:
            files.drop(spark, folder)


def current_version(spark: SparkSession, out: str) -> str | None:
    """Name of the version that the pointer of `out` names; none before the first batch."""
    return files.read_mark(spark, f"{out}/{_POINTER}")


def read_counters(spark: SparkSession, out: str) -> DataFrame:
    """The counters after the last batch that was written whole."""
    version = current_version(spark, out)
    if version is None:
        raise FileNotFoundError(f"no counters yet in {out}")
    return spark.read.parquet(f"{out}/{version}")


def counter_stream(
    stream: DataFrame, out: str, checkpoint: str, by: Sequence[str] = ("country", "level")
) -> None:
    """Running counters per cell, as a whole after every batch; see `read_counters`.

    Each batch writes a version of its own. Only when it is whole, the pointer is switched to it
    in one step, and versions before the last one go. A run that ends anywhere in
    between leaves the counters of the batch before.
    """
    counters = stream.groupBy(*by).agg(
        F.count("*").alias("items"),
        F.count_if(F.col("uri").isNull()).alias("without_uri"),
        F.max("from").alias("last_from"),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        # A repeated batch writes a new version too, so the one the pointer names is never touched.
        spark, version = batch.sparkSession, f"version={batch_id}-{uuid.uuid4().hex[:8]}"
        before = current_version(spark, out)
        batch.write.parquet(f"{out}/{version}")
        _switch(spark, out, version)
        _drop_versions(spark, out, {version, before or version})

    query = (
        counters.writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
