"""Bring this package to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from recordloom import session as base

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="recordloom-")) / "recordloom_package.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, f"{root.name}/{file.relative_to(root)}")
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage."""
    return base.written_table(df, tag)


def set_aside(df: DataFrame, used: list[str]) -> dict[str, str]:
    """Names of the columns while an operator works: those in `used` as they are, all others out of the way."""
    return {c: c if c in used else f"__column_{i}" for i, c in enumerate(df.columns)}


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs in here: less memory for JVM and worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a stored table in here leaves the disk with the end of its query.

    Otherwise it stays until the driver happens to collect its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
