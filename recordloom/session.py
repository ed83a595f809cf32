"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: list[str] = []


def build_session(app: str = "recordloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Settings results depend on; safe to call on any session."""
    # A JSON object with a repeated key keeps the last value, as JSON.parse does.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches: `spark.checkpoint.dir` of the session.

    Where the setting is absent, a session on this machine alone (tests) takes a
    temporary folder; on a cluster that is an error, as no executor could read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_BASE:
        _LOCAL_BASE.append(tempfile.mkdtemp(prefix="recordloom-"))
    return _LOCAL_BASE[0]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/recordloom/{tag}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The stored rows outlive lost executors and have no lineage to recompute.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
