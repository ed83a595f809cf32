"""MinHash near-duplicate classes by tensored banding, with exact verification.

Each distinct shingle set gets two small collections of `halves` keys, each key made
of `ROWS` min-hashes. Table (p, q) pairs key p of the first collection with key q of
the second, so 2 * halves * ROWS min-hashes give halves ** 2 tables. `halves` follows
from the threshold: two sets with just that similarity share no table with a probability
of about 2e-5 (12 halves at 0.85, 16 at 0.80).

Documents with the same set form one class before anything else, so copies cost one
row. A shared table key only makes candidates; `linking` compares them on the full sets, until
every pair that shares a key is in one component or was compared.

Defined results: a null or empty text, or one of white space, has the empty set, is
linked with nothing and is kept. Repeated rows stay rows and share a component. A row
without doc_id takes part; it is kept only if its component has no doc_id at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm import arrays, linking
from recordloom.llm.ship import arrow_rows, ship, stored

ROWS = 3
BATCH_ROWS = 2000
# Chance to miss a pair of just the threshold, since it shares no table.
MISSED = 2.5e-5


@dataclass(frozen=True)
class Banding:
    """Threshold of a link in percent, and the tables that find pairs of it."""

    percent: int
    halves: int

    @classmethod
    def of(cls, percent: int) -> Banding:
        if not 0 < percent <= 100:
            raise ValueError(f"the threshold is a percentage above 0, up to 100; got {percent}")
        alike = percent / 100
        halves = 1
        while 1 - (1 - (1 - alike**ROWS) ** halves) ** 2 > MISSED:
            halves += 1
        return cls(percent, halves)

    @property
    def hashes(self) -> int:
        return 2 * self.halves * ROWS


def _min_hashes(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    lowest = np.full(len(factors), 2**32 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), 1 << 14):
            part = shingles[lo : lo + (1 << 14), None] * factors
            lowest = np.minimum(lowest, part.min(axis=0) >> np.uint64(32))
    return lowest.astype(np.uint32)


def _sketches(batches: Iterator[pa.RecordBatch], band: Banding) -> Iterator[pa.RecordBatch]:
    """Size, class and, once a task for each class, the min-hashes."""
    factors, seen = _factors(band), set()
    for batch in batches:
        sizes, ids, mins = [], [], []
        for shingles in arrays.shingle_sets(*arrays.text_buffer(batch["text"])):
            cid = linking.class_id(shingles) if len(shingles) else None
            fresh = cid is not None and cid not in seen
            if fresh:
                seen.add(cid)
            sizes.append(len(shingles))
            ids.append(cid)
            mins.append(_min_hashes(shingles, factors).tobytes() if fresh else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(sizes, pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(mins, pa.binary()),
            ],
            ["doc_id", "n_shingles", "cid", "mins"],
        )


def _factors(band: Banding) -> np.ndarray:
    return arrays.mix(np.arange(1, band.hashes + 1, dtype=np.uint64)) | np.uint64(1)


def _half_keys(mins: np.ndarray) -> np.ndarray:
    """rows x (2 * halves) keys of `ROWS` min-hashes each."""
    parts = mins.reshape(len(mins), -1, ROWS).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64)
    for r in range(ROWS):
        key = arrays.mix(key ^ (parts[:, :, r] + np.uint64(r + 1)))
    return key


def _min_matrix(column: pa.Array, band: Banding) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint32).reshape(len(column), band.hashes)


def _keys_of(mins: np.ndarray, band: Banding) -> np.ndarray:
    """rows x tables: one key of each collection, paired, and named by the table."""
    halves = band.halves
    tables = np.arange(halves * halves, dtype=np.uint64) << np.uint64(32)
    half = _half_keys(mins)
    first, second = half[:, :halves, None], half[:, None, halves:]
    with np.errstate(over="ignore"):
        pairs = (first * np.uint64(3) + second).reshape(len(half), -1)
    return arrays.mix(pairs ^ tables)


def _table_keys(batches: Iterator[pa.RecordBatch], band: Banding) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            part = batch.slice(lo, 2048)
            keys = _keys_of(_min_matrix(part["mins"], band), band)
            cids = part["cid"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(cids, keys.shape[1]))], ["key", "cid"]
            )


def _set_keys(shingles: np.ndarray, band: Banding) -> np.ndarray:
    """The table keys of one set."""
    return _keys_of(_min_hashes(shingles, _factors(band))[None], band)[0]


def _placed(docs: DataFrame, percent: int, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents' sketches, and (`cid`, `rep`, `label`): each class with its component."""
    band = Banding.of(percent)
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = stored(
        rows.mapInArrow(
            lambda batches: _sketches(batches, band), "doc_id long, n_shingles long, cid long, mins binary"
        ),
        "sketches",
    )
    classes = stored(
        sketches.filter(F.col("cid").isNotNull())
        .groupBy("cid")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    keys = sketches.filter(F.col("mins").isNotNull()).select("cid", "mins").mapInArrow(
        lambda batches: _table_keys(batches, band), "key long, cid long"
    )
    pairs = linking.stars(keys, "near")
    labels = linking.linked_components(
        rows, pairs, classes, partial(_set_keys, band=band), arrays.SHINGLE, percent, limit
    )
    placed = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "cid", "rep", F.coalesce("label", "cid").alias("label")
    )
    return sketches, placed


def near_duplicates(docs: DataFrame, percent: int = 85, limit: int | None = None) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every document (`doc_id, text`).

    Two documents are linked if their sets have a similarity of `percent` or more. `limit`: see `linking`.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        sketches, placed = _placed(docs, percent, limit)
    lowest = placed.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = placed.join(lowest, "label").select("cid", "component_id")
    found = sketches.select("doc_id", "n_shingles", "cid").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _with_class(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [
            linking.class_id(shingles) if len(shingles) else None
            for shingles in arrays.shingle_sets(*arrays.text_buffer(batch.column(batch.num_columns - 1)))
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.int64())], names)


def without_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each component: of the smallest doc_id, or of a row without one if none has it.

    Rows with the empty set are in no component and all stay. Of several rows with that
    doc_id in one class, the one with the smallest text stays.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        _, placed = _placed(docs, percent)
    first = F.struct(F.col("rep").isNull(), "rep", "cid")
    best = placed.groupBy("label").agg(F.min_by(F.struct("cid", "rep"), first).alias("best"))
    # The id is part of the key: many copies of one text with ids of their own are many keys.
    by = ["__cid", "__none", "__id"]
    kept = best.select(
        F.col("best.cid").alias("__cid"),
        F.col("best.rep").isNull().alias("__none"),
        F.coalesce("best.rep", F.lit(0)).alias("__id"),
    )
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    filled = F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.filter(filled).select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row"),
        doc_id.isNull().alias("__none"),
        F.coalesce(doc_id, F.lit(0)).alias("__id"),
        text.alias("__cid"),
    )
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__cid", T.LongType())])
    rows = rows.mapInArrow(lambda batches: _with_class(batches, schema.names), schema)
    chosen = (
        rows.join(kept, by, "left_semi")
        .groupBy(*by)
        .agg(F.min_by("__row", F.col("__row.text")).alias("__row"))
        .select("__row.*")
    )
    return chosen.unionByName(docs.filter(~filled))
