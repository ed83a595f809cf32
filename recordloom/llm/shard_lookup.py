"""Lookups in written wavelet shards: counts, occurrences and ids at positions, without the ids.

Every lookup works on a shard's bit planes by rank and select, in arrays: how often an id
occurs in each document is the difference of its ranks at the documents' ends, its
occurrences are selected one plane after the other, and an id at a position is read on the
way down. A task opens one shard at a time (its planes are inflated, `SHARD_TOKENS` ids of as
many bits as the vocabulary needs); the sequence of ids is never rebuilt.

Defined results: documents that share a doc_id, or have none, answer each for itself. Ids that no
document holds, or that no shard could hold, give no row; nor do positions outside of a
document. Positions count from 0 in their document, whose last id is the end id.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.ship import ship
from recordloom.llm.wavelet import _BLOCK, _SHARD_SCHEMA, WaveletMatrix

_AT_ONCE = 8192


class Planes:
    """Rank, select and access of a wavelet matrix for arrays of positions."""

    def __init__(self, matrix: WaveletMatrix):
        self.matrix = matrix
        self.blocks = []
        for plane, counts in zip(matrix.planes, matrix.counts, strict=True):
            padded = np.zeros((len(counts) - 1) * _BLOCK // 8, np.uint8)
            padded[: len(plane)] = plane
            self.blocks.append(padded.reshape(-1, _BLOCK // 8))

    def _bits(self, k: int, block: np.ndarray) -> np.ndarray:
        return np.unpackbits(self.blocks[k][block], axis=1, bitorder="little")

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones among the first `at` bits of plane k."""
        out = np.empty(len(at), np.int64)
        for lo in range(0, len(at), _AT_ONCE):
            some = at[lo : lo + _AT_ONCE]
            block, inside = some // _BLOCK, some % _BLOCK
            bits = self._bits(k, np.minimum(block, len(self.blocks[k]) - 1))
            part = (bits & (np.arange(_BLOCK) < inside[:, None])).sum(axis=1)
            out[lo : lo + _AT_ONCE] = self.matrix.counts[k][block] + part
        return out

    def _down(self, k: int, at: np.ndarray, bit: np.ndarray | int) -> np.ndarray:
        ones = self._ones(k, at)
        return np.where(bit, self.matrix.zeros[k] + ones, at - ones)

    def _digits(self, value: int) -> list[int]:
        width = len(self.blocks)
        return [value >> (width - 1 - k) & 1 for k in range(width)]

    def holds(self, value: int) -> bool:
        return self.matrix.n > 0 and 0 <= value < 1 << len(self.blocks)

    def ranks(self, value: int, at: np.ndarray) -> np.ndarray:
        """How often `value` occurs among the first ids, for each number of these."""
        ends = np.append(at, 0)
        for k, bit in enumerate(self._digits(value)):
            ends = self._down(k, ends, bit)
        return ends[:-1] - ends[-1]

    def occurrences(self, value: int) -> np.ndarray:
        """All positions of `value`, ascending."""
        ends = np.array([0, self.matrix.n])
        digits = self._digits(value)
        for k, bit in enumerate(digits):
            ends = self._down(k, ends, bit)
        at = np.arange(ends[0], ends[1])
        for k in range(len(digits) - 1, -1, -1):
            at = self._select(k, digits[k], at - self.matrix.zeros[k] if digits[k] else at)
        return at

    def _select(self, k: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the nth ones, or zeros, of plane k."""
        ones = self.matrix.counts[k]
        before = ones if bit else np.arange(len(ones)) * _BLOCK - ones
        out = np.empty(len(nth), np.int64)
        for lo in range(0, len(nth), _AT_ONCE):
            some = nth[lo : lo + _AT_ONCE]
            block = np.searchsorted(before, some, side="right") - 1
            run = np.cumsum(self._bits(k, block) == bit, axis=1, dtype=np.int16)
            inside = np.argmax(run == (some - before[block] + 1)[:, None], axis=1)
            out[lo : lo + _AT_ONCE] = block * _BLOCK + inside
        return out

    def ids_at(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), np.int64)
        for k, plane in enumerate(self.matrix.planes):
            bit = (plane[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            value = value << 1 | bit
            at = self._down(k, at, bit)
        return value


def _opened(row: dict) -> tuple[Planes, np.ndarray]:
    """Planes of a shard, and the ends of its documents."""
    planes = [np.frombuffer(zlib.decompress(p), np.uint8) for p in row["planes"]]
    return Planes(WaveletMatrix(planes, row["n_tokens"])), np.cumsum(np.frombuffer(row["lengths"], np.int64))


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return ship(spark).read.schema(_SHARD_SCHEMA).parquet(path)


def _of_ids(
    spark: SparkSession,
    path: str,
    ids: Sequence[int],
    column: str,
    found: Callable[[Planes, np.ndarray, int], tuple[np.ndarray, np.ndarray]],
) -> DataFrame:
    """`doc_id, id` and a column, from the numbers of documents and values that `found` gives per id."""
    wanted = sorted(set(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                planes, ends = _opened(row)
                keys = pa.array(row["doc_ids"], pa.int64())
                for value in filter(planes.holds, wanted):
                    doc, values = found(planes, ends, value)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(doc)), pa.array(np.full(len(doc), value)), pa.array(values)],
                        ["doc_id", "id", column],
                    )

    return _shards(spark, path).mapInArrow(run, f"doc_id long, id long, {column} long")


def counts(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """How often each of a few ids occurs in each document that holds it: `doc_id, id, n`."""

    def found(planes: Planes, ends: np.ndarray, value: int) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(planes.ranks(value, ends), prepend=0)
        doc = np.flatnonzero(n)
        return doc, n[doc]

    return _of_ids(spark, path, ids, "n", found)


def occurrences(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """Where each of a few ids occurs: `doc_id, id, position`, a row per occurrence."""

    def found(planes: Planes, ends: np.ndarray, value: int) -> tuple[np.ndarray, np.ndarray]:
        at = planes.occurrences(value)
        doc = np.searchsorted(ends, at, side="right")
        return doc, at - np.append(0, ends)[doc]

    return _of_ids(spark, path, ids, "position", found)


def ids_at(wanted: DataFrame, path: str) -> DataFrame:
    """Ids at `wanted` (`doc_id`, `position`): distinct rows `doc_id, position, id`.

    The documents' places in the shards are read without the planes and meet the wanted rows by
    doc_id; then a shard meets its own positions, which are no more than it has ids.
    """
    shards = _shards(wanted.sparkSession, path)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int64)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(np.full(n, row["part"], np.int32)),
                        pa.array(np.full(n, row["seq"], np.int32)),
                        pa.array(np.cumsum(lengths) - lengths),
                        pa.array(lengths),
                    ],
                    ["doc_id", "part", "seq", "begin", "length"],
                )

    placed = shards.select("part", "seq", "lengths", "doc_ids").mapInArrow(
        places, "doc_id long, part int, seq int, begin long, length long"
    )
    asked = wanted.select(F.col("doc_id").cast("long"), F.col("position").cast("long")).distinct()
    inside = (F.col("position") >= 0) & (F.col("position") < F.col("length"))
    todo = asked.join(placed, "doc_id").filter(inside).drop("length")

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right["begin"].to_numpy() + right["position"].to_numpy()
        found = np.zeros(0, np.int64)
        if len(at):
            planes, _ = _opened(left.to_pylist()[0])
            found = planes.ids_at(at)
        return pa.table({"doc_id": right["doc_id"], "position": right["position"], "id": found})

    return (
        shards.select("part", "seq", "n_tokens", "planes", "lengths")
        .groupBy("part", "seq")
        .cogroup(todo.groupBy("part", "seq"))
        .applyInArrow(read, "doc_id long, position long, id long")
    )
