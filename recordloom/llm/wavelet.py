"""Token ids in wavelet-matrix shards: succinct bit planes with rank and select.

A shard file is a Parquet file with one row: the ids of a run of documents as `BITS`
bit planes (highest bit first; in each plane the zeros move to the front of the next
one), the number of zeros per plane, and the documents' keys and lengths. From the
planes alone a shard answers access, count and occurrence lookups, and gives back all
ids in order. Spark's own writer puts the files in place, so a lost executor's attempt
leaves nothing behind.

Documents are range-partitioned by key; a task fills its shards one after the other
and holds one shard at a time. A document lies in one shard.

Defined results: an added token of the tokenizer (such as `<|endoftext|>`) is text like any
other, or with `added_tokens` has its own id, as in the library's own call on whole texts.
A null or empty text has the end id only. Repeated keys keep all
rows, ordered by text. Rows without a key come first.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom import session as base
from recordloom.llm import arrays
from recordloom.llm.ship import ship

SHARD_TOKENS = 1 << 22
_BLOCK = 512


class WaveletMatrix:
    """Rank and select over a sequence of small integers."""

    def __init__(self, planes: list[np.ndarray], n: int):
        self.planes, self.n = planes, n
        self.zeros: list[int] = []
        self.counts: list[np.ndarray] = []
        for plane in planes:
            padded = np.zeros(-(-n // _BLOCK) * _BLOCK // 8, np.uint8)
            padded[: len(plane)] = plane
            per_block = np.bitwise_count(padded).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.int64)
            ones = np.concatenate([[0], np.cumsum(per_block)])
            self.counts.append(ones)
            self.zeros.append(n - int(ones[-1]))

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, now = [], ids
        for b in range(bits - 1, -1, -1):
            one = (now >> now.dtype.type(b)) & now.dtype.type(1) != 0
            planes.append(np.packbits(one, bitorder="little"))
            now = np.concatenate([now[~one], now[one]])
        return cls(planes, len(ids))

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3]) >> (i & 7) & 1

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        block = i // _BLOCK
        lo = block * _BLOCK // 8
        part = self.planes[k][lo : i >> 3]
        total = int(self.counts[k][block]) + int(np.bitwise_count(part).sum())
        if i & 7:
            total += (int(self.planes[k][i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return total

    def _down(self, k: int, i: int, bit: int) -> int:
        ones = self._ones(k, i)
        return self.zeros[k] + ones if bit else i - ones

    def access(self, i: int) -> int:
        """Id at position i."""
        value = 0
        for k in range(len(self.planes)):
            bit = self._bit(k, i)
            value = value << 1 | bit
            i = self._down(k, i, bit)
        return value

    def rank(self, value: int, i: int) -> int:
        """How often `value` occurs among the first i ids."""
        lo, hi = 0, i
        for k in range(len(self.planes)):
            bit = value >> (len(self.planes) - 1 - k) & 1
            lo, hi = self._down(k, lo, bit), self._down(k, hi, bit)
        return hi - lo

    def select(self, value: int, nth: int) -> int:
        """Position of the nth occurrence (from 0), or -1."""
        if nth < 0 or nth >= self.rank(value, self.n):
            return -1
        lo = 0
        for k in range(len(self.planes)):
            lo = self._down(k, lo, value >> (len(self.planes) - 1 - k) & 1)
        at = lo + nth
        for k in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - k) & 1
            at = self._select_bit(k, bit, at - self.zeros[k] if bit else at)
        return at

    def _select_bit(self, k: int, bit: int, nth: int) -> int:
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(k, mid + 1)
            if (ones if bit else mid + 1 - ones) <= nth:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def ids(self) -> np.ndarray:
        """All ids in order, rebuilt from the lowest plane upwards."""
        value = np.zeros(self.n, np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").astype(bool)
            upper = np.empty(self.n, np.uint32)
            zeros = self.zeros[k]
            upper[~one] = value[:zeros]
            upper[one] = value[zeros:] | np.uint32(1 << (len(self.planes) - 1 - k))
            value = upper
        return value


_TOKENIZERS: dict[tuple[int, bool], tuple] = {}


def _tokenizer(config, added_tokens: bool) -> tuple:
    """Tokenizer of this worker, the pieces it has met, and its added tokens by text."""
    text = config.value
    key = zlib.crc32(text.encode()), added_tokens
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(text)
        made.encode_special_tokens = not added_tokens
        added = made.get_added_tokens_decoder() if added_tokens else {}
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = made, arrays.PieceTable(), {t.content: (i, t) for i, t in added.items()}
    return _TOKENIZERS[key]


def _added_places(
    points: np.ndarray, offsets: np.ndarray, ids: dict[str, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and id of the added tokens in the texts: the first, of these the longest."""
    pattern = re.compile("|".join(map(re.escape, sorted(ids, key=len, reverse=True))))
    joined = points.tobytes().decode("utf-32-le")
    found = []
    if pattern.search(joined):
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            found += [(*m.span(), ids[m.group()]) for m in pattern.finditer(joined, lo, hi)]
    return tuple(np.array(found, np.int64).reshape(-1, 3).T)


def _encode(config, column: pa.Array, added_tokens: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and each text's number of ids.

    The library encodes every distinct pretoken once; it cuts a text at the added tokens,
    splits the stretches between them in the same pretokens by itself and treats each
    alone, so the ids are those of whole texts.
    """
    made, table, added = _tokenizer(config, added_tokens)

    def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for lo in range(0, len(texts), 8192):
            for e in made.encode_batch_fast(texts[lo : lo + 8192], add_special_tokens=False):
                got = e.ids
                ids += got
                sizes.append(len(got))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    # Tokens that take in blanks, match whole words only or wait for others are left to the library.
    kinds = {t.normalized for _, t in added.values()}
    if len(kinds) > 1 or any(t.lstrip or t.rstrip or t.single_word for _, t in added.values()):
        return pieces([t or "" for t in column.to_pylist()])
    points, offsets = arrays.code_points(*arrays.text_buffer(column))
    marked = np.zeros(len(column), bool)
    if added:
        first, last, own = _added_places(points, offsets, {c: i for c, (i, _) in added.items()})
        if len(first):
            # A stretch begins with each text and after each added token, whose id goes before it.
            begins = np.concatenate([offsets[:-1], first])
            order = np.argsort(begins, kind="stable")
            marked = order >= len(column)
            inside = np.zeros(len(points) + 1, np.int64)
            np.add.at(inside, first, 1)
            np.add.at(inside, last, -1)
            left = np.cumsum(inside)[:-1] == 0
            before = np.concatenate([[0], np.cumsum(left)])
            points, offsets = points[left], before[np.append(begins[order], offsets[-1])]
    begin, length, hashes, at = arrays.pretokens(points, offsets)
    ids, sizes = table.encode(points, begin, length, hashes, pieces)
    ends = np.concatenate([[0], np.cumsum(sizes)])[at]
    if marked.any():
        ids = np.insert(ids, ends[:-1][marked], own)
        return ids, np.add.reduceat(np.diff(ends) + marked, np.flatnonzero(~marked))
    return ids, np.diff(ends)


def _shard(bits: int, ids: list, sizes: list, keys: list, seq: int, before: int) -> dict:
    joined = np.concatenate(ids)
    matrix = WaveletMatrix.build(joined.astype(np.uint16 if bits <= 16 else np.uint32), bits)
    return {
        "seq": seq,
        "part_start": before,
        "n_tokens": len(joined),
        "n_docs": sum(map(len, sizes)),
        "planes": [zlib.compress(p.tobytes(), 1) for p in matrix.planes],
        "lengths": np.concatenate(sizes).astype(np.int64).tobytes(),
        "doc_ids": [k for part in keys for k in part.to_pylist()],
    }


_SHARD_SCHEMA = (
    "part int, seq int, part_start long, n_tokens long, n_docs long, "
    "planes array<binary>, lengths binary, doc_ids array<long>"
)


def write_shards(
    docs: DataFrame,
    tokenizer_file: str,
    path: str,
    end_id: int,
    shard_tokens: int = SHARD_TOKENS,
    added_tokens: bool = False,
) -> None:
    """Write the ids of `docs` (`doc_id`, `text`), ascending by doc_id, as shards.

    With `added_tokens` the tokenizer's added tokens are found in the texts.
    """
    spark = ship(docs.sparkSession)
    config = spark.sparkContext.broadcast(Path(tokenizer_file).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        made, _, _ = _tokenizer(config, added_tokens)
        bits = max(int(made.get_vocab_size()) - 1, end_id, 1, *made.get_added_tokens_decoder()).bit_length()
        ids, sizes, keys, held, seq, before = [], [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            shard = {"part": part, **_shard(bits, ids, sizes, keys, seq, before)}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.binary()), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(shard.values(), types, strict=True)], list(shard)
            )

        from recordloom.llm.bpe import _parts

        for batch in _parts(batches, "text"):
            got, n = _encode(config, batch["text"], added_tokens)
            ends = np.cumsum(n)
            # The end id follows the last id of each document.
            ids.append(np.insert(got, ends, end_id))
            sizes.append(n + 1)
            keys.append(batch["doc_id"])
            held += len(ids[-1])
            if held >= shard_tokens:
                yield row()
                before, seq = before + held, seq + 1
                ids, sizes, keys, held = [], [], [], 0
        if held:
            yield row()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    rows = ordered.mapInArrow(run, _SHARD_SCHEMA)
    rows.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the shards: `doc_id, start, n_tokens, ids_crc32`.

    `start` counts the ids of all documents before it: those earlier in its shard, in
    earlier shards of its range, and in earlier ranges (one number per range).
    """
    shards = spark.read.schema(_SHARD_SCHEMA).parquet(path)
    ranges = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                planes = [np.frombuffer(zlib.decompress(p), np.uint8) for p in row["planes"]]
                ids = WaveletMatrix(planes, row["n_tokens"]).ids().astype("<u4")
                lengths = np.frombuffer(row["lengths"], np.int64)
                begin = np.cumsum(lengths) - lengths
                raw = memoryview(ids.tobytes())
                crc = [
                    zlib.crc32(raw[4 * b : 4 * (b + n)])
                    for b, n in zip(begin.tolist(), lengths.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["part"]] * len(crc), pa.int32()),
                        pa.array(begin + row["part_start"], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
                )

    rows = shards.mapInArrow(
        run, "doc_id long, part int, at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(offsets, "part").select(
        "doc_id", (F.col("at") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def shard_folder(spark: SparkSession) -> str:
    return base.scratch_path(spark, "wavelet")
