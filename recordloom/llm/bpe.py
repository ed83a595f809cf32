"""Byte-level BPE encoding and decoding with padded numpy matrices.

Distinct pretokens of a batch are put in buckets by length, one matrix row per piece.
In every round each row merges its leftmost pair of minimum rank, found by a hashed
pair lookup, and the row is compacted; rows without a pair leave the matrix. Pieces
longer than the widest bucket (a letter run of over 256 bytes) take the same merges
through a heap, since a matrix round would cost their whole width per merge.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated
rows are encoded alike. Other columns of the input are kept as they are.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm import arrays
from recordloom.llm.ship import ship

WIDTHS = (4, 8, 16, 32, 64, 128, 256)
MAX_VOCABULARY = 1_000_000
_CELLS = 1 << 21
_NONE = np.int64(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by rank; refuses files beyond the broadcast bound."""
    pairs = [line.split() for line in Path(path).read_bytes().splitlines() if line]
    if len(pairs) > MAX_VOCABULARY:
        raise ValueError(f"{len(pairs)} tokens; at most {MAX_VOCABULARY} are sent to the workers")
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class BytePairs:
    """Merges of a rank list: pair of ids -> id, as an open hash table."""

    def __init__(self, tokens: list[bytes]):
        rank = {token: i for i, token in enumerate(tokens) if token}
        self.single = np.array([rank.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.single < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.pairs = {}
        for token, i in rank.items():
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = i
        bits = max(10, (4 * len(self.pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.found = np.full(1 << bits, _NONE, np.int64)
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        values = np.fromiter(self.pairs.values(), np.int64, len(keys))
        place, self.probes = self._slot(keys), 0
        while len(keys):
            # One key takes each free slot; the others try the next one.
            free = self.slots[place] < 0
            self.slots[place[free]] = keys[free]
            self.found[place[free]] = values[free]
            rest = self.slots[place] != keys
            self.found[place[~rest]] = values[~rest]
            keys, values = keys[rest], values[rest]
            place = (place[rest] + 1) & (len(self.slots) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, or a value above all ids."""
        keys = (left.astype(np.int64) << 32) | right
        place = self._slot(keys)
        out = np.where(self.slots[place] == keys, self.found[place], _NONE)
        open_ = np.flatnonzero((out == _NONE) & (self.slots[place] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            place[open_] = (place[open_] + 1) & (len(self.slots) - 1)
            held = self.slots[place[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.found[place[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def matrix(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all rows of a padded id matrix; returns ids and sizes."""
        rows, sizes = rows.copy(), sizes.copy()
        width = rows.shape[1]
        if width < 2:
            return rows, sizes
        live = np.arange(len(rows))
        ids = rows
        ranks = np.where(
            np.arange(1, width) < sizes[:, None],
            self.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1),
            _NONE,
        )
        n = sizes.copy()
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ids)), at]
            done = best == _NONE
            if done.any():
                rows[live[done], : ids.shape[1]] = ids[done]
                sizes[live[done]] = n[done]
                keep = ~done
                live, ids, ranks, n, at, best = (x[keep] for x in (live, ids, ranks, n, at, best))
                if not len(live):
                    return rows, sizes
            # Compaction: what stands after the merged pair moves one place down.
            column = np.arange(ids.shape[1] - 1)
            source = column + (column > at[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            each = np.arange(len(ids))
            ids[each, at] = best
            n = n - 1
            if ids.shape[1] < 2:
                ranks = np.full((len(ids), 1), _NONE)
                continue
            # Rank i belongs to the pair (i, i + 1).
            column = np.arange(ids.shape[1] - 1)
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.lookup(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at + 1 < n)
            ranks[right, at[right]] = self.lookup(ids[right, at[right]], ids[right, at[right] + 1])
            last = np.flatnonzero((at + 1 >= n) & (at < ranks.shape[1]))
            ranks[last, at[last]] = _NONE

    def long_piece(self, piece: bytes) -> list[int]:
        """The same merges for one long piece, over a linked list and a heap."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        get = self.pairs.get
        heap = [
            (rank, i)
            for i in range(len(ids) - 1)
            if (rank := get((ids[i], ids[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (r := get((rank, ids[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get((ids[before[i]], rank))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [x for x in ids if x >= 0]

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and the number of ids of each."""
        column = pa.array(texts, pa.large_string())
        data, offsets = arrays.text_buffer(column)
        lengths = np.diff(offsets)
        counts = np.zeros(len(texts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for width in WIDTHS:
            bucket = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            step = max(1, _CELLS // width)
            for lo in range(0, len(bucket), step):
                chosen = bucket[lo : lo + step]
                size = lengths[chosen]
                column_no = np.arange(int(size.max()))
                inside = column_no < size[:, None]
                where = np.where(inside, offsets[chosen][:, None] + column_no, 0)
                rows, size = self.matrix(np.where(inside, self.single[data[where]], 0), size)
                counts[chosen] = size
                parts.append((chosen, rows[np.arange(rows.shape[1]) < size[:, None]]))
        for i in np.flatnonzero(lengths > low).tolist():
            ids = self.long_piece(data[offsets[i] : offsets[i + 1]].tobytes())
            counts[i] = len(ids)
            parts.append((np.array([i]), np.array(ids, np.int64)))
        out = np.empty(int(counts.sum()), np.int64)
        begin = np.cumsum(counts) - counts
        for chosen, ids in parts:
            size = counts[chosen]
            skip = np.cumsum(size) - size
            out[np.repeat(begin[chosen] - skip, size) + np.arange(len(ids))] = ids
        return out, counts


_MODELS: dict[int, tuple[BytePairs, arrays.PieceTable]] = {}


def _model(shared) -> tuple[BytePairs, arrays.PieceTable]:
    # A worker keeps the table of one vocabulary, and the pieces it has met.
    if shared.id not in _MODELS:
        _MODELS.clear()
        _MODELS[shared.id] = BytePairs(shared.tokens.value), arrays.PieceTable()
    return _MODELS[shared.id]


class _Shared:
    def __init__(self, tokens, id_):
        self.tokens, self.id = tokens, id_


def _encode_column(shared, column: pa.Array) -> pa.Array:
    pairs, table = _model(shared)
    points, offsets = arrays.code_points(*arrays.text_buffer(column))
    begin, length, hashes, at = arrays.pretokens(points, offsets)
    ids, sizes = table.encode(points, begin, length, hashes, pairs.pieces)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(
        pa.array(ends[at].astype(np.int32)), pa.array(ids.astype(np.int32))
    )


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes of a text column, so that ids fit beside the texts."""
    for batch in batches:
        _, offsets = arrays.text_buffer(batch[column])
        lo = 0
        while lo < batch.num_rows:
            limit = offsets[lo] + 2 * arrays.STRETCH
            hi = max(lo + 1, int(np.searchsorted(offsets, limit, "right")) - 1)
            yield batch.slice(lo, min(hi, batch.num_rows) - lo)
            lo = hi


def _share(df: DataFrame, tokens: list[bytes]) -> _Shared:
    context = ship(df.sparkSession).sparkContext
    digest = hashlib.sha256(b"\0".join(tokens)).digest()
    return _Shared(context.broadcast(tokens), int.from_bytes(digest[:8], "big"))


def encode(df: DataFrame, tokens: list[bytes], text: str = "text", out: str = "ids") -> DataFrame:
    """`df` with the ids (`array<int>`) of a text column, pretoken by pretoken."""
    shared = _share(df, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, _encode_column(shared, part[text])], [*part.schema.names, out]
            )

    return df.mapInArrow(run, df.drop(out).schema.add(out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, tokens: list[bytes], ids: str = "ids", out: str = "bytes") -> DataFrame:
    """`df` with the bytes that a column of ids stands for."""
    shared = _share(df, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.tokens.value.__getitem__
        for batch in batches:
            texts = [b"".join(map(get, row or ())) for row in batch[ids].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, out]
            )

    return df.mapInArrow(run, df.drop(out).schema.add(out, "binary"))


def digests(
    df: DataFrame, tokens: list[bytes], keep: list[str], text: str = "text", ids_too: bool = False
) -> DataFrame:
    """Columns `keep` with `n_tokens`, `ids_sha256` and `decoded_sha256`; `ids` if wanted.

    Encodes, and decodes the ids again; bytes never leave the worker.
    """
    shared = _share(df, tokens)
    inner = [f"k{i}" for i in range(len(keep))]
    kept = [F.col(k).alias(i) for k, i in zip(keep, inner, strict=True)]
    rows = df.select(*kept, F.col(text).cast("string").alias("text"))
    schema = df.select(*keep).schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if ids_too:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.tokens.value
        names = list(map(str, range(len(vocabulary))))
        for part in _parts(batches, "text"):
            encoded = _encode_column(shared, part["text"])
            offsets = encoded.offsets.to_numpy()
            values = encoded.values.to_numpy()
            listed, decoded = [], []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                ids = values[lo:hi].tolist()
                joined = ",".join(map(names.__getitem__, ids))
                listed.append(hashlib.sha256(joined.encode()).hexdigest())
                back = b"".join(map(vocabulary.__getitem__, ids))
                decoded.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    *[part[i] for i in inner],
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(listed, pa.string()),
                    pa.array(decoded, pa.string()),
                    *([encoded] if ids_too else []),
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)


__all__ = ["BytePairs", "decode", "digests", "encode", "read_ranks"]
