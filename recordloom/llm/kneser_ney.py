"""Interpolated modified Kneser-Ney bigram model, counted in Spark, mapped by workers.

Counting. Tasks reduce their bigrams to distinct ones with counts and send them, packed,
to tiles of the plane (hash of the context) x (hash of the word), so a frequent context
or word spreads over many tiles. A tile adds the counts up and stores its bigrams as
sorted hash arrays. Per context (how often, and with how many words seen once, twice,
more often) and per word (how often, after how many contexts) its sums go on to slices by
hash, which store sorted arrays too. Only sums of counts come to the driver.

Scoring. Workers map the arrays into memory (`numpy.memmap`) from the shared folder and
look up sorted keys, so a worker holds what its texts touch. A shared folder that is no
mounted path is read through `pyarrow.fs`, one copy of a file per executor.

P(w|u) = max(c(uw) - D(c), 0) / c(u) + (D1 N1(u) + D2 N2(u) + D3 N3(u)) / c(u) * P(w)
P(w)   = max(t(w) - E(t), 0) / T + (E1 T1 + E2 T2 + E3 T3) / T * 1 / (V + 1)

with t(w) the number of contexts of w and T their sum, and discounts from the counts of
counts. A word not known has the last share alone; after a context not known P(w) holds.
Probabilities of all known words and the unknown one add up to 1.

Words are compared by 64-bit hashes. Defined results: a null or empty text has one token,
the end. Repeated rows count, and are scored, each time. Without any training row V, N
and all counts are 0, and every probability is 1.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom import session as base
from recordloom.llm import arrays
from recordloom.llm.bpe import _parts
from recordloom.llm.ship import ship

FLUSH_TOKENS = 3_000_000
TILE_BYTES = 12_000_000
WORD_TILES = 4
_BEGIN = np.uint64(0x5851F42D4C957F2D)
_END = np.uint64(0x14057B7EF767814F)
_U = np.uint64


def _bigrams(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and word of every token of the texts, and the texts' offsets into them."""
    hashes, at = arrays.words(*arrays.text_buffer(column))
    before = np.insert(hashes, at[:-1], _BEGIN)
    word = np.insert(hashes, at[1:], _END)
    return before, word, at + np.arange(len(at))


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return arrays.mix(before * _U(0x9E3779B97F4A7C15) + word)


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(hashes), np.int64)
    return (hashes >> _U(64 - bits)).astype(np.int64)


def _packed(*columns: np.ndarray) -> bytes:
    head = np.array([len(c) for c in columns], np.int64).tobytes()
    return head + b"".join(c.tobytes() for c in columns)


def _unpacked(data: bytes, types: list) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(types))
    out, at = [], 8 * len(types)
    for n, kind in zip(sizes.tolist(), types, strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys with the sums of each value column."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return keys, *[v.astype(np.int64) for v in values]
    return keys[starts], *[np.add.reduceat(v[order].astype(np.int64), starts) for v in values]


# --- files ------------------------------------------------------------------------


def _plain(path: str) -> str | None:
    """Local form of a path on a mounted file system."""
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    return None if "://" in path else path


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """One array as raw little-endian values, put in place at once."""
    plain = _plain(folder)
    draft = f"{name}.{uuid.uuid4().hex}"
    if plain:
        os.makedirs(plain, exist_ok=True)
        values.tofile(f"{plain}/{draft}")
        os.replace(f"{plain}/{draft}", f"{plain}/{name}")
    else:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        with store.open_output_stream(f"{root}/{draft}") as out:
            out.write(values.tobytes())
        store.move(f"{root}/{draft}", f"{root}/{name}")


_MAPPED: dict[str, np.ndarray] = {}


def _load(folder: str, name: str, kind) -> np.ndarray:
    key = f"{folder}/{name}"
    if key not in _MAPPED:
        if len(_MAPPED) > 4096:
            _MAPPED.clear()
        plain = _plain(folder)
        if plain is None:
            from pyarrow import fs
            from pyspark import SparkFiles

            plain = f"{SparkFiles.getRootDirectory()}/model-{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"
            if not os.path.exists(f"{plain}/{name}"):
                os.makedirs(plain, exist_ok=True)
                store, root = fs.FileSystem.from_uri(folder)
                draft = f"{plain}/{name}.{uuid.uuid4().hex}"
                fs.copy_files(f"{root}/{name}", draft, source_filesystem=store)
                os.replace(draft, f"{plain}/{name}")
        size = os.path.getsize(f"{plain}/{name}")
        mapped = np.memmap(f"{plain}/{name}", kind, "r") if size else np.empty(0, kind)
        _MAPPED[key] = mapped
    return _MAPPED[key]


# --- counting ---------------------------------------------------------------------

_PAIR_TYPES = [np.uint64, np.uint32, np.uint64, np.uint32]
_CONTEXT_TYPES = [np.uint64] + [np.uint32] * 4
_WORD_TYPES = [np.uint64] + [np.uint32] * 2


def _tile_rows(before: list, word: list, bits: int, word_bits: int) -> Iterator[pa.RecordBatch]:
    u, w = np.concatenate(before), np.concatenate(word)
    keys = _pair_keys(u, w)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(starts, len(keys))).astype(np.uint32)
    u, w = u[order[starts]], w[order[starts]]
    tile = (_top(u, bits) << word_bits) | _top(w, word_bits)
    order = np.lexsort((u, tile))
    u, w, counts, tile = u[order], w[order], counts[order], tile[order]
    edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        mine = u[lo:hi]
        runs = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        lengths = np.diff(np.append(runs, hi - lo)).astype(np.uint32)
        data = _packed(mine[runs], lengths, w[lo:hi], counts[lo:hi])
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(tile[lo])], pa.int64()), pa.array([data], pa.binary())], ["tile", "data"]
        )


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _row(kind: str, part: int, data: bytes | None, numbers: list[int]) -> dict:
    return {"kind": kind, "part": part, "data": data, "numbers": numbers}


_ROWS = pa.schema(
    [("kind", pa.string()), ("part", pa.int64()), ("data", pa.binary()), ("numbers", pa.list_(pa.int64()))]
)
_ROW_SCHEMA = "kind string, part long, data binary, numbers array<long>"


@dataclass(frozen=True)
class Layout:
    folder: str
    bits: int  # of a context's hash for its tile, and of both hashes for their slice
    word_bits: int  # of a word's hash for its tile

    def tile(self, table: pa.Table) -> pa.Table:
        """Store a tile's bigrams; hand on its sums per context and per word."""
        tile = int(table["tile"][0].as_py())
        parts = [_unpacked(d, _PAIR_TYPES) for d in table["data"].to_pylist()]
        u = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        w = np.concatenate([p[2] for p in parts])
        c = np.concatenate([p[3] for p in parts])
        keys = _pair_keys(u, w)
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
        counts = np.add.reduceat(c[order].astype(np.int64), starts)
        u, w, keys = u[order[starts]], w[order[starts]], keys[order[starts]]
        _save(self.folder, f"pairs-{tile}", keys)
        # One byte per count; the few large ones stand in a list of their own.
        _save(self.folder, f"counts-{tile}", np.minimum(counts, 255).astype(np.uint8))
        large = np.flatnonzero(counts >= 255)
        _save(self.folder, f"large-{tile}", np.stack([large, counts[large]]).astype(np.int64).ravel())
        rows = [_row("pairs", 0, None, [*_of_counts(counts), len(counts)])]
        contexts = _summed(u, counts, counts == 1, counts == 2, counts >= 3)
        words = _summed(w, counts, np.ones(len(w), np.int64))
        for kind, found in (("contexts", contexts), ("words", words)):
            part = _top(found[0], self.bits)
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                columns = [found[0][lo:hi], *[f[lo:hi].astype(np.uint32) for f in found[1:]]]
                rows.append(_row(kind, int(part[lo]), _packed(*columns), []))
        return pa.Table.from_pylist(rows, _ROWS)

    def slice(self, table: pa.Table) -> pa.Table:
        """Store a slice of contexts or words; hand on its counts of counts."""
        kind, part = table["kind"][0].as_py(), int(table["part"][0].as_py())
        if kind == "pairs":
            return pa.Table.from_pylist(
                [_row(kind, 0, None, [sum(n) for n in zip(*table["numbers"].to_pylist(), strict=True)])], _ROWS
            )
        types = _CONTEXT_TYPES if kind == "contexts" else _WORD_TYPES
        parts = [_unpacked(d, types) for d in table["data"].to_pylist()]
        keys, *values = _summed(*[np.concatenate(c) for c in zip(*parts, strict=True)])
        _save(self.folder, f"{kind}-{part}", keys)
        _save(self.folder, f"{kind}-values-{part}", np.stack(values, axis=1).astype(np.uint32))
        numbers: list[int] = []
        if kind == "words":
            n, t = values
            numbers = [*_of_counts(t), len(keys), int(n.sum()), int(t.sum()), int((t >= 3).sum())]
        return pa.Table.from_pylist([_row(kind, part, None, numbers)], _ROWS)


def _discounts(n: list[int]) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [
        1 - 2 * y * n2 / n1 if n1 else 0.5,
        2 - 3 * y * n3 / n2 if n2 else 1.0,
        3 - 4 * y * n4 / n3 if n3 else 1.5,
    ]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


@dataclass(frozen=True)
class Model:
    layout: Layout
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    vocabulary: int
    tokens: int
    contexts_of_words: int
    rest: float  # share that word probabilities leave to the uniform one

    def _found(self, kind: str, keys: np.ndarray, part: np.ndarray, width: int) -> np.ndarray:
        """Value rows of sorted distinct keys; 0 where unknown."""
        out = np.zeros((len(keys), width), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            try:
                known = _load(self.layout.folder, f"{kind}-{part[lo]}", np.uint64)
                values = _load(self.layout.folder, f"{kind}-values-{part[lo]}", np.uint32)
            except FileNotFoundError:
                continue
            at = np.minimum(np.searchsorted(known, keys[lo:hi]), len(known) - 1)
            hit = known[at] == keys[lo:hi]
            out[lo:hi][hit] = values.reshape(-1, width)[at[hit]]
        return out

    def _pair_counts(self, u: np.ndarray, w: np.ndarray, keys: np.ndarray) -> np.ndarray:
        layout = self.layout
        tile = (_top(u, layout.bits) << layout.word_bits) | _top(w, layout.word_bits)
        order = np.lexsort((keys, tile))
        out = np.zeros(len(keys), np.int64)
        tile = tile[order]
        edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            try:
                known = _load(layout.folder, f"pairs-{tile[lo]}", np.uint64)
                counts = _load(layout.folder, f"counts-{tile[lo]}", np.uint8)
                large = _load(layout.folder, f"large-{tile[lo]}", np.int64).reshape(2, -1)
            except FileNotFoundError:
                continue
            mine = order[lo:hi]
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            found = np.where(known[at] == keys[mine], counts[at], 0).astype(np.int64)
            full = np.flatnonzero(found == 255)
            found[full] = large[1][np.searchsorted(large[0], at[full])]
            out[mine] = found
        return out

    def log_probabilities(self, before: np.ndarray, word: np.ndarray):
        """log10 P(w|u), the base's log10, and whether the word is known, per token."""
        keys, first, back = np.unique(_pair_keys(before, word), return_index=True, return_inverse=True)
        u, w = before[first], word[first]
        words, to_word = np.unique(w, return_inverse=True)
        contexts, to_context = np.unique(u, return_inverse=True)
        bits = self.layout.bits
        n, t = self._found("words", words, _top(words, bits), 2).T
        seen = self._found("contexts", contexts, _top(contexts, bits), 4)
        e, d = np.array([0, *self.word_discounts]), np.array([0, *self.pair_discounts])
        total = max(self.contexts_of_words, 1)
        alone = np.maximum(t - e[np.minimum(t, 3)], 0) / total + self.rest / (self.vocabulary + 1)
        base_log = np.log10((n + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))
        c = self._pair_counts(u, w, keys)
        often = seen[to_context, 0]
        open_share = seen[to_context, 1:] @ d[1:]
        size = np.maximum(often, 1)
        joint = np.maximum(c - d[np.minimum(c, 3)], 0) / size + open_share / size * alone[to_word]
        p = np.where(often > 0, joint, alone[to_word])
        return np.log10(p)[back], base_log[to_word][back], (n > 0)[to_word][back]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Model of all texts of `docs`, stored in the session's shared folder."""
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_bits = WORD_TILES.bit_length() - 1
    bits = max(word_bits, int(size // (TILE_BYTES * WORD_TILES)).bit_length())
    layout = Layout(base.scratch_path(spark, "kneser-ney"), bits, word_bits)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, word, held = [], [], 0
        for part in _parts(batches, "text"):
            u, w, _ = _bigrams(part["text"])
            before.append(u)
            word.append(w)
            held += len(u)
            if held >= FLUSH_TOKENS:
                yield from _tile_rows(before, word, bits, word_bits)
                before, word, held = [], [], 0
        if held:
            yield from _tile_rows(before, word, bits, word_bits)

    counted = rows.mapInArrow(tiles, "tile long, data binary").groupBy("tile")
    sums = counted.applyInArrow(lambda table: layout.tile(table), _ROW_SCHEMA).groupBy("kind", "part")
    numbers = sums.applyInArrow(lambda table: layout.slice(table), _ROW_SCHEMA).select("kind", "numbers").collect()
    pairs = [sum(n) for n in zip([0] * 5, *[r["numbers"] for r in numbers if r["kind"] == "pairs"], strict=True)]
    words = [sum(n) for n in zip([0] * 8, *[r["numbers"] for r in numbers if r["kind"] == "words"], strict=True)]
    e = _discounts(words[:4])
    rest = (e[0] * words[0] + e[1] * words[1] + e[2] * words[7]) / words[6] if words[6] else 1.0
    return Model(layout, tuple(_discounts(pairs[:4])), tuple(e), words[4], words[5], words[6], rest)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` with `n_tokens, n_known, train_tokens, base_score, score, perplexity`."""
    schema = docs.select(*keep).schema
    for name in ("n_tokens", "n_known", "train_tokens"):
        schema = schema.add(name, "long")
    for name in ("base_score", "score", "perplexity"):
        schema = schema.add(name, "double")
    inner = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(k).alias(i) for k, i in zip(keep, inner, strict=True)], F.col(text).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, "text"):
            before, word, at = _bigrams(part["text"])
            logs, base_logs, known = model.log_probabilities(before, word)
            begin, n = at[:-1], np.diff(at)
            total = np.add.reduceat(logs, begin)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part[i] for i in inner],
                    pa.array(n),
                    pa.array(np.add.reduceat(known.astype(np.int64), begin)),
                    pa.array(np.full(len(n), model.tokens)),
                    pa.array(np.add.reduceat(base_logs, begin)),
                    pa.array(total),
                    pa.array(10 ** np.minimum(-total / n, 300)),
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)

