"""N-gram Jaccard join by PartEnum signatures.

Two sets with a similarity of at least `percent` differ in few elements: at most
(100 - percent) / (100 + percent) of the sum of their sizes. Sizes are cut in bands so that linked
sets lie in the same or in neighbouring bands. A set gives signatures for its own band, and for
the next one if a linked set can be that large, so two linked sets meet in one band's scheme.

A scheme for a difference of k elements cuts the domain of element hashes in n1 parts of n2 cells
each. In a part that holds at most k2 of the differences, the sets agree on all but k2 cells; so
the sets share one of the signatures made of a part's n2 - k2 cells, for every choice of
cells. At least n1 - floor(k / (k2 + 1)) parts are such. A scheme has `spare` more of them than the one
needed, so that a set may leave out signatures of cells without elements, which
hold for many sets at once: it does so unless more than `spare` of its parts have one.

Of the schemes with few signatures, a band has the one whose signatures cover most elements. Sharing
a signature only makes a candidate, if the sets' parity bits do not rule a link out; the full sets
decide (`linking`). No pair of linked sets is missed, but for the hashing of elements to 64 bits.

Defined results: a null or empty text, or one of white space, has the empty set and is linked
with nothing. Repeated rows stay rows and share a component. A row without doc_id takes
part; the component of rows without any id has none. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import arrays, linking
from recordloom.llm.ship import ship, shuffles_dropped, stored

WIDTH = 4
PERCENT = 85
# Elements a signature should cover, in the smallest sets of its band, and the signatures it may take:
# so many, or so many an element.
COVERED = 4.5
FEW, PER_ELEMENT = 20, 0.6
# Chance that a set has more parts with empty signatures than it may leave out.
CROWDED = 1e-3
_CELL, _PART, _BAND = (np.uint64(c) for c in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


@cache
def band_starts(percent: int, size: int) -> tuple[int, ...]:
    """Smallest sizes of the bands, up to one that lies above `size`."""
    starts = [1]
    while starts[-1] <= size:
        starts.append(starts[-1] * 100 // percent + 1)
    return tuple(starts)


@dataclass(frozen=True)
class Scheme:
    """Cut of the domain for one band: n1 parts of n2 cells, signatures leaving out k2 cells."""

    n1: int
    n2: int
    k2: int
    spare: int

    @property
    def signatures(self) -> int:
        return self.n1 * math.comb(self.n2, self.k2)

    def chosen(self) -> np.ndarray:
        """cells x choices: 1 where the choice has the cell."""
        choices = list(itertools.combinations(range(self.n2), self.n2 - self.k2))
        table = np.zeros((self.n2, len(choices)), np.uint64)
        for j, cells in enumerate(choices):
            table[list(cells), j] = 1
        return table


def _above(mean: float, most: int) -> float:
    """Chance that a Poisson number with this mean is above `most`."""
    return 1 - sum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(most + 1)) if mean else 0.0


def _spare(k: int, n2: int, k2: int, smallest: int) -> Scheme | None:
    """The scheme of these cells with as many spare parts as empty signatures ask for; none if they grow with these."""
    least = k // (k2 + 1) + 1
    spare = 0
    while True:
        n1 = least + spare
        share = (n2 - k2) / (n1 * n2)
        empty = n1 * min(1.0, math.comb(n2, k2) * (1 - share) ** smallest)
        if _above(empty, spare) <= CROWDED:
            return Scheme(n1, n2, k2, spare)
        if spare > least + 8:
            return None
        spare += max(1, int(empty + 3 * math.sqrt(empty)) - spare)


@cache
def scheme_of(percent: int, band: int) -> Scheme:
    """Scheme for pairs of which the larger set lies in `band` and the smaller there or one below."""
    starts = band_starts(percent, 1)
    while len(starts) < band + 2:
        starts = band_starts(percent, starts[-1])
    largest = starts[band + 1] - 1
    smallest = max(1, -(-percent * starts[band] // 100))
    k = (100 - percent) * 2 * largest // (100 + percent)
    if k == 0:
        return Scheme(1, 1, 0, 0)
    found = [s for k2 in range(1, 5) for n2 in range(k2 + 1, k2 + 8) if (s := _spare(k, n2, k2, smallest))]
    # Far below 0.8, sets are too small for their differences; a scheme without spare parts still finds all.
    found = found or [Scheme(k // 2 + 1, 3, 1, 0)]
    most = max(FEW, PER_ELEMENT * smallest)
    few = [s for s in found if s.signatures <= most] or [min(found, key=lambda s: s.signatures)]

    def worth(s: Scheme) -> tuple[float, int]:
        return min(COVERED, smallest * (s.n2 - s.k2) / (s.n1 * s.n2)), -s.signatures

    return max(few, key=worth)


@cache
def _table(scheme: Scheme) -> np.ndarray:
    return scheme.chosen()


def _in_band(shingles: np.ndarray, sums: np.ndarray, percent: int, band: int) -> np.ndarray:
    scheme = scheme_of(percent, band)
    cells = scheme.n1 * scheme.n2
    # Sorted hashes lie in ascending cells, so a cell is a stretch of the set.
    cell = ((shingles >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
    edges = np.searchsorted(cell, np.arange(cells + 1, dtype=np.uint64))
    table = _table(scheme)
    with np.errstate(over="ignore"):
        held = (sums[edges[1:]] - sums[edges[:-1]]).reshape(scheme.n1, scheme.n2)
        held = arrays.mix(held + np.arange(1, scheme.n2 + 1, dtype=np.uint64) * _CELL)
        names = np.arange(1, scheme.n1 * table.shape[1] + 1, dtype=np.uint64).reshape(scheme.n1, -1)
        keys = arrays.mix((held @ table) ^ (names * _PART) ^ np.uint64(band + 1) * _BAND)
    filled = (np.diff(edges).reshape(scheme.n1, scheme.n2).astype(np.uint64) @ table) > 0
    crowded = np.count_nonzero(~filled.all(axis=1)) > scheme.spare
    return keys.ravel() if crowded else keys[filled]


def signatures(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a sorted set, of its own band and of the next if a linked set can lie there."""
    size = len(shingles)
    starts = band_starts(percent, 1 << max(4, size.bit_length()))
    band = int(np.searchsorted(starts, size, "right")) - 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(arrays.mix(shingles ^ _BAND), dtype=np.uint64)])
    out = [_in_band(shingles, sums, percent, band)]
    if size * 100 // percent >= starts[band + 1]:
        out.append(_in_band(shingles, sums, percent, band + 1))
    return np.concatenate(out)


def _described(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, ids, bits = [], [], []
        for shingles in arrays.shingle_sets(*arrays.text_buffer(batch["text"]), width):
            sizes.append(len(shingles))
            ids.append(linking.class_id(shingles) if len(shingles) else None)
            bits.append(linking.parity(shingles).tobytes() if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(bits, pa.binary())],
            ["doc_id", "n_shingles", "cid", "bits"],
        )


def _signed(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Signatures of every set, once a task."""
    seen: set[int] = set()
    for batch in batches:
        for shingles in arrays.shingle_sets(*arrays.text_buffer(batch["text"]), width):
            if not len(shingles) or (cid := linking.class_id(shingles)) in seen:
                continue
            seen.add(cid)
            keys = signatures(shingles, percent).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), cid))], ["key", "cid"])


def _labelled(docs: DataFrame, percent: int, width: int, limit: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' sets, their classes, and the component of each class that has links."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = stored(
        rows.mapInArrow(partial(_described, width=width), "doc_id long, n_shingles long, cid long, bits binary"),
        "described",
    )
    classes = (
        described.filter(F.col("cid").isNotNull()).groupBy("cid")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"))
    )
    keyed = rows.select("text").mapInArrow(partial(_signed, width=width, percent=percent), "key long, cid long")
    sketches = (
        described.filter(F.col("cid").isNotNull()).groupBy("cid")
        .agg(F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"))
    )
    pairs = linking.alike(keyed, sketches, percent, "join")
    labels = linking.linked_components(
        rows, pairs, classes, partial(signatures, percent=percent), width, percent, limit
    )
    return described, classes, labels


def jaccard_join(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, limit: int | None = None) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every document (`doc_id, text`).

    Two documents are linked if their sets of `width`-word shingles have a similarity of `percent`
    or more. `limit`: see `linking`.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"the threshold is a percentage above 0, up to 100; got {percent}")
    ship(docs.sparkSession)
    with shuffles_dropped(docs.sparkSession):
        described, classes, labels = _labelled(docs, percent, width, limit)
    placed = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "cid", "rep", F.coalesce("label", "cid").alias("label")
    )
    lowest = placed.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = placed.join(lowest, "label").select("cid", "component_id")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return described.join(named, "cid", "left").select("doc_id", "n_shingles", component.alias("component_id"))
