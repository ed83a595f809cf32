"""Words, shingles and pretokens of whole Arrow text columns as numpy arrays.

A column's texts lie one after the other in one buffer, so a batch costs a few
array operations however many rows it has. Long buffers are taken in stretches cut
at places where no word can cross, so working memory does not follow the text length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH = 1 << 21
SHINGLE = 5
U64 = np.uint64
# White space of the word contract: 0x20 and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Value of a byte in a word's hash: A-Z as a-z, white space nothing.
_VALUE = np.arange(1, 257, dtype=U64)
_VALUE[65:91] += U64(32)
_VALUE[_SPACE] = 0
_BASE = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (bijective)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_POWERS = np.ones(1, U64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS), 1024), _BASE, U64)
        grown[0] = 1
        with np.errstate(over="ignore"):
            _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Polynomial hash of every token; values outside tokens are 0."""
    if not len(starts):
        return np.empty(0, U64)
    base = np.zeros(len(values), np.int64)
    base[starts] = starts
    at = np.arange(len(values)) - np.maximum.accumulate(base)
    with np.errstate(over="ignore"):
        weighed = values * _powers(int(at.max()) + 1)[at]
        sums = np.add.reduceat(weighed, starts)
        return mix(sums ^ (lengths.astype(U64) * U64(0xD6E8FEB86659FD93)))


def _stretches(n: int, offsets: np.ndarray, safe) -> Iterator[tuple[int, int]]:
    """Cut 0..n at text ends, or within a long text where `safe(lo, hi)` finds a place."""
    lo = 0
    while lo < n:
        hi = min(lo + STRETCH, n)
        if hi < n:
            end = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
            if end > lo:
                hi = end
            else:
                limit = int(offsets[np.searchsorted(offsets, lo, "right")])
                hi = safe(lo, hi, limit)
        yield lo, hi
        lo = hi


# Everything but ASCII letters and bytes of other scripts parts letter words.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def words(
    buffer: np.ndarray, offsets: np.ndarray, parting: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and n + 1 offsets of the texts into the words.

    Bytes flagged in `parting` stand between words; A-Z counts as a-z.
    """
    values = np.where(parting, U64(0), _VALUE)

    def safe(lo: int, hi: int, limit: int) -> int:
        while hi < limit and not parting[buffer[hi - 1]]:
            hi += 1
        return hi

    found, begins = [], []
    for lo, hi in _stretches(len(buffer), offsets, safe):
        part = buffer[lo:hi]
        inside = ~parting[part]
        fresh = np.zeros(hi - lo + 1, bool)
        inner = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")]
        fresh[inner - lo] = True
        fresh[[0, -1]] = True
        fresh[1:-1] |= ~inside[:-1]
        starts = np.flatnonzero(inside & fresh[:-1])
        stop = np.zeros(hi - lo, bool)
        stop[:-1] = ~inside[1:]
        stop |= fresh[1:]
        ends = np.flatnonzero(inside & stop) + 1
        found.append(_hashes(values[part], starts, ends - starts))
        begins.append(starts + lo)
    hashes = np.concatenate(found) if found else np.empty(0, U64)
    begin = np.concatenate(begins) if begins else np.empty(0, np.int64)
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(buffer: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of `width` words of every text, as 64-bit hashes.

    With fewer words the whole sequence is one; without words the set is empty.
    """
    hashes, at = words(buffer, offsets)
    rolled = np.empty(0, U64)
    with np.errstate(over="ignore"):
        if len(hashes) >= width:
            rolled = hashes[: len(hashes) - width + 1].copy()
            for k in range(1, width):
                rolled *= _BASE
                rolled += hashes[k : len(hashes) - width + 1 + k]
            rolled = mix(rolled)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo >= width:
                yield np.unique(rolled[lo : hi - width + 1])
            elif hi > lo:
                total = U64(hi - lo)
                for value in hashes[lo:hi]:
                    total = total * _BASE + value
                yield mix(np.array([total], U64))
            else:
                yield np.empty(0, U64)


# --- pretokens ----------------------------------------------------------------

LETTER, NUMBER, SPACE, OTHER = range(4)
# Code points with the White_Space property.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]


@cache
def char_classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    first = {"L": LETTER, "N": NUMBER}
    category = unicodedata.category
    classes = np.fromiter(
        (first.get(category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
    )
    classes[WHITE_SPACE] = SPACE
    return classes


def code_points(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text buffer and the texts' offsets into them."""
    if not len(buffer):
        return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(buffer.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80, dtype=np.int64)])
    return points, before[offsets]


def _pretoken_starts(points: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where the matches of the byte-level pattern begin.

    Runs of letters, numbers or other signs, each with one blank before it; of a run
    of white space the last character stands apart if a text goes on after it; and the
    endings 's 't 'm 'd 're 've 'll where no other sign and no blank stands before them.
    """
    n = len(points)
    kind = char_classes()[points]
    before = np.full(n, 255, np.uint8)
    before[1:] = kind[:-1]
    before[fresh] = 255
    goes_on = np.zeros(n, bool)
    goes_on[:-1] = ~fresh[1:]
    after = np.full(n, 255, np.uint8)
    after[:-1] = kind[1:]
    after[~goes_on] = 255
    blank_before = np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 32
    blank_before[fresh] = False
    space = kind == SPACE
    start = np.where(
        space,
        (before != SPACE) | ((after != SPACE) & goes_on),
        (before != kind) & ~blank_before,
    )
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        padded = np.concatenate([points, [0, 0, 0]])
        one, two = padded[quote + 1], padded[quote + 2]
        edge = np.concatenate([fresh, [True, True, True]])
        in_one = ~edge[quote + 1]
        in_two = in_one & ~edge[quote + 2]
        short = in_one & np.isin(one, [ord(c) for c in "stmd"])
        long = in_two & (
            ((one == ord("r")) & (two == ord("e")))
            | ((one == ord("v")) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l")))
        )
        start[quote[short | long] + 1] = False
        cut = np.concatenate([quote[short] + 2, quote[long] + 3])
        cut = cut[cut < n]
        # White space after an ending keeps its own rule: it begins a run there.
        start[cut] = True
    return start


def pretokens(
    points: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and hash of every pretoken; the texts' offsets into them."""
    classes = char_classes()

    def safe(lo: int, hi: int, limit: int) -> int:
        # Before a blank between two letters a match always ends.
        while hi < limit and not (
            points[hi] == 32
            and classes[points[hi - 1]] == LETTER
            and hi + 1 < limit
            and classes[points[hi + 1]] == LETTER
        ):
            hi += 1
        return hi

    begins, lengths, found = [], [], []
    for lo, hi in _stretches(len(points), offsets, safe):
        part = points[lo:hi]
        fresh = np.zeros(hi - lo, bool)
        inner = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)]
        fresh[inner - lo] = True
        fresh[0] = True
        starts = np.flatnonzero(_pretoken_starts(part, fresh))
        length = np.diff(np.append(starts, hi - lo))
        found.append(_hashes(part.astype(U64) + U64(1), starts, length))
        begins.append(starts + lo)
        lengths.append(length)
    if not begins:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, U64), np.zeros(len(offsets), np.int64)
    begin = np.concatenate(begins)
    return begin, np.concatenate(lengths), np.concatenate(found), np.searchsorted(begin, offsets)


class PieceTable:
    """Ids of the distinct pieces met so far, by piece hash; bounded in size."""

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, U64)
        self.at = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        return place, known

    def encode(self, points, begin, length, hashes, encoder) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and the number of ids of each piece."""
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self.clear()
        _, known = self._place(keys)
        fresh = first[~known]
        if len(fresh):
            pieces = [
                points[b : b + n].tobytes().decode("utf-32-le")
                for b, n in zip(begin[fresh].tolist(), length[fresh].tolist(), strict=True)
            ]
            ids, sizes = encoder(pieces)
            at = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
            joined = np.concatenate([self.keys, keys[~known]])
            order = np.argsort(joined, kind="stable")
            self.keys = joined[order]
            self.at = np.concatenate([self.at, at])[order]
            self.sizes = np.concatenate([self.sizes, sizes])[order]
        place, _ = self._place(keys)
        sizes = self.sizes[place][back]
        total = np.cumsum(sizes) - sizes
        where = np.repeat(self.at[place][back] - total, sizes) + np.arange(int(sizes.sum()))
        return self.ids[where], sizes
