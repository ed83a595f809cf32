"""Toxicity by gradient-boosted trees over dense features, isotonically calibrated.

The lexicon is learned: over all labelled training documents, the share of toxic and of
other documents that use a word is counted in Spark, and the `LEXICON` words of the
highest smoothed log-odds are kept (see `learn_lexicon`), with a short fixed list of general insults. The
features of a text are lexicon densities and hits, weighted hits, hits near the second
person, hits behind obfuscation (`st*pid`, `1diot`, `mooooron`), capitals, punctuation
and obfuscation rates. Label, language, source and id are no input.

The trees are fitted on at most `FIT_ROWS` labelled rows (those with the lowest hashes of
the id), a fourth of them kept back for the calibration. Everything else covers all rows.

Defined results: null and empty texts have all features 0 and get the score of those.
Without any labelled row of both classes, the score is the share of toxic labels (0 if
there is none). Repeated rows get equal scores. Repeated labels of a document count as
one, the highest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm import arrays, boosting
from recordloom.llm.ship import ship, stored

FIT_ROWS = 10_000
LEXICON = 96
LEAST_DOCUMENTS = 5
LEAST_LOG_ODDS = 2.0
# General insults, and words of the second person.
INSULTS = ["idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting", "trash", "clown"]
SECOND_PERSON = ["you", "your", "yours", "u", "du", "dich", "dir", "ihr", "tu", "te", "toi", "vous", "usted", "ti"]
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!*", "o.eastas..")
NEAR = 6
NAMES = [
    "hits", "hit_share", "weight", "weight_share", "distinct", "insults", "near_second", "second_share",
    "disguised", "disguised_share", "capital_share", "shout_share", "punctuation_share", "exclamations",
    "repeats", "odd_share", "log_words",
]
_EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "¡¿«»“”’…"
_OPENING = _EDGES.translate(str.maketrans("", "", "@$!*"))
_MARKED = re.compile(r"[^\W\d_][0-9@$*!]+[^\W\d_]|^[0-9@$][^\W\d_]{2}")
_REPEAT = re.compile(r"([^\W\d_])\1{2,}")
LONGEST_DISGUISE = 40


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text modulo `mod`; a row without id counts as remainder 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(1))


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: boosting.Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        return boosting.calibrated(self.knots, self.trees.margin(x))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(before[offsets])


def _byte_rates(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts per text: letters, capitals, capital triples, punctuation, `!`, letter
    triples of one kind, disguising signs between letters."""
    out = np.zeros((len(offsets) - 1, 7))
    if not len(buffer):
        return out
    low = buffer | 32
    letter = ((low >= 97) & (low <= 122)) | (buffer >= 0xC3)
    capital = (buffer >= 65) & (buffer <= 90)
    digit = (buffer >= 48) & (buffer <= 57)
    sign = (buffer > 32) & (buffer < 127) & ~letter & ~digit
    disguise = digit | np.isin(buffer, np.frombuffer(b"@$*!", np.uint8))
    inner = np.zeros((3, len(buffer)), bool)
    if len(buffer) > 2:
        inner[0, 2:] = capital[2:] & capital[1:-1] & capital[:-2]
        inner[1, 2:] = letter[2:] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
        inner[2, 2:] = letter[2:] & disguise[1:-1] & (letter[:-2] | (buffer[:-2] <= 32))
    found = [letter, capital, inner[0], sign, buffer == 33, inner[1], inner[2]]
    for k, flags in enumerate(found):
        out[:, k] = _per_text(flags, offsets)
    return out


def _masked(word: str, lexicon: dict[str, float]) -> bool:
    """`st.pid` for `stupid`: a masked letter stands for any one."""
    return "." in word and any(
        len(known) == len(word) and all(a in (".", b) for a, b in zip(word, known, strict=True))
        for known in lexicon
    )


def _disguised(tokens: list[str], lexicon: dict[str, float], drawn_out: bool) -> int:
    """Tokens that are a lexicon word behind signs, digits or drawn-out letters."""
    found = 0
    for token in tokens:
        plain = token.strip(_EDGES)
        if len(token) > LONGEST_DISGUISE or plain.isalpha() and not drawn_out:
            continue
        if not _MARKED.search(token) and not _REPEAT.search(token):
            continue
        plain = _REPEAT.sub(r"\1", token.rstrip(_EDGES).lstrip(_OPENING).translate(DISGUISE))
        found += plain in lexicon or _masked(plain, lexicon)
    return found


def _hashed(terms: list[str]) -> np.ndarray:
    """Hash of each term, as `arrays.words` gives it within a text."""
    column = pa.array(terms, pa.string())
    return arrays.words(*arrays.text_buffer(column), arrays.NO_LETTER)[0]


def _sorted(terms: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    hashes = _hashed(list(terms))
    order = np.argsort(hashes)
    return hashes[order], np.array(list(terms.values()))[order]


def _found(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of words that are among the sorted `known`, and where they stand there."""
    if not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    at = np.flatnonzero(known[place] == hashes)
    return at, place[at]


def features(column, lexicon: dict[str, float]) -> np.ndarray:
    """One row of `NAMES` per text of an Arrow column."""
    buffer, offsets = arrays.text_buffer(column)
    parts = []
    for lo in range(0, len(column), 512):
        hi = min(lo + 512, len(column))
        at = offsets[lo : hi + 1] - offsets[lo]
        parts.append(_features(buffer[offsets[lo] : offsets[hi]], at, lexicon))
    return np.concatenate([np.zeros((0, len(NAMES))), *parts])


def _features(buffer: np.ndarray, offsets: np.ndarray, lexicon: dict[str, float]) -> np.ndarray:
    size = np.maximum(np.diff(offsets), 1)
    letters, capitals, shouts, signs, calls, repeats, marks = _byte_rates(buffer, offsets).T
    hashes, at = arrays.words(buffer, offsets, arrays.NO_LETTER)
    count = np.diff(at)
    n = np.maximum(count, 1)
    known, weights = _sorted(lexicon)
    hit, which = _found(hashes, known)
    second, _ = _found(hashes, np.sort(_hashed(SECOND_PERSON)))
    insult, _ = _found(hashes, np.sort(_hashed(INSULTS)))
    texts = len(size)
    owner = np.searchsorted(at, hit, "right") - 1
    hits = np.bincount(owner, minlength=texts)
    weight = np.bincount(owner, weights[which], texts)
    distinct = np.bincount(np.unique(owner * len(known) + which) // max(len(known), 1), minlength=texts)
    insults = np.bincount(np.searchsorted(at, insult, "right") - 1, minlength=texts)
    seconds = np.bincount(np.searchsorted(at, second, "right") - 1, minlength=texts)
    # Second-person words within NEAR words of a hit, on either side and in the same text.
    low = np.searchsorted(second, np.maximum(hit - NEAR, at[owner]))
    high = np.searchsorted(second, np.minimum(hit + NEAR, at[owner + 1] - 1), "right")
    near = np.bincount(owner[high > low], minlength=texts)
    hidden = np.zeros(texts)
    for k in np.flatnonzero((repeats > 0) | (marks > 0)).tolist():
        text = buffer[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8")
        hidden[k] = _disguised(text.lower().split(), lexicon, repeats[k] > 0)
    return np.stack(
        [
            hits, hits / n, weight, weight / n, distinct, insults, near, seconds / n, hidden, hidden / n,
            capitals / np.maximum(letters, 1), shouts / n, signs / size, calls / size,
            repeats / n, marks / n, np.log1p(count),
        ],
        axis=1,
    )


_LETTERS = re.compile(rb"[a-z\x80-\xff]+")
COMMON_SHARE = 0.005


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Words of the highest log-odds between toxic and other documents (`text`, `toxic`).

    Only words in `COMMON_SHARE` of the toxic documents can be chosen. There are at most
    the mean number of distinct words over that share of them, so their list is small,
    and the other documents are counted for these words alone, within each batch first.
    """

    def toxic_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for text in batch["text"].to_pylist():
                found = set(_LETTERS.findall((text or "").lower().encode()))
                seen.update(w.decode("utf-8", "ignore") for w in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"]
            )

    totals = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    least = max(LEAST_DOCUMENTS, int(COMMON_SHARE * ones))
    common = (
        labelled.filter("toxic = 1").select("text").mapInArrow(toxic_words, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) & (F.col("word") != ""))
    )
    inside = {r["word"]: r["n"] for r in common.collect()}
    terms = sorted(inside)
    hashes = _hashed(terms)
    order = np.argsort(hashes)
    known = hashes[order]

    def other_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, at = arrays.words(*arrays.text_buffer(batch["text"]), arrays.NO_LETTER)
            hit, which = _found(found, known)
            owner = np.searchsorted(at, hit, "right") - 1
            which = np.unique(owner * max(len(known), 1) + which) % max(len(known), 1)
            n = np.bincount(which, minlength=len(known))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["at", "n"])

    counted = (
        labelled.filter("toxic = 0").select("text").mapInArrow(other_words, "at long, n long")
        .groupBy("at").agg(F.sum("n").alias("n"))
    )
    outside = {terms[order[r["at"]]]: r["n"] for r in counted.collect()}
    chosen = []
    for word, n in inside.items():
        odds = np.log((n + 0.5) / (ones + 1)) - np.log((outside.get(word, 0) + 0.5) / (zeros + 1))
        # Rare words need more evidence than common ones.
        evidence = odds * min(1.0, (n / max(1.0, 0.02 * ones)) ** 0.5)
        if evidence >= LEAST_LOG_ODDS:
            chosen.append((-evidence, word, float(odds)))
    learned = {word: odds for _, word, odds in sorted(chosen)[:LEXICON]}
    return {**{w: LEAST_LOG_ODDS for w in INSULTS}, **learned}


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Model from labelled rows (`doc_id`, `text`, `toxic` 0 or 1)."""
    ship(labelled.sparkSession)
    labelled = labelled.filter(F.col("toxic").isNotNull())
    lexicon = learn_lexicon(labelled)
    hashed = F.xxhash64("doc_id", F.lit("toxicity"))
    part = min(1.0, (fit_rows - 4 * fit_rows**0.5) / max(labelled.count(), 1))
    sample = labelled.select(
        "doc_id", "text", F.col("toxic").cast("int").alias("toxic"), hashed.alias("order")
    ).filter((hashed.cast("double") < (part - 0.5) * 2.0**64) | F.lit(part >= 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [row.tobytes() for row in features(batch["text"], lexicon)]
            yield pa.RecordBatch.from_arrays(
                [batch["order"], batch["toxic"], pa.array(x, pa.binary())], ["order", "toxic", "x"]
            )

    rows = sample.mapInArrow(run, "order long, toxic int, x binary").limit(fit_rows).toPandas()
    rows = rows.sort_values(["order", "x"], kind="stable")
    y = rows["toxic"].to_numpy(float)
    share = float(y.mean()) if len(y) else 0.0
    if len(y) < 8 or share in (0.0, 1.0):
        return Model(lexicon, None, (np.empty(0), np.empty(0)), share)
    x = np.frombuffer(b"".join(rows["x"])).reshape(len(rows), len(NAMES))
    held = (rows["order"].to_numpy() % 4) == 0
    if held.all() or not held.any() or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    trees = boosting.fit_trees(x[~held], y[~held])
    check = held if held.any() else ~held
    return Model(lexicon, trees, boosting.fit_isotonic(trees.margin(x[check]), y[check]), share)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` with `score` and `predicted` for every row."""
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")
    inner = [f"k{i}" for i in range(len(keep))]
    # The text moves once, also if it is kept.
    extra = [] if text in keep else [F.col(text).cast("string").alias("text")]
    rows = docs.select(*[F.col(k).alias(i) for k, i in zip(keep, inner, strict=True)], *extra)
    column = inner[keep.index(text)] if text in keep else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(features(batch[column], model.lexicon))
            yield pa.RecordBatch.from_arrays(
                [*[batch[i] for i in inner], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, mod: int = 5) -> DataFrame:
    """Training rows: documents with a label whose remainder is not 0."""
    marks = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = docs.filter(remainder(F.col("doc_id"), mod) != 0).select("doc_id", "text")
    # One plan at every size: labels grow with the documents and are not broadcast.
    rows = picked.join(marks.hint("merge"), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "toxic")
    # Several passes follow; the joined rows are stored once.
    return stored(rows, "labelled")
