"""Language identification: family first, then one-versus-one linear machines within it.

Features are counts of hashed byte pairs and triples of the lower-cased letters (any
other run of characters is one blank), weighted by square root and scaled to length 1.
Which languages exist is learned from the labels; a fixed table names their families,
and a language it does not know forms a family of its own. One linear machine per pair
of families votes first; within the winner, one per pair of languages.

The machines are fitted on at most `FIT_ROWS` rows per language (lowest hashes of the
id); everything else covers all rows.

Defined results: `und` with score 0 for a null text or one without a letter, and for
every text if no row has a language. With one language only, that one with score 1.
Ties in votes go to the higher sum of margins, then to the smaller name. Repeated rows
get equal predictions; other columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm import arrays
from recordloom.llm.ship import ship

FIT_ROWS = 1000
DIMENSIONS = 2048
PASSES = 20
# Language codes by family.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la", "eu"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "uralic": ["fi", "et", "hu"],
    "baltic": ["lt", "lv"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "ur", "mr", "ne", "pa", "gu"],
    "semitic": ["ar", "he", "mt", "fa"],
    "celtic": ["ga", "cy", "gd", "br"],
    "east_asian": ["zh", "ja", "ko"],
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def _letters(buffer: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with one blank for each run of ASCII non-letters."""
    plain = _FOLD[buffer]
    blank = plain == 32
    keep = np.ones(len(plain), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return plain[keep]


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def vector(buffer: np.ndarray) -> np.ndarray:
    """Feature vector of one text's bytes; a long text is counted in stretches."""
    counts = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
    for lo in range(0, len(buffer), arrays.STRETCH):
        part = _letters(buffer[max(0, lo - 2) : lo + arrays.STRETCH]).astype(np.uint32)
        two = part[:-1] << np.uint32(8) | part[1:]
        three = two[:-1] << np.uint32(8) | part[2:]
        for grams in (two, three | np.uint32(1 << 24)):
            counts += np.bincount((grams * np.uint32(2654435761)) >> shift, minlength=DIMENSIONS)
    weighed = np.sqrt(counts)
    return (weighed / max(np.sqrt((weighed**2).sum()), 1e-9)).astype(np.float32)


def linear_machine(x: np.ndarray, y: np.ndarray, passes: int = PASSES, c: float = 10.0) -> np.ndarray:
    """Weights (last one: bias) of a linear support vector machine, by dual descent.

    `y` is 1 or -1. Rows are visited in an order drawn from a fixed seed, and the
    smaller class weighs more.
    """
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1).astype(np.float64)
    weight = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    limit, norms = c * weight, (x**2).sum(1)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    random = np.random.default_rng(7)
    for _ in range(passes):
        for i in random.permutation(len(x)):
            step = (1 - y[i] * (x[i] @ w)) / norms[i]
            now = min(max(alpha[i] + step, 0.0), limit[i])
            if now != alpha[i]:
                w += (now - alpha[i]) * y[i] * x[i]
                alpha[i] = now
    return w


@dataclass
class Model:
    families: list[str]
    languages: dict[str, list[str]]
    machines: dict[tuple[str, str], np.ndarray]

    def _vote(self, x: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner among `names`, and its confidence, per row."""
        votes = np.zeros((len(x), len(names)))
        margins = np.zeros((len(x), len(names)))
        for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
            w = self.machines[a, b]
            margin = x @ w[:-1] + w[-1]
            votes[:, i] += margin >= 0
            votes[:, j] += margin < 0
            margins[:, i] += margin
            margins[:, j] -= margin
        # Votes are whole numbers; the margins decide among equal ones.
        order = votes + 0.5 * np.tanh(margins / 100)
        best = order.argmax(1)
        strength = margins[np.arange(len(x)), best] / max(len(names) - 1, 1)
        sure = np.ones(len(x)) if len(names) < 2 else 1 / (1 + np.exp(-2 * np.clip(strength, -20, 20)))
        return best, sure

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, sure = self._vote(x, self.families)
        names = np.empty(len(x), object)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            if len(rows):
                best, within = self._vote(x[rows], self.languages[f])
                names[rows] = np.array(self.languages[f], object)[best]
                sure[rows] *= within
        return names.tolist(), sure


def _vectors(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buffer, at = arrays.text_buffer(batch["text"])
        rows = [vector(buffer[lo:hi]).tobytes() for lo, hi in itertools.pairwise(at.tolist())]
        yield pa.RecordBatch.from_arrays(
            [*[batch[k] for k in keep], pa.array(rows, pa.binary())], [*keep, "x"]
        )


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Model from rows (`doc_id`, `text`, `lang`)."""
    ship(rows.sparkSession)
    labelled = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    hashed = F.xxhash64("doc_id", F.lit("language"))
    # A threshold on the hash gives about twice the rows wanted without sorting texts.
    share = F.lit(2.0**64)
    wanted = F.lit(False)
    for lang, n in sizes.items():
        part = min(1.0, (2 * fit_rows + 50) / n)
        wanted = wanted | ((F.col("lang") == lang) & (hashed.cast("double") < share * (part - 0.5)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    sample = (
        labelled.filter(wanted)
        .select("doc_id", "lang", "text", hashed.alias("order"))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= fit_rows)
        .select("doc_id", "lang", "order", "text")
    )
    got = sample.mapInArrow(
        lambda batches: _vectors(batches, ["doc_id", "lang", "order"]),
        "doc_id long, lang string, order long, x binary",
    ).toPandas().sort_values(["order", "doc_id"], kind="stable")
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), DIMENSIONS)
    lang = got["lang"].to_numpy(object)
    languages: dict[str, list[str]] = {}
    for name in sorted(set(lang)):
        languages.setdefault(family_of(name), []).append(name)
    families = sorted(languages)
    family = np.array([family_of(name) for name in lang], object)
    machines = {}
    for names, marks in [(families, family), *[(languages[f], lang) for f in families]]:
        for a, b in itertools.combinations(names, 2):
            rows_ = np.flatnonzero((marks == a) | (marks == b))
            machines[a, b] = linear_machine(x[rows_], np.where(marks[rows_] == a, 1.0, -1.0))
    return Model(families, languages, machines)


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` with `lang_pred` and `score` for every row."""
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    inner = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(k).alias(i) for k, i in zip(keep, inner, strict=True)], F.col(text).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                texts = part["text"].to_pylist()
                lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
                names = np.full(len(texts), "und", object)
                sure = np.zeros(len(texts))
                chosen = np.flatnonzero(lettered)
                if len(chosen) and model.families:
                    buffer, at = arrays.text_buffer(part["text"])
                    x = np.stack([vector(buffer[at[i] : at[i + 1]]) for i in chosen])
                    found, sure[chosen] = model.predict(x)
                    names[chosen] = found
                yield pa.RecordBatch.from_arrays(
                    [*[part[i] for i in inner], pa.array(names.tolist(), pa.string()), pa.array(sure)],
                    [*keep, "lang_pred", "score"],
                )

    return rows.mapInArrow(run, schema)
