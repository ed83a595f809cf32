"""Document fingerprints: one-permutation MinHash with optimal densification, packed.

The 5-word shingles of a text (lower-cased words between white space; a shorter text is
one shingle) are hashed once. The upper 8 bits of a hash name one of 256 bins, and a bin
keeps its smallest hash. An empty bin takes the value of the first filled bin on a probe
sequence that depends on the bin alone, so equal sets borrow alike. Of every bin the
lowest 8 bits are stored. Two bins agree by chance in one of 256 cases, and the likeness
is corrected for that: (agreeing - 1/256) / (1 - 1/256), at least 0.

Everything is a Column expression on one row; nothing is shuffled for a fingerprint.

Defined results: a null or empty text, or one of white space, has the fingerprint '',
which is fully like itself and not at all like any other. Repeated rows have equal
fingerprints. `with_next` orders rows by doc_id, then by a hash of the text and the
text, rows without doc_id first; the last one is followed by the first one (a single row by itself).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators import ranges

BINS = 256
SHINGLE = 5
# Probes by arithmetic alone, before an order of all bins is made.
PROBES = 32
RANGE_ROWS = 4096
_PRIME = 65_521
_VALUE_BITS = 56
_LOW = (1 << _VALUE_BITS) - 1
# Bins in the order of signed hashes, each with the largest value it can hold.
_SENTINELS = [(b << _VALUE_BITS) | _LOW for b in range(-BINS // 2, BINS // 2)]
_BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it in `body` any number of times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of a text's shingles, repeats included."""
    trimmed = F.trim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_BLANKS))

    def hashes(words: Column) -> Column:
        def shingle(i: Column) -> Column:
            return F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])

        places = F.sequence(F.lit(0), F.size(words) - SHINGLE)
        return (
            F.when(F.get(words, F.lit(0)) == "", F.array().cast("array<bigint>"))
            .when(F.size(words) < SHINGLE, F.array(F.xxhash64(words)))
            .otherwise(F.transform(places, shingle))
        )

    return let(F.split(trimmed, r"[\x20\x09-\x0D]+"), hashes)


def _probe(bin_: Column, attempt: int) -> Column:
    """Bin tried at an attempt: a universal hash of the bin, another one each time."""
    factor = (40_503 * attempt + 30_011) % (_PRIME - 1) + 1
    shift = (24_593 * attempt * attempt + 7_919) % _PRIME
    return ((bin_ * factor + shift) % _PRIME % BINS).cast("int")


def bin_values(text: Column) -> Column:
    """The low bits of all bins of a text (`array<int>`), empty without shingles."""
    sentinels = F.array(*[F.lit(s) for s in _SENTINELS])

    def lowest(hashes: Column) -> Column:
        # In sorted order a bin's hashes stand together, its sentinel last; the first one
        # of each bin is its minimum, or the sentinel if the bin is empty.
        def first_of_bin(x: Column, i: Column) -> Column:
            before = F.get(hashes, i - 1)
            return (i == 0) | (F.shiftright(before, _VALUE_BITS) != F.shiftright(x, _VALUE_BITS))

        kept = F.filter(hashes, first_of_bin)
        return F.transform(
            kept,
            lambda x: F.when(
                x.bitwiseAND(F.lit(_LOW)) != _LOW, x.bitwiseAND(F.lit(BINS - 1)).cast("int")
            ),
        )

    def densified(values: Column) -> Column:
        def filled(x: Column, i: Column) -> Column:
            tries = [F.get(values, _probe(i, j)) for j in range(PROBES)]
            return F.coalesce(x, *tries, onward(i))

        # After that many empty bins, the bin goes on through an order of all bins of its own: the
        # filled bin that comes first there is the one with the smallest hash of both.
        places = F.sequence(F.lit(0), F.lit(BINS - 1))

        def onward(i: Column) -> Column:
            order = F.transform(
                F.filter(places, lambda b: F.get(values, b).isNotNull()),
                lambda b: F.struct(F.xxhash64(i, b).alias("h"), F.get(values, b).alias("v")),
            )
            return F.array_min(order)["v"]

        return F.transform(values, filled)

    def binned(hashes: Column) -> Column:
        ordered = F.sort_array(F.concat(hashes, sentinels))
        dense = let(let(ordered, lowest), densified)
        return F.when(F.size(hashes) == 0, F.array().cast("array<int>")).otherwise(dense)

    return let(shingle_hashes(text), binned)


def packed(values: Column) -> Column:
    """Hexadecimal text of the bins, two digits each."""
    digits = F.array(*[F.lit(f"{v:02x}") for v in range(BINS)])
    return F.array_join(F.transform(values, lambda v: F.get(digits, v)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles of two texts, from their bins."""
    places = F.sequence(F.lit(0), F.lit(BINS - 1))
    agreeing = F.size(F.filter(places, lambda i: F.get(a, i) == F.get(b, i))) / BINS
    chance = 1 / BINS
    estimate = F.greatest(F.lit(0.0), (agreeing - chance) / (1 - chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(estimate)
    )


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, Window]:
    """Rows (`doc_id`, `text`) in ranges of neighbouring ids, and the window over them.

    Rows of one id, or without id, are ordered by a hash of the text, so that they are cut in
    ranges too. A range ends with a copy of the next range's first row (`ghost`), the last one
    with the table's first, so that `lead` over the window sees every successor.
    """
    order = ["doc_id", "__tie"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("__tie"), "text")
    limits = ranges.range_limits(keyed, order, range_rows)
    rows = keyed.withColumn("bucket", ranges.range_of(keyed, order, limits))
    # One narrow row for each range, at most `ranges.MOST_RANGES`.
    heads = rows.groupBy("bucket").agg(F.min(F.struct(*order)).alias("head")).select("bucket", "head.*")
    before, every = Window.orderBy("bucket"), Window.partitionBy(F.lit(0))
    target = F.coalesce(F.lag("bucket").over(before), F.max("bucket").over(every)).alias("__target")
    heads = heads.select(target, F.col("doc_id").alias("__id"), F.col("__tie").alias("__hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__tie") == F.col("__hash"))
    met = rows.join(F.broadcast(heads), same)
    ghosts = met.groupBy(F.col("__target").alias("bucket"), *order).agg(F.min("text").alias("text"))
    both = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True)))
    window = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "__tie", "text")
    return both, window


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Every document with its edited text, both fingerprints and their likeness.

    The edited text has its last quarter of code points replaced by the first as many
    of the next document.
    """
    plain = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows, window = with_next(plain)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    following = F.lead("text").over(window)
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n") - F.col("q")),
        F.substring(F.col("following"), F.lit(1), F.col("q")),
    )
    both = (
        rows.withColumn("following", following)
        .withColumns({"n": n, "q": quarter})
        .withColumn("edited", F.when(~F.col("ghost"), edited))
    )
    marked = both.select(
        "bucket", "ghost", "doc_id", "__tie", "text", F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        bin_values(F.col("text")).alias("bins"),
        F.when(~F.col("ghost"), bin_values(F.col("edited"))).alias("edited_bins"),
    )
    found = marked.withColumn("next_bins", F.lead("bins").over(window)).filter(~F.col("ghost"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
