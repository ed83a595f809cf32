"""Mix sources to target weights: equal blocks, seats by highest quotients.

Each source is one stream of words: its documents in an order drawn from the seed. The
stream is cut in equal blocks of `block_words` words (the last one takes the rest too; a
source with words has one block at least). A source is due target / block size blocks;
the seats of the mix go one by one to the source with the highest quotient due / (2k + 1)
(Sainte-Lague), so every prefix of the seats is in proportion, and a shard of
`SHARD_BLOCKS` seats gets whole quotas (`shard_quotas`). The quotas decide: a source's seats
are the sum of its quotas, and each shard's quota takes the next blocks of a seeded order
of the source's blocks, which starts again when it is used up. A document is taken for the
words that its stretch of the stream shares with those blocks (`taken`), in the shards
that they fall to (`shard_words`).

Everything is DataFrame work. A source may hold any share of the rows: word offsets come
from sums per bucket of the seeded order, and the place of a block in its source's seeded order
follows from its number alone. Seats are never listed one by one to be counted: what a
source has at the end of a shard is known but for a few seats for each source, and only
these are ranked. Tables with one row per source are ordered in one task.

Defined results: a null or empty text, or one of white space, has size 0 and is taken 0
times. A null source is a source of its own, the last. Equal rows share their stretches
in some order, which gives the same rows. With no words at all every target is 0. Rows
without doc_id are ordered by their size. `block_words` must leave a source fewer than
2 ** 42 blocks. `keep` may name any columns, also those called as the ones made here,
which then stand twice in the result; `with_copies` keeps all columns whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.ship import set_aside, stored

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
MOST_TIMES = 3
BLOCK_WORDS = 16
SHARD_BLOCKS = 1 << 20
BUCKET_ROWS = 20_000
# Primes, one of which shares no factor with the number of blocks.
_PRIMES = 2_147_483_647, 2_147_483_629


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hex_number(text: Column) -> Column:
    """First 32 bits of a text's md5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(totals: DataFrame) -> DataFrame:
    """Target per source from `source, source_size`; other columns are kept.

    Weights go 1, 2, 3 by source. Sources are looked at in order of cap per weight: one
    is capped if what is left, shared by weight among it and those behind it, would reach
    its cap. The level of the first that is not holds for it and all behind it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double")
    weighed = totals.withColumn("weight", weight).withColumn(
        "cap", (F.col("source_size") * MOST_TIMES).cast("double")
    )
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = weighed.withColumn("level", left / F.sum("weight").over(onward))
    level = level.withColumn("at", F.row_number().over(Window.orderBy(*order)))
    open_ = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct("at", "level"))
    first = F.min(open_).over(Window.partitionBy())
    free = first.isNotNull() & (F.col("at") >= first["at"])
    target = F.when(free, first["level"] * F.col("weight")).otherwise(F.col("cap"))
    return level.withColumn("target", target).drop("weight", "cap", "level", "at")


def shard_quotas(due: DataFrame, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """Blocks of each source in each shard of the mix, from `key, source, due`.

    The mix has as many seats as the sources are due in sum, given by highest quotients
    due / (2k + 1), ties to the smaller source. Returns `shard, key, source, first, blocks`: a
    shard's quota is the source's seats from `first` on (from 0).

    Among the first n seats a source has between round(due * (n - h) / total) and
    round(due * (n + h) / total) of them, h being half the number of sources: seats rounded so
    add up to n at most, or at least, and are the first ones of their sum. Only the seats
    between the two (one more to each side, for rounding) are ranked, shard by shard.
    """
    everyone = Window.partitionBy()
    total, half = F.sum("due").over(everyone), F.count("*").over(everyone) / 2
    sources = due.filter(F.col("due") > 0).select(
        "key", "source", "due", total.alias("total"), half.alias("half"),
        F.round(total).cast("long").alias("seats"),
    )
    last = _whole(F.col("seats") - 1, F.lit(shard_blocks).cast("long"))
    ends = (
        sources.filter(F.col("seats") > 0)
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("end", F.least((F.col("shard") + 1) * shard_blocks, F.col("seats")))
    )

    def rounded(n: Column) -> Column:
        return F.floor(F.col("due") * n / F.col("total") + 0.5).cast("long")

    sure = F.greatest(rounded(F.col("end") - F.col("half")) - 1, F.lit(0).cast("long"))
    bounds = ends.withColumn("sure", sure).withColumn("most", rounded(F.col("end") + F.col("half")) + 1)
    of_shard = Window.partitionBy("shard")
    candidates = bounds.withColumn("open", F.col("end") - F.sum("sure").over(of_shard)).withColumn(
        "seat", F.explode(F.sequence("sure", "most"))
    )
    quotient = F.col("due") / (2 * F.col("seat") + 1)
    place = F.row_number().over(of_shard.orderBy(quotient.desc(), F.col("source").asc_nulls_last(), "seat"))
    upto = (
        candidates.withColumn("place", place)
        .groupBy("shard", "key", "source")
        .agg((F.max("sure") + F.count_if(F.col("place") <= F.col("open"))).alias("upto"))
    )
    before = upto.select((F.col("shard") + 1).alias("shard"), "key", F.col("upto").alias("first"))
    first = F.coalesce("first", F.lit(0).cast("long"))
    quotas = upto.join(before, ["shard", "key"], "left").select(
        "shard", "key", "source", first.alias("first"), (F.col("upto") - first).alias("blocks")
    )
    return quotas.filter(F.col("blocks") > 0)


def sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` with source, size and the seeded order of every row (`doc_id`,
    `text`, `source`)."""
    source = F.col("source").cast("string")
    size = words_of(F.col("text").cast("string"))
    name = F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        *keep,
        *([] if "source" in keep else [source.alias("source")]),
        # Null and any text get different keys.
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("v"), source)).alias("key"),
        size.alias("size"),
        F.md5(F.concat(name, F.lit(":"), size.cast("string")).cast("binary")).alias("order"),
    )


def plan(
    rows: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS
) -> tuple[DataFrame, DataFrame]:
    """Per source: size, target, number of blocks, seats; and the quotas these add up from."""
    totals = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    length = F.lit(block_words).cast("long")
    blocks = F.greatest(F.lit(1).cast("long"), _whole(F.col("source_size"), length))
    sources = stored(
        targets(totals)
        .withColumn("length", length)
        .withColumn("blocks", F.when(F.col("source_size") > 0, blocks).otherwise(0).cast("long")),
        "targets",
    )
    due = F.try_divide(F.col("target") * F.col("blocks"), "source_size")
    quotas = stored(
        shard_quotas(sources.select("key", "source", F.coalesce(due, F.lit(0.0)).alias("due")), shard_blocks),
        "quotas",
    )
    got = quotas.groupBy("key").agg(F.sum("blocks").alias("seats"))
    most = MOST_TIMES * F.col("blocks")
    full = sources.join(got, "key", "left").withColumn(
        "seats", F.least(F.coalesce("seats", F.lit(0)), most).cast("long")
    )
    return stored(full, "plan"), quotas


def _bucketed(rows: DataFrame) -> DataFrame:
    """The first hex digits of the order as `bucket`: about BUCKET_ROWS rows at most."""
    n, digits = rows.count(), 1
    while 16**digits * BUCKET_ROWS < n:
        digits += 1
    return rows.withColumn("bucket", F.substring("order", 1, digits))


def _streamed(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Every row with its source's plan and `begin`, the words ahead of it in its stream."""
    placed = _bucketed(rows)
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("key", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("key", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    )
    inner = (
        Window.partitionBy("key", "bucket")
        .orderBy("order", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
        .join(offsets, ["key", "bucket"])
        .withColumn("begin", F.col("ahead") + F.col("inner"))
        .join(planned.drop("source"), "key")
    )


def seeded_rank(block: Column, blocks: Column, shift: Column) -> Column:
    """Place of a block in the seeded order of `blocks` blocks: steps of a prime visit each once.

    The product with the prime is made of two parts, so that no step leaves 63 bits.
    """
    step = F.when(blocks % _PRIMES[0] != 0, F.lit(_PRIMES[0])).otherwise(F.lit(_PRIMES[1])).cast("long") % blocks
    high, low = F.shiftright(step, 20), step.bitwiseAND(F.lit((1 << 20) - 1).cast("long"))
    return (((block * high) % blocks * (1 << 20) + block * low) % blocks + shift) % blocks


def _rank(block: Column) -> Column:
    shift = _hex_number(F.concat(F.lit(SEED + "/"), F.coalesce("source", F.lit("")))) % F.col("blocks")
    return seeded_rank(block, F.col("blocks"), shift)


def _own_blocks() -> Column:
    """Blocks that a row with words shares words with."""

    def at(word: Column) -> Column:
        return F.least(_whole(word, F.col("length")), F.col("blocks") - 1)

    return F.sequence(at(F.col("begin")), at(F.col("begin") + F.col("size") - 1))


def _shared(block: Column) -> Column:
    """Words that a row shares with a block; the last block takes the rest of the stream too."""
    length = F.col("length")
    high = F.when(block == F.col("blocks") - 1, F.col("source_size")).otherwise((block + 1) * length)
    return F.least(F.col("begin") + F.col("size"), high) - F.greatest(F.col("begin"), block * length)


def taken(
    rows: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS
) -> DataFrame:
    """A stored `sized` table with source_size, target and taken.

    A block's copies follow from its place in the seeded order: all quotas of a source together take its whole seeded order so many times, and the first
    `seats mod blocks` blocks of it once more.
    """
    planned, _ = plan(rows, block_words, shard_blocks)
    seats, blocks = F.col("seats"), F.col("blocks")

    def words(block: Column) -> Column:
        again = F.when(_rank(block) < seats % blocks, 1).otherwise(0)
        return _shared(block) * (_whole(seats, blocks) + again)

    total = F.aggregate(_own_blocks(), F.lit(0).cast("long"), lambda acc, block: acc + words(block))
    amount = F.when(F.col("size") > 0, total).otherwise(F.lit(0).cast("long"))
    return _streamed(rows, planned).select(*rows.columns, "source_size", "target", amount.alias("taken"))


def shard_words(
    docs: DataFrame, keep: list[str], block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS
) -> DataFrame:
    """What each shard of the mix holds: columns `keep` with `shard, words`, a row per shard
    and document that it takes words of.

    A quota's seats meet the blocks by their places in the seeded order; both sides
    spread by source and place, so a source may hold any share of them. Equal rows of `keep` are
    summed.
    """
    rows, kept = _sized_aside(docs, keep)
    inner = [c for c in rows.columns if c.startswith("__column_")]
    planned, quotas = plan(rows, block_words, shard_blocks)
    seats = (
        quotas.withColumn("seat", F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1)))
        .join(planned.select("key", F.col("blocks").alias("all"), F.col("seats").alias("most")), "key")
        .filter(F.col("seat") < F.col("most"))
        .select("key", "shard", (F.col("seat") % F.col("all")).alias("rank"))
    )
    pieces = (
        _streamed(rows.filter(F.col("size") > 0), planned)
        .withColumn("block", F.explode(_own_blocks()))
        .select(*inner, "key", _shared(F.col("block")).alias("words"), _rank(F.col("block")).alias("rank"))
    )
    summed = pieces.join(seats, ["key", "rank"]).groupBy(*inner, "shard").agg(F.sum("words").alias("words"))
    return summed.select(*kept, "shard", "words")


def _whole(a: Column, b: Column) -> Column:
    """Whole quotient of non-negative numbers."""
    return ((a - a % b) / b).cast("long")


def mix(docs: DataFrame, keep: list[str], block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns `keep`, `size, source_size, target, taken` for every row of `docs`."""
    rows, kept = _sized_aside(docs, keep)
    return taken(rows, block_words).select(*kept, "size", "source_size", "target", "taken")


def _sized_aside(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, list[Column]]:
    """A stored `sized` table with `keep` under names of no use here, and these under their own."""
    inner = {c: f"__column_{i}" for i, c in enumerate(keep)}
    used = docs.select("doc_id", "text", "source", *[F.col(f"`{c}`").alias(i) for c, i in inner.items()])
    return stored(sized(used, list(inner.values())), "sized"), [F.col(i).alias(c) for c, i in inner.items()]


def with_copies(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Whole documents for a mix: `docs`, each row as often as the mix takes it.

    A share taken / size becomes whole copies by running sums from large to small
    documents, within a source and bucket of the seeded order, so that neighbours of
    about one size make up for each other. Rows without words stay once, and rows
    that share doc_id, source and size share the number of copies. Other columns are kept,
    whatever their names.
    """
    rows = taken(stored(sized(docs.select("doc_id", "text", "source"), ["doc_id"]), "sized"), block_words)
    rows = _bucketed(rows)
    share = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0)
    largest = Window.partitionBy("key", "bucket").orderBy(F.desc("size"), "order")
    run = F.sum(share).over(largest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    times = (F.floor(F.col("run") + 0.5) - F.floor(F.col("run") - F.col("share") + 0.5)).cast("int")
    times = F.greatest(F.lit(0), F.least(F.lit(MOST_TIMES), times))
    counted = (
        rows.withColumn("run", run)
        .withColumn("share", share)
        .select("order", "key", F.when(F.col("size") > 0, times).otherwise(1).alias("times"))
        .groupBy("order", "key")
        .agg(F.max("times").alias("__times"))
        .filter(F.col("__times") > 0)
    )
    inner = set_aside(docs, ["doc_id", "text", "source"])
    named = sized(docs.toDF(*inner.values()), list(inner.values())).select(
        *inner.values(), F.col("order").alias("__order"), F.col("key").alias("__key")
    )
    joined = named.join(
        counted.select(F.col("order").alias("__order"), F.col("key").alias("__key"), "__times"),
        ["__order", "__key"],
    )
    copied = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return copied.select(*[F.col(i).alias(c) for c, i in inner.items()])
