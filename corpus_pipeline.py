"""Documents to a clean, mixed, encoded training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last give the columns of documents.

1. toxicity: documents predicted toxic go (learned from the labels of `sf_dir`).
2. near_dedup: of each group of near duplicates (similarity of 0.80 or more) the smallest doc_id stays.
3. secrets: secrets in the texts are replaced by a mark; no document goes.
4. mixing: whole documents, as often as the mix of sources takes them; documents without
   words stay once.
5. bpe: ids of every document, and the digests of ids and of what they decode to.

Null and empty texts pass all stages. Additional columns are kept up to the last stage, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import bpe, mixing, near_dedup, secrets, toxicity
from recordloom.llm.queries import tokenizer_file
from recordloom.llm.ship import documents, set_aside, ship, stored

# Percent of shared 5-word shingles that makes two documents near duplicates.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(toxicity.labelled_rows(docs.select("doc_id", "text"), labels))
    inner = set_aside(docs, ["text"])
    scored = toxicity.score(docs.toDF(*inner.values()), model, list(inner.values()))
    return scored.filter("predicted = 0").select(*[F.col(i).alias(c) for c, i in inner.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_duplicates(docs, NEAR_PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.with_copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokens = bpe.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    known = docs.select("doc_id", "lang", "source", "text")
    return bpe.digests(known, tokens, ["doc_id", "lang", "source"], ids_too=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Boosted trees, min-hashes and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
