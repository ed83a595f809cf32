"""Registered queries of the operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import (
    bpe,
    fingerprint,
    kneser_ney,
    language_id,
    merkle,
    mixing,
    near_dedup,
    neighbours,
    partenum,
    secrets,
    toxicity,
    wavelet,
    whitening,
)
from recordloom.llm.ship import documents, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_neighbours")
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@query("op2_fingerprint")
def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_neighbours(documents(spark, sf_dir))


@query("op3_kneser_ney")
def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (toxicity.remainder(F.col("doc_id"), 10) == 0).alias("held_out")
    rows = documents(spark, sf_dir).select("doc_id", held_out, "text")
    model = kneser_ney.train(rows.filter(~F.col("held_out")))
    return kneser_ney.score(rows, model, ["doc_id", "held_out"])


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    held_out = (toxicity.remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    rows = docs.select("doc_id", held_out, "text")
    return toxicity.score(rows, model, ["doc_id", "held_out"])


# Regular expressions in RE2's form; group 1 is the part whose length counts.
_KINDS = [
    ("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
     r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", "(AKIA[A-Z0-9]+)", 20),
    ("hex", "([0-9a-f]+)", 24),
    ("github", "(gh[opsur]_[A-Za-z0-9]{36,})", 0),
    ("slack", "(xox[abprs]-[A-Za-z0-9-]{10,})", 0),
    ("google", "(AIza[0-9A-Za-z_-]{35})", 0),
    ("stripe", "([rs]k_live_[0-9A-Za-z]{16,})", 0),
    ("private_key", "(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 0),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 0),
]
_ONE_KIND = """
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, e - len(m) AS s, e FROM (
  SELECT doc_id, m, g, sum(len(p) + len(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
    SELECT doc_id, unnest(string_split_regex(t, '{regex}')[:-2]) AS p,
      unnest(regexp_extract_all(t, '{regex}', 0)) AS m, unnest(regexp_extract_all(t, '{regex}', 1)) AS g,
      generate_subscripts(regexp_extract_all(t, '{regex}', 0), 1) AS i FROM d))
WHERE len(g) >= {least}"""
SECRETS_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), spans AS ("
    + " UNION ALL ".join(
        _ONE_KIND.format(rank=i, kind=k, regex=r, least=n) for i, (k, r, n) in enumerate(_KINDS)
    )
    + """), named AS (SELECT *, kind || ':' || s::BIGINT || ':' || e::BIGINT AS name FROM spans)
SELECT doc_id, coalesce(count_if(rank = 0), 0)::BIGINT AS n_assign, coalesce(count_if(rank = 1), 0)::BIGINT AS n_access,
  coalesce(count_if(rank = 2), 0)::BIGINT AS n_hex,
  sha256(coalesce(string_agg(name, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(name, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN named USING (doc_id) GROUP BY doc_id"""
)


@query("op5_secrets", SECRETS_SQL)
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir), ["doc_id"])
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in secrets.BASE_RULES]
    base = secrets.listed(spans, lambda s: s["rank"] < len(secrets.BASE_RULES))
    digest = F.sha2(base.cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.listed(spans).alias("spans"))


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(documents(spark, sf_dir), tokens, ["doc_id"])


@query("op7_wavelet")
def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.shard_folder(spark)
    file = tokenizer_file("byte_bpe_50k.json")
    wavelet.write_shards(documents(spark, sf_dir), file, path, end_id=2, added_tokens=True)
    return wavelet.read_shards(spark, path)


# Words and distinct shingles by position; documents linked at 0.85; the smallest doc_id
# reachable. WIDTH and LAST stand for the words of a shingle, and one less.
_LINKED_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < WIDTH THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + LAST], ' ') FOR i IN range(1, len(ws) - LAST + 1)] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(m.y, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = d.doc_id
"""


def linked_sql(width: int) -> str:
    return _LINKED_SQL.replace("WIDTH", str(width)).replace("LAST", str(width - 1))


NEAR_SQL = linked_sql(5)
JOIN_SQL = f"SELECT doc_id, n_shingles, component_id FROM ({linked_sql(4)})"


@query("op8_near_dedup", NEAR_SQL)
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = toxicity.remainder(F.col("doc_id"), 4) == 2
    rows = docs.select("doc_id", held_out.alias("held_out"), "text", "lang")
    model = language_id.fit(rows.filter(~F.col("held_out")))
    return language_id.identify(rows, model, ["doc_id", "held_out"])


# The same mix: streams in md5 order, targets by water level, seats by quotient.
MIX_SQL = r"""
WITH r AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
o AS (SELECT *, md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR) AS ord FROM r),
t AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
    (3 * source_size)::DOUBLE AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM t),
v AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS pos FROM w),
f AS (SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM v WHERE cap > level * weight),
g AS (
  SELECT source, source_size, 16 AS l,
    CASE WHEN v.pos >= f.pos THEN f.level * weight ELSE cap END AS target FROM v, f),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN greatest(1, source_size // l) ELSE 0 END AS n FROM g),
due AS (
  SELECT source, coalesce(target * n / nullif(source_size, 0), 0) AS due FROM b),
q AS (
  SELECT source, seats, seat, due / (2 * seat + 1) AS quotient FROM (
    SELECT source, due, seats, unnest(range(0, (ceil(most + 1) + 1)::BIGINT)) AS seat FROM (
      SELECT source, due, round(sum(due) OVER ())::BIGINT AS seats,
        due * (sum(due) OVER () + count(*) OVER () / 2) / sum(due) OVER () AS most
      FROM due) WHERE due > 0)),
s AS (
  SELECT source, count(*) AS seats FROM (
    SELECT *, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST, seat) AS place FROM q)
  WHERE place <= seats GROUP BY source),
p AS (
  SELECT b.*, least(coalesce(s.seats, 0), 3 * n) AS seats,
    ('0x' || substr(md5('mix-1/' || coalesce(b.source, '')), 1, 8))::BIGINT AS shift
  FROM b LEFT JOIN s ON b.source IS NOT DISTINCT FROM s.source),
m AS (
  SELECT o.doc_id, o.size, p.*, coalesce(sum(size) OVER (PARTITION BY o.source ORDER BY ord, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo
  FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source),
k AS (
  SELECT *, unnest(range(least(lo // l, n - 1), least((lo + size - 1) // l, n - 1) + 1)) AS k
  FROM m WHERE size > 0),
words AS (
  SELECT doc_id, sum(
    (least(lo + size, CASE WHEN k = n - 1 THEN source_size ELSE (k + 1) * l END) - greatest(lo, k * l))
    * (seats // n + CASE WHEN (k * (2147483647 % n) + shift % n) % n < seats % n THEN 1 ELSE 0 END)
  ) AS taken FROM k GROUP BY doc_id)
SELECT m.doc_id, m.size, m.source_size, m.target, coalesce(words.taken, 0)::BIGINT AS taken
FROM m LEFT JOIN words USING (doc_id)
"""


@query("op9_mixing", MIX_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), ["doc_id"])


# Leaves, both trees level by level, and every leaf folded with its siblings. crc32 bit by
# bit: a byte is mixed in, then eight steps (-1) follow.
MERKLE_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang,
    [coalesce(strlen(v) || ':' || v, '-') FOR v IN [doc_id::VARCHAR, source, lang, n_chars::VARCHAR]] AS head,
    text, list_reduce(flatten([[4294967295], flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1]
      FOR c IN string_split(doc_id::VARCHAR, '')])]),
      lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, sha256(array_to_string(head, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(array_to_string(head, '') || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered,
    coalesce(xor(crc, 4294967295) % 3 = 0, false) AS wrong FROM f),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM l),
tree(lang, level, pos, n, digest) AS (
  SELECT lang, 0, pos, n, leaf FROM p
  UNION ALL
  SELECT lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY lang, level, pos // 8, n),
s AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n, level FROM tree WHERE n = 1),
top(level, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM s
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY level, pos // 8, n),
steps AS (
  SELECT p.doc_id, p.leaf, t.level,
    coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < p.pos // (8 ** t.level)::BIGINT), '') AS a,
    coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > p.pos // (8 ** t.level)::BIGINT), '') AS b
  FROM p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.n > 1
    AND t.pos // 8 = (p.pos // (8 ** t.level)::BIGINT) // 8
  GROUP BY p.doc_id, p.leaf, p.pos, t.level
  UNION ALL
  SELECT p.doc_id, p.leaf, s.level + t.level,
    coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < s.pos // (8 ** t.level)::BIGINT), ''),
    coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > s.pos // (8 ** t.level)::BIGINT), '')
  FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang
    JOIN top t ON t.n > 1 AND t.pos // 8 = (s.pos // (8 ** t.level)::BIGINT) // 8
  GROUP BY p.doc_id, p.leaf, s.pos, s.level, t.level),
fold(doc_id, leaf, level, digest) AS (
  SELECT doc_id, leaf, 0, CASE WHEN wrong THEN lowered ELSE leaf END FROM p
  UNION ALL
  SELECT fold.doc_id, fold.leaf, fold.level + 1, sha256(a || digest || b)
  FROM fold JOIN steps USING (doc_id, leaf, level)),
proofs AS (
  SELECT doc_id, leaf, sha256(string_agg(a || b, '' ORDER BY level)) AS proof FROM steps GROUP BY doc_id, leaf),
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, root.root, coalesce(proofs.proof, sha256('')) AS proof_sha256,
  last.digest AS folded_root, last.digest = root.root AS verified
FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang CROSS JOIN root
LEFT JOIN proofs USING (doc_id, leaf)
JOIN (SELECT doc_id, leaf, arg_max(digest, level) AS digest FROM fold GROUP BY doc_id, leaf) last USING (doc_id, leaf)
"""


@query("op11_merkle", MERKLE_SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir), toxicity.remainder(F.col("doc_id"), 3) == 0)


@query("op12_partenum", JOIN_SQL)
def op12_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_join(documents(spark, sf_dir))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=8)
    return found.withColumn("deviation", F.col("deviation").cast("long"))
