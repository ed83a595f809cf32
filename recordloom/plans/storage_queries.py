"""Readers, writers and streams: the given tables written to the shared scratch
folder in the form an operator reads, and read back through it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import variants as vx
from recordloom.operators import cleaner, extract, ledger, quality
from recordloom.plans import adapters as ad
from recordloom.plans import check_sql as q
from recordloom.plans.record_queries import cleaned_sql, removed_sql
from recordloom.plans.registry import query, table
from recordloom.session import scratch_path
from recordloom.sources import readers, writers
from recordloom.streaming import ingest

# --- JSON ---------------------------------------------------------------------


@query(
    "ndjson_scan",
    f"""SELECT CASE WHEN doc_id % 23 = 0 THEN NULL ELSE doc_id END AS doc_id,
               CASE WHEN doc_id % 23 <> 0 THEN uri END AS uri,
               CASE WHEN doc_id % 23 = 0 THEN 1 ELSE 0 END AS malformed
        FROM ({ad.LIST_ITEMS_SQL})""",
)
def ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.to_json(F.struct("doc_id", "uri"))
    damaged = F.when(F.col("doc_id") % 23 == 0, F.concat(line, F.lit(" x"))).otherwise(
        F.concat(F.lit("\n  "), line)
    )
    path = scratch_path(spark, "ndjson")
    ad.list_items(spark, sf_dir).select(damaged).write.text(path)
    item = F.col("item")
    return readers.read_ndjson(spark, path).select(
        F.try_variant_get(item, "$.doc_id", "bigint").alias("doc_id"),
        vx.text_at(item, "$.uri").alias("uri"),
        item.isNull().cast("int").alias("malformed"),
    )


@query(
    "json_document_scan",
    "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
)
def json_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per record, as the operator expects its input."""
    path = scratch_path(spark, "documents")
    writers.write_documents(table(spark, sf_dir, "pages"), path)
    docs = vx.with_json(readers.read_documents(spark, path), "body", "doc")
    doc = F.col("doc")
    return docs.select(
        F.try_variant_get(doc, "$.page_id", "bigint").alias("page_id"),
        vx.text_at(doc, "$.url").alias("url"),
        F.md5(vx.text_at(doc, "$.html")).alias("html_md5"),
    )


@query(
    "ndjson_append",
    f"""SELECT country, level, count(*) AS items, count(DISTINCT doc_id) AS distinct_items,
               2 AS runs FROM ({ad.LIST_ITEMS_SQL}) GROUP BY country, level""",
)
def ndjson_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append")
    items = ad.list_items(spark, sf_dir)
    with_uri, without = quality.split_by(items, quality.key_reason(F.col("uri")))
    writers.write_ndjson(with_uri, path, ["country", "level"])
    writers.write_ndjson(without.drop("reason"), path, ["country", "level"])
    stored = spark.read.schema("doc_id bigint, country string, level int").json(path)
    return stored.groupBy("country", "level").agg(
        F.count("*").alias("items"),
        F.count_distinct("doc_id").alias("distinct_items"),
        F.lit(2).alias("runs"),
    )


_LANG_LINES = f"""
  SELECT upper(lang) AS country, CAST(doc_id % 8 + 1 AS INTEGER) AS level, doc_id AS file, i AS line_no,
         trim(x) AS line
  FROM ({q.LINES}) WHERE trim(x) <> ''"""


def _lang_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.posexplode(ad.lines_of(F.col("text"))).alias("line_no", "line")
    return table(spark, sf_dir, "documents").select(
        F.upper("lang").alias("country"),
        (F.col("doc_id") % 8 + 1).cast("int").alias("level"),
        F.col("doc_id").alias("file"),
        lines,
    )


@query(
    "country_merge",
    f"""SELECT country, row_number() OVER (PARTITION BY country ORDER BY level, file, line_no) AS nr, line
        FROM ({_LANG_LINES})""",
)
def country_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged country files, read back with the position of every line."""
    path = scratch_path(spark, "countries")
    writers.write_country_files(_lang_lines(spark, sf_dir), path)
    lines = readers.numbered_lines(spark, path, recursiveFileLookup="true")
    country = F.regexp_extract("file", "country=([A-Z]+)", 1)
    placed = lines.select(country.alias("country"), "file", "line_no", "line")
    return ledger.running_number(placed, ["file", "line_no"], ["country"], "nr").select(
        "country", "nr", "line"
    )


@query(
    "file_line_numbers",
    f"SELECT count(*) AS lines, TRUE AS gapless FROM ({_LANG_LINES})",
)
def file_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    _lang_lines(spark, sf_dir).select("line").write.text(path)
    per_file = readers.numbered_lines(spark, path).groupBy("file").agg(
        F.count("*").alias("n"), F.max("line_no").alias("last"), F.sum("line_no").alias("total")
    )
    gapless = (F.col("n") == F.col("last")) & (
        F.col("total") == F.expr("cast(n as decimal(38, 0)) * (n + 1) / 2")
    )
    return per_file.agg(
        F.sum("n").cast("bigint").alias("lines"), F.bool_and(gapless).alias("gapless")
    )


@query(
    "index_scan",
    f"SELECT level, uri, doc_id // 800 AS part FROM ({ad.LIST_ITEMS_SQL})",
)
def index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files of at most a hundred uris; the part stands in the folder name."""
    path = scratch_path(spark, "index")
    items = ad.list_items(spark, sf_dir)
    part = F.expr("doc_id div 800")
    arrays = items.groupBy("level", part.alias("part")).agg(
        F.to_json(F.collect_list(F.coalesce("uri", F.lit("")))).alias("value")
    )
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("level", "part").text(path)
    uris, _ = readers.read_index(spark, path)
    return uris.select(
        "level",
        F.nullif("uri", F.lit("")).alias("uri"),
        F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint").alias("part"),
    )


@query(
    "grid_files",
    f"""SELECT upper(substr(lang || 'x', 1, 3)) AS country, level, count(*) AS items
        FROM (SELECT lang, CAST(doc_id % 8 + 1 AS INTEGER) AS level FROM documents) GROUP BY ALL""",
)
def grid_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(
        F.lit("/data/"), F.col("lang"), F.lit("X_EQF"), (F.col("doc_id") % 8 + 1).cast("string"),
        F.lit(".ndjson"),
    )
    files = table(spark, sf_dir, "documents").select(name.alias("file"))
    country, level = readers.grid_columns(F.col("file"))
    return files.filter(readers.is_ndjson_name(F.col("file"))).groupBy(
        country.alias("country"), level.alias("level")
    ).agg(F.count("*").alias("items"))


# --- CSV ----------------------------------------------------------------------

_FLAT = """SELECT doc_id::VARCHAR AS id, ' ' || text || '\\ "q", ' AS text,
                  CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS "dotted.name", n_chars::VARCHAR AS n_chars
           FROM documents"""


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit(" "), "text", F.lit('\\ "q", ')).alias("text"),
        F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("dotted.name"),
        F.col("n_chars").alias("n_chars"),
    )


@query("csv_minimal_quotes", _FLAT)
def csv_minimal_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = _flat(spark, sf_dir)
    writers.write_csv(rows, path)
    return readers.read_csv(spark, path, rows.columns)


@query("csv_all_quotes", _FLAT)
def csv_all_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = _flat(spark, sf_dir)
    writers.write_csv(rows, path, quote_all=True, rows_per_file=100)
    return readers.read_csv(spark, path, rows.columns)


@query(
    "csv_shards",
    """SELECT shard, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM (
         SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS shard FROM orders)
       GROUP BY shard""",
)
def csv_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    writers.write_shards(orders, path, ["o_orderkey"], 1000)
    rows = (
        spark.read.schema("o_orderkey bigint, o_orderpriority string, shard bigint")
        .option("header", True)
        .csv(path)
    )
    return rows.groupBy("shard").agg(
        F.count("*").alias("n"),
        F.min("o_orderkey").alias("first"),
        F.max("o_orderkey").alias("last"),
    )


# --- stores -------------------------------------------------------------------


@query(
    "keyed_store",
    f"""SELECT uri AS id, min(doc_id) AS doc_id FROM ({ad.LIST_ITEMS_SQL}) WHERE uri IS NOT NULL GROUP BY uri""",
)
def keyed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delivery twice into one store; the first document of an id stays."""
    path = scratch_path(spark, "store")
    docs = ad.list_items(spark, sf_dir).select(F.col("uri").alias("id"), "doc_id")
    stored = docs
    for _ in range(2):
        stored = writers.store_new(docs, path, "id", ["doc_id"])
    return stored


@query(
    "level_document",
    f"""WITH items AS (SELECT level, "from", pos, doc_id FROM ({ad.LIST_ITEMS_SQL})),
          firsts AS (SELECT level, min(("from", pos)) AS f, max("from") AS last, count(*) AS n FROM items GROUP BY level)
        SELECT level, 0 AS section, 0 AS "from", 0 AS pos,
               '{{"metadata": {{"lastFrom": ' || last || ', "totalSaved": ' || n || '}}, "courses": [' AS line FROM firsts
        UNION ALL SELECT level, 1, "from", pos,
               CASE WHEN ("from", pos) = f THEN '' ELSE ',' END || '{{"nr":' || doc_id || '}}' FROM items JOIN firsts USING (level)
        UNION ALL SELECT level, 2, 0, 0, ']}}' FROM firsts""",
)
def level_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ad.list_items(spark, sf_dir).withColumn(
        "item", F.to_json(F.struct(F.col("doc_id").alias("nr")))
    )
    return writers.level_document_lines(items)


@query(
    "level_document_files",
    f"""SELECT level, count(*) + 2 AS lines FROM ({ad.LIST_ITEMS_SQL}) GROUP BY level""",
)
def level_document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "levels")
    items = ad.list_items(spark, sf_dir).withColumn("item", F.to_json(F.struct("uri", "doc_id")))
    writers.write_level_documents(items, path)
    stored = spark.read.schema("value string, level int").text(path)
    return stored.groupBy("level").agg(F.count("*").alias("lines"))


@query(
    "dead_letter_tables",
    """SELECT status, coalesce(reason, '') AS reason, count(*) AS n FROM (
         SELECT CASE event_type WHEN 'error' THEN 'dead' ELSE 'good' END AS status,
                CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'no uri'
                     WHEN event_type = 'error' THEN 'status-404' END AS reason FROM events) GROUP BY ALL""",
)
def dead_letter_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, dead = scratch_path(spark, "good"), scratch_path(spark, "dead")
    writers.write_split(ad.outcome_log(spark, sf_dir), "reason", good, dead)
    kept = spark.read.parquet(good).select(F.lit("good").alias("status"), F.lit("").alias("reason"))
    lost = spark.read.parquet(dead).select(F.lit("dead").alias("status"), "reason")
    return kept.union(lost).groupBy("status", "reason").agg(F.count("*").alias("n"))


@query(
    "audit_store",
    f"""SELECT doc_id, t AS original, {cleaned_sql('t')} AS cleaned, {removed_sql('t')} AS removed
        FROM (SELECT doc_id, text || ' Enrol now' AS t FROM documents)""",
)
def audit_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "audit")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat("text", F.lit(" Enrol now")).alias("description"),
        F.col("source").alias("learningOutcomes"),
    )
    writers.write_audit(cleaner.audit_rows(rows, "doc_id"), path)
    return spark.read.parquet(path).select(
        "doc_id",
        F.col("original.description").alias("original"),
        F.col("cleaned.description").alias("cleaned"),
        F.array_join("removed.description", "|").alias("removed"),
    )


# --- streams ------------------------------------------------------------------

_ITEM_SCHEMA = "doc_id bigint, level int, country string, `from` bigint, pos bigint, uri string"


@query("stream_ingest", f"SELECT doc_id, level, uri FROM ({ad.LIST_ITEMS_SQL})")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing folder; the second takes only the new files."""
    out, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    drop = scratch_path(spark, "drop")
    # Both halves land, the second one after the first run.
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for arrival in range(2):
        items = ad.list_items(spark, sf_dir).filter(half == arrival)
        items.repartition(4, "doc_id").write.mode("append").json(drop)
        stream = ingest.list_item_stream(spark, drop, _ITEM_SCHEMA, files_per_batch=2)
        ingest.ingest_files(stream, out, state)
    return spark.read.parquet(out).select("doc_id", "level", "uri")


# Arrivals of the item drop: one folder after the other, each within its own run.
_ARRIVAL = "doc_id % 3"


@query(
    "stream_first_seen",
    f"""SELECT doc_id, level, country, "from", pos, uri FROM (
          SELECT *, row_number() OVER (PARTITION BY level, uri ORDER BY {_ARRIVAL}, "from", pos) AS rn
          FROM ({ad.LIST_ITEMS_SQL}) WHERE uri IS NOT NULL) WHERE rn = 1""",
)
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing folder: of each key, the first row of its first arrival."""
    out, state, drop = (scratch_path(spark, name) for name in ("seen", "state", "drop"))
    for arrival in range(3):
        items = ad.list_items(spark, sf_dir).filter(F.expr(f"{_ARRIVAL} = {arrival}"))
        items.repartition(2, "doc_id").write.mode("append").json(drop)
        ingest.first_seen_stream(
            ingest.list_item_stream(spark, drop, _ITEM_SCHEMA),
            lambda files: ingest.list_item_files(spark, files, _ITEM_SCHEMA),
            out, state, "uri", ["from", "pos"], ["level"],
        )
    return spark.read.parquet(out).select("doc_id", "level", "country", "from", "pos", "uri")


@query(
    "stream_counters",
    f"""SELECT country, level, count(*) AS items, count(*) FILTER (WHERE uri IS NULL) AS without_uri,
               max("from") AS last_from FROM ({ad.LIST_ITEMS_SQL}) GROUP BY country, level""",
)
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing folder; the counters are those of the last whole version."""
    out, state, drop = (scratch_path(spark, name) for name in ("counters", "state", "drop"))
    for arrival in range(2):
        items = ad.list_items(spark, sf_dir).filter(F.col("doc_id") % 2 == arrival)
        items.repartition(4, "doc_id").write.mode("append").json(drop)
        stream = ingest.list_item_stream(spark, drop, _ITEM_SCHEMA, files_per_batch=2)
        ingest.counter_stream(stream, out, state)
    return ingest.read_counters(spark, out)


@query(
    "malformed_documents",
    "SELECT doc_id FROM documents WHERE doc_id % 31 = 0",
)
def malformed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ad.qual_documents(spark, sf_dir)
    damaged = docs.withColumn(
        "body", F.when(F.col("doc_id") % 31 == 0, F.concat("body", F.lit("}"))).otherwise(F.col("body"))
    )
    return extract.malformed(damaged).select("doc_id")
