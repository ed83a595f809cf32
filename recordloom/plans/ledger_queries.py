"""Row rules, ledger, counters, numbering and unions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import text as tx
from recordloom.operators import cleaner, ledger, quality
from recordloom.plans import adapters as ad
from recordloom.plans import check_sql as q
from recordloom.plans import jobs
from recordloom.plans.registry import query, table

BASE_URL = "https://catalogue.example/search"

# --- completeness -------------------------------------------------------------


def _gappy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with every kind of empty cell."""
    doc = F.col("doc_id")
    word = F.when(doc % 19 == 0, " NULL ").otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.when(doc % 7 == 0, "").otherwise(word).alias("title"),
        F.when(doc % 5 == 0, " \u00A0").otherwise(F.col("lang")).alias("country"),
        F.when(doc % 11 != 0, F.lit("Level 4")).alias("level"),
        F.col("text").alias("description"),
        F.when(doc % 13 == 0, " [] ").otherwise(F.concat(F.lit('["'), "source", F.lit('"]'))).alias(
            "outcomes"
        ),
    )


_GAPPY = """
  SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 19 = 0 THEN ' NULL ' ELSE source END AS title,
         CASE WHEN doc_id % 5 = 0 THEN ' ' || chr(160) ELSE lang END AS country,
         CASE WHEN doc_id % 11 <> 0 THEN 'Level 4' END AS level, text AS description,
         CASE WHEN doc_id % 13 = 0 THEN ' [] ' ELSE '["' || source || '"]' END AS outcomes
  FROM documents"""
_COLUMNS = ["title", "country", "level", "description", "outcomes"]


def _all_filled(null_word: bool) -> str:
    return " AND ".join(q.is_filled(c, null_word) for c in _COLUMNS)


@query("complete_rows_lo", f"SELECT doc_id, title FROM ({_GAPPY}) WHERE {_all_filled(False)}")
def complete_rows_lo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gappy_rows(spark, sf_dir)
    return quality.complete_rows(rows, _COLUMNS).select("doc_id", "title")


@query("complete_rows_qual", f"SELECT doc_id, title FROM ({_GAPPY}) WHERE {_all_filled(True)}")
def complete_rows_qual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gappy_rows(spark, sf_dir)
    return quality.complete_rows(rows, _COLUMNS, ("null",)).select("doc_id", "title")


@query(
    "filter_accounting",
    f"""SELECT lang, count(*) AS total, count(*) FILTER (WHERE {_all_filled(True)}) AS kept,
               count(*) FILTER (WHERE NOT ({_all_filled(True)})) AS dropped
        FROM ({_GAPPY}) GROUP BY lang""",
)
def filter_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gappy_rows(spark, sf_dir)
    return quality.accounting(rows, quality.all_filled(_COLUMNS, ("null",)), ["lang"])


_MARKED = "CASE WHEN doc_id % 3 = 0 THEN '1. ' || text ELSE text END"


@query(
    "changed_rows",
    f"""SELECT lang, count(*) AS total,
               count(*) FILTER (WHERE t <> {q.strip_enumeration('t')}) AS changed
        FROM (SELECT lang, {_MARKED} AS t FROM documents) GROUP BY lang""",
)
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    marked = F.when(doc % 3 == 0, F.concat(F.lit("1. "), "text")).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "documents").select("lang", marked.alias("t"))
    return quality.changed_rows(rows, F.col("t"), tx.strip_enumeration(F.col("t")), ["lang"])


@query(
    "column_shapes",
    """SELECT c_custkey AS "qualificationName", c_mktsegment AS "qualificationLevel",
              regexp_extract(c_name, '([1-9][0-9]*)', 1) AS "qualificationLevelNum", '' AS description, c_name AS label
       FROM customer""",
)
def column_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("qualificationName"),
        F.col("c_mktsegment").alias("qualificationLevel"),
        F.col("c_name").alias("name.prefLabel"),
        F.col("c_nationkey").alias("sourceFile"),
    )
    rows = quality.ensure_columns(rows, ["qualificationName", "description"])
    label = quality.first_present(rows, "label", "name.prefLabel", "sourceFile")
    number = F.regexp_extract("`name.prefLabel`", "([1-9][0-9]*)", 1)
    shaped = quality.insert_after(
        rows.withColumn("label", label), "qualificationLevel", "qualificationLevelNum", number
    )
    return quality.drop_columns(shaped, "sourceFile", "name.prefLabel")


@query(
    "dead_letter_keys",
    f"""SELECT doc_id, CASE WHEN uri IS NULL THEN 'no uri' ELSE 'bad id' END AS reason FROM (
          SELECT doc_id, CASE WHEN doc_id % 10 = 5 THEN 'http://data.example/' ELSE uri END AS uri
          FROM ({ad.LIST_ITEMS_SQL})) WHERE uri IS NULL OR uri = 'http://data.example/'""",
)
def dead_letter_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.when(F.col("doc_id") % 10 == 5, "http://data.example/").otherwise(F.col("uri"))
    items = ad.list_items(spark, sf_dir).withColumn("uri", uri)
    _, dead = quality.split_by(items, quality.key_reason(F.col("uri")))
    return dead.select("doc_id", "reason")


@query(
    "bad_index_urls",
    """SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'invalid-url' ELSE 'bad-url' END AS reason
       FROM pages WHERE page_id % 9 = 0 OR page_id % 7 = 0""",
)
def bad_index_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    url = F.when(page % 9 == 0, None).when(page % 7 == 0, "//").otherwise(F.col("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    _, dead = quality.split_by(pages, quality.url_reason(F.col("url")))
    return dead.select("page_id", "reason")


# Every 13th entry has no address, every 11th one of slashes alone; every 7th request raises an error.
_ENTRIES = f"""
  SELECT *, CASE WHEN seq % 13 = 0 THEN '' WHEN seq % 11 = 0 THEN '//'
                 ELSE 'http://data.example/q/' || seq END AS url,
         CASE WHEN seq % 7 = 0 THEN 'socket hang up' END AS error FROM ({ad.OUTCOME_LOG_SQL})"""


@query(
    "outcome_classes",
    f"""SELECT seq, CASE WHEN seq % 13 = 0 OR seq % 11 = 0 OR event_type = 'view' THEN 'skipped'
                         WHEN error IS NULL AND http_status IN (200, 201) THEN 'saved' ELSE 'failed' END AS class,
               CASE WHEN seq % 13 = 0 THEN 'invalid-url' WHEN seq % 11 = 0 THEN 'bad-url'
                    WHEN event_type = 'view' THEN 'exists' WHEN error IS NOT NULL THEN 'exception'
                    WHEN http_status IN (200, 201) THEN NULL
                    ELSE 'status-' || coalesce(CAST(http_status AS VARCHAR), 'noresp') END AS why
        FROM ({_ENTRIES})""",
)
def outcome_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq, head = F.col("seq"), F.lit("http://data.example/q/")
    url = F.when(seq % 13 == 0, "").when(seq % 11 == 0, "//").otherwise(F.concat(head, seq.cast("string")))
    given = (
        F.col("http_status"), F.col("stored"), quality.url_reason(url), F.when(seq % 7 == 0, "socket hang up"),
    )
    return ad.outcome_log(spark, sf_dir).select(
        "seq", quality.outcome_class(*given).alias("class"), quality.outcome_reason(*given).alias("why")
    )


# --- requests -----------------------------------------------------------------


@query(
    "request_manifest",
    f"""WITH cells AS (
          SELECT upper(n_name) AS country, level, last_from
          FROM nation JOIN (SELECT c_nationkey, count(*) // 10 * 10 AS last_from FROM customer GROUP BY ALL)
            ON n_nationkey = c_nationkey, (SELECT CAST(unnest(range(1, 9)) AS INTEGER) AS level))
        SELECT country, level, "from", '{BASE_URL}?keywords=&size=10&from=' || "from"
                 || '&sortType=publication%20date&language=en&type=qualification'
                 || '&location=http://publications.europa.eu/resource/authority/country/' || country
                 || '&eqfLevel=http://data.europa.eu/snb/eqf/' || level || '&version=1.8' AS url
        FROM (SELECT country, level, unnest(range(0, last_from + 1, 10)) AS "from" FROM cells)""",
)
def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "customer").groupBy("c_nationkey").count()
    nations = table(spark, sf_dir, "nation").join(hits, F.expr("n_nationkey = c_nationkey"))
    grid = ledger.work_grid(nations.select(F.upper("n_name").alias("country"), "count"))
    requests = ledger.page_offsets(grid, F.expr("count div 10 * 10"))
    url = ledger.search_url(
        BASE_URL, "qualification", F.col("country"), F.col("level"), F.col("from")
    )
    return requests.select("country", "level", "from", url.alias("url"))


@query(
    "level_manifest",
    f"""SELECT level, "from", '{BASE_URL}?keywords=&size=150&from=' || "from"
                 || '&sortType=publication+date&language=en&type=learning-opportunity&eqfLevel='
                 || url_encode('http://data.europa.eu/snb/eqf/' || level) || '&version=1.8' AS url
        FROM (SELECT level, unnest(range(0, n + 1, 150)) AS "from"
              FROM (SELECT level, count(*) AS n FROM ({ad.LIST_ITEMS_SQL}) GROUP BY level))""",
)
def level_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ad.list_items(spark, sf_dir).groupBy("level").agg(F.count("*").alias("n"))
    requests = ledger.page_offsets(counts, F.col("n"), 150)
    url = ledger.level_url(BASE_URL, "learning-opportunity", F.col("level"), F.col("from"), 150)
    return requests.select("level", "from", url.alias("url"))


@query(
    "detail_manifest",
    f"""SELECT doc_id, '{BASE_URL}?uri=' || url_encode(uri) || '&language=en&version=1.8' AS url
        FROM (SELECT doc_id, uri || '/a b' AS uri FROM ({ad.LIST_ITEMS_SQL})) WHERE uri IS NOT NULL""",
)
def detail_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ad.list_items(spark, sf_dir).filter("uri IS NOT NULL")
    uri = F.concat("uri", F.lit("/a b"))
    return items.select("doc_id", ledger.detail_url(BASE_URL, uri).alias("url"))


# --- membership and first seen --------------------------------------------------


@query(
    "skip_done",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ledger.skip_done(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "allow_list",
    """SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (
         SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""",
)
def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    europe = table(spark, sf_dir, "region").filter("r_name = 'EUROPE'")
    nations = table(spark, sf_dir, "nation").join(europe, F.expr("n_regionkey = r_regionkey"))
    allowed = nations.select(F.col("n_nationkey").alias("c_nationkey"))
    kept = ledger.only_listed(table(spark, sf_dir, "customer"), allowed, ["c_nationkey"])
    return kept.select("c_custkey", "c_name")


@query(
    "wanted_countries",
    """SELECT country, count(*) AS n FROM (SELECT upper(lang) AS country FROM documents)
       WHERE country IN ('EN', 'FR') GROUP BY country""",
)
def wanted_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.upper("lang").alias("country"))
    return ledger.wanted_countries(docs, " en, ,Fr ").groupBy("country").agg(
        F.count("*").alias("n")
    )


_ITEM = 'doc_id, level, country, "from", pos, uri'


@query(
    "first_seen_by_id",
    f"""SELECT {_ITEM} FROM (SELECT *, row_number() OVER (
          PARTITION BY country, level, uri ORDER BY "from", pos) AS rn FROM ({ad.LIST_ITEMS_SQL}))
        WHERE rn = 1 OR uri IS NULL""",
)
def first_seen_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ad.list_items(spark, sf_dir)
    return ledger.first_seen(items, "uri", ["from", "pos"], ["country", "level"], keep_missing=True)


@query(
    "first_seen_by_uri",
    f"""SELECT {_ITEM} FROM (SELECT *, row_number() OVER (
          PARTITION BY level, uri ORDER BY "from", pos) AS rn FROM ({ad.LIST_ITEMS_SQL}) WHERE uri IS NOT NULL)
        WHERE rn = 1""",
)
def first_seen_by_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.first_seen(ad.list_items(spark, sf_dir), "uri", ["from", "pos"], ["level"])


# --- counters -------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.outcome_log(spark, sf_dir).withColumn("ts", ad.micros(F.col("ts")))


@query(
    "crawl_counters",
    f"""SELECT country, count(*) FILTER (WHERE status = 'saved' OR (status = 'failed' AND reason <> 'no uri')) AS attempted,
               count(*) FILTER (WHERE status = 'saved') AS succeeded,
               count(*) FILTER (WHERE status = 'failed') AS failed,
               count(*) FILTER (WHERE status = 'skipped') AS skipped,
               max(seq) AS last_line, epoch_us(max(ts)) AS last_updated
        FROM ({ad.OUTCOME_LOG_SQL}) GROUP BY country""",
)
def crawl_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.crawl_counters(_log(spark, sf_dir))


@query(
    "outcome_counts",
    f"""SELECT level, count(*) FILTER (WHERE status = 'saved') AS saved,
               count(*) FILTER (WHERE status = 'skipped') AS skipped,
               count(*) FILTER (WHERE status = 'failed') AS failed
        FROM ({ad.OUTCOME_LOG_SQL}) GROUP BY level""",
)
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.outcome_counts(ad.outcome_log(spark, sf_dir))


@query(
    "cell_counters",
    f"""SELECT level, count(*) AS total_pages, CAST(sum(n) AS BIGINT) AS total_items,
               max("from") + 10 AS next_from, max(ts) AS last_updated
        FROM (SELECT level, "from", count(*) AS n, max(doc_id) AS ts FROM ({ad.LIST_ITEMS_SQL}) GROUP BY ALL)
        GROUP BY level""",
)
def cell_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = ad.list_items(spark, sf_dir).groupBy("level", "from").agg(
        F.count("*").alias("n_new"), F.max("doc_id").alias("ts")
    )
    return ledger.cell_counters(pages, ["level"])


@query(
    "resume_offsets",
    f"""SELECT g.country, g.level, coalesce(n, 0) AS lines, coalesce(n, 0) // 10 * 10 AS "from"
        FROM (SELECT DISTINCT substr(source, 1, 5) AS country, CAST(unnest(range(1, 9)) AS INTEGER) AS level
              FROM documents) g
        LEFT JOIN (SELECT substr(source, 1, 5) AS country, CAST(doc_id % 5 + 1 AS INTEGER) AS level, count(*) AS n
                   FROM documents GROUP BY ALL) s
          ON g.country = s.country AND g.level = s.level""",
)
def resume_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "documents").select(
        F.substring("source", 1, 5).alias("country"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("level"),
    )
    grid = ledger.work_grid(stored.select("country").distinct())
    return ledger.resume_offsets(grid, stored, ["country", "level"])


@query(
    "country_totals",
    """SELECT n_name AS country, count(*) AS records, CAST(grouping(n_name) AS INTEGER) AS grand_total
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name)""",
)
def country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    return ledger.country_totals(named.select(F.col("n_name").alias("country")))


@query(
    "country_files",
    f"""SELECT country, string_agg(file, ',' ORDER BY level, file) AS files FROM (
          SELECT DISTINCT country, level, upper(country) || '_eqf' || level || '.ndjson' AS file
          FROM ({ad.LIST_ITEMS_SQL})) GROUP BY country""",
)
def country_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.concat(F.upper("country"), F.lit("_eqf"), F.col("level").cast("string"), F.lit(".ndjson"))
    items = ad.list_items(spark, sf_dir).withColumn("file", file)
    return ledger.country_files(items).select("country", F.array_join("files", ",").alias("files"))


@query(
    "open_requests",
    f"""WITH cells AS (SELECT DISTINCT country, level FROM ({ad.LIST_ITEMS_SQL})),
          n AS (SELECT country, level, count(*) AS lines FROM ({ad.LIST_ITEMS_SQL}) WHERE uri IS NOT NULL GROUP BY ALL)
        SELECT country, level, coalesce(lines, 0) AS lines, coalesce(lines, 0) // 10 * 10 AS "from"
        FROM cells LEFT JOIN n USING (country, level) WHERE coalesce(lines, 0) < 30""",
)
def open_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ad.list_items(spark, sf_dir)
    cells = items.select("country", "level").distinct()
    stored = items.filter("uri IS NOT NULL")
    done = stored.groupBy("country", "level").count().filter("count >= 30")
    return jobs.open_requests(cells, done, stored, ["country", "level"])


# --- windows ----------------------------------------------------------------------


@query(
    "recent_rows",
    f"""SELECT country, status, seq, age FROM (SELECT *, row_number() OVER (
          PARTITION BY country, status ORDER BY seq DESC) AS age FROM ({ad.OUTCOME_LOG_SQL})) WHERE age <= 100""",
)
def recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ad.outcome_log(spark, sf_dir).select("country", "status", "seq")
    return ledger.recent_rows(log)


@query(
    "milestones",
    f"""SELECT status, seq, n FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY seq) AS n
          FROM ({ad.OUTCOME_LOG_SQL})) WHERE n % 100 = 0""",
)
def milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ad.outcome_log(spark, sf_dir).select("status", "seq")
    return ledger.milestones(log, by=["status"])


_GAPS = """SELECT {by} epoch_us(before) AS idle_from, epoch_us(ts) AS idle_to,
                  epoch_us(ts) - epoch_us(before) AS idle_micros
           FROM (SELECT *, lag(ts) OVER ({part} ORDER BY ts) AS before FROM ({log}))
           WHERE epoch_us(ts) - epoch_us(before) > 300000000"""


@query(
    "stall_gaps",
    _GAPS.format(by="country,", part="PARTITION BY country", log=ad.OUTCOME_LOG_SQL),
)
def stall_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ad.outcome_log(spark, sf_dir).select("country", "ts")
    return ledger.stall_gaps(log, ad.micros(F.col("ts")), ["country"])


@query("stall_gaps_overall", _GAPS.format(by="", part="", log=ad.OUTCOME_LOG_SQL))
def stall_gaps_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ad.outcome_log(spark, sf_dir).select("ts")
    return ledger.stall_gaps(log, ad.micros(F.col("ts")))


@query(
    "numbered_pages",
    """SELECT lang, doc_id, (rn - 1) // 10 * 10 AS "from", (rn - 1) % 10 AS pos FROM (
         SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)""",
)
def numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return ledger.numbered_pages(docs, ["doc_id"], ["lang"])


@query("page_of", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10 OFFSET 20")
def page_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ledger.page_of(docs, ["doc_id"], 20)


@query(
    "shard_rows",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS shard FROM orders""",
)
def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return ledger.shard_rows(orders, ["o_orderkey"], 1000)


@query(
    "line_numbers",
    """SELECT doc_id, i AS line_no, x AS line FROM (
         SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS x
         FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
       WHERE trim(x) <> '' AND i > doc_id % 3""",
)
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    numbered = lines.withColumn("line_no", (F.col("i") + 1).cast("bigint"))
    return numbered.filter(
        (tx.trim_ws(F.col("line")) != "") & (F.col("line_no") > F.col("doc_id") % 3)
    ).select("doc_id", "line_no", "line")


# --- unions and the user's cleaner ---------------------------------------------------


@query(
    "positional_union",
    """SELECT c_custkey AS id, c_name AS name, 1 AS part FROM customer
       UNION ALL SELECT s_suppkey, s_name, 2 FROM supplier""",
)
def positional_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return ledger.positional_union(customers, suppliers, "part")


def _hook_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    def hook(batch):  # type: ignore[no-untyped-def]
        out = batch.copy()
        if (out["description"] == "fail").any():
            raise ValueError("cannot clean")
        out["description_removed"] = [[t[:3]] for t in out["description"]]
        out["learningOutcomes_removed"] = None
        out["description"] = [t[3:] for t in out["description"]]
        return out

    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 50 == 7, "fail").otherwise(F.col("text")).alias("description"),
        F.col("source").alias("learningOutcomes"),
    )
    return cleaner.apply_hook(rows, "doc_id", hook)


@query(
    "cleaner_hook",
    """SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN 'fail' ELSE substr(text, 4) END AS description,
              source AS "learningOutcomes", CASE WHEN doc_id % 50 = 7 THEN 'cannot clean' END AS error
       FROM documents""",
)
def cleaner_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaner.hook_rows(_hook_results(spark, sf_dir), "doc_id")


@query(
    "cleaner_hook_audit",
    """SELECT doc_id, text AS original, substr(text, 4) AS cleaned, substr(text, 1, 3) AS removed,
              CAST(0 AS INTEGER) AS outcomes_removed
       FROM documents WHERE doc_id % 50 <> 7""",
)
def cleaner_hook_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = cleaner.hook_audit(_hook_results(spark, sf_dir), "doc_id")
    return audit.select(
        "doc_id",
        F.col("original.description").alias("original"),
        F.col("cleaned.description").alias("cleaned"),
        F.array_join("removed.description", "|").alias("removed"),
        F.size("removed.learningOutcomes").alias("outcomes_removed"),
    )
