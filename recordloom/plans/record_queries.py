"""Extraction from JSON records, outcome lists and the composite jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import outcomes as ox
from recordloom.functions import text as tx
from recordloom.functions import variants as vx
from recordloom.operators import cleaner, extract, ledger
from recordloom.plans import adapters as ad
from recordloom.plans import check_sql as q
from recordloom.plans import jobs
from recordloom.plans.registry import query, table
from recordloom.session import scratch_path

def _doc() -> Column:
    return F.col("doc")


def _parsed(docs: DataFrame) -> DataFrame:
    return vx.with_json(docs, "body", "doc")


# --- single fields ----------------------------------------------------------

_FIRST_LINE = "list_filter(string_split(text, chr(10)), lambda s: s <> '')[1]"


@query(
    "nested_get",
    f"""SELECT doc_id, coalesce({_FIRST_LINE}, '(none)') AS title,
               CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END AS country,
               CASE WHEN doc_id % 13 = 0 THEN '(none)' ELSE 'Level ' || (doc_id % 8 + 1) END AS level,
               '(none)' AS missing
        FROM documents""",
)
def nested_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = "$.publisher.location[0].address[0].countryCode.prefLabel"
    return _parsed(ad.qual_documents(spark, sf_dir)).select(
        "doc_id",
        vx.text_at(_doc(), "$.title", "(none)").alias("title"),
        vx.text_at(_doc(), country, "(none)").alias("country"),
        vx.text_at(_doc(), "$.EQFLevel.prefLabel", "(none)").alias("level"),
        vx.text_at(_doc(), "$.publisher.location[3].address", "(none)").alias("missing"),
    )


@query(
    "provider_country",
    """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang WHEN doc_id % 7 <> 0 THEN source ELSE '' END
         AS country FROM documents""",
)
def provider_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.lo_documents(spark, sf_dir)).select(
        "doc_id", extract.provider_country(_doc()).alias("country")
    )


@query(
    "publisher_country",
    "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END AS country FROM documents",
)
def publisher_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.qual_documents(spark, sf_dir)).select(
        "doc_id", extract.publisher_country(_doc()).alias("country")
    )


_LO_LEVEL = """CASE WHEN doc_id % 3 = 0 THEN 'EQF level ' || (doc_id % 8 + 1)
  WHEN doc_id % 13 <> 0 THEN 'Level ' || (doc_id % 8 + 1) ELSE '' END"""


@query("level_label", f"SELECT doc_id, {_LO_LEVEL} AS level FROM documents")
def level_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.lo_documents(spark, sf_dir)).select(
        "doc_id", extract.lo_level(_doc()).alias("level")
    )


@query("summary_text", f"SELECT doc_id, {q.trim('text')} AS summary FROM documents")
def summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.lo_documents(spark, sf_dir)).select(
        "doc_id", extract.lo_summary(_doc()).alias("summary")
    )


@query(
    "entry_requirement",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN source ELSE '' END AS entry, text AS description
       FROM documents""",
)
def entry_requirement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.qual_documents(spark, sf_dir)).select(
        "doc_id",
        extract.entry_requirement(_doc()).alias("entry"),
        extract.qual_summary(_doc()).alias("description"),
    )


@query(
    "label_normalise",
    """SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN ''
         WHEN doc_id % 5 = 4 THEN 'Level ' || (doc_id % 8 + 1) ELSE 'Level ' || (doc_id % 8 + 1) END
         AS level FROM documents""",
)
def label_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.multilingual_documents(spark, sf_dir)).select(
        "doc_id", extract.multilingual_level(_doc(), F.col("body")).alias("level")
    )


@query(
    "deep_country",
    "SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN lang END AS country FROM documents",
)
def deep_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.multilingual_documents(spark, sf_dir)).select(
        "doc_id", extract.deep_country(F.col("body")).alias("country")
    )


@query(
    "notes_flatten",
    f"""SELECT d.doc_id, coalesce(n.notes, '') AS notes
        FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(x, ' | ' ORDER BY i) AS notes FROM ({q.LINES})
          WHERE doc_id % 10 <> 3 GROUP BY doc_id) n USING (doc_id)""",
)
def notes_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.multilingual_documents(spark, sf_dir)).select(
        "doc_id", F.array_join(ox.note_texts(_doc(), F.col("body")), " | ").alias("notes")
    )


_LO_OUTCOMES = f"""
  SELECT doc_id, to_json(list({{'title': x, 'additionalNote': [(i + 1) || ') ' || x || ' ']}} ORDER BY i))
           ::VARCHAR AS outcomes
  FROM ({q.LINES}) GROUP BY doc_id"""


@query(
    "lo_outcome_array",
    f"SELECT doc_id, coalesce(outcomes, '[]') AS outcomes FROM documents LEFT JOIN ({_LO_OUTCOMES}) USING (doc_id)",
)
def lo_outcome_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.lo_documents(spark, sf_dir)).select(
        "doc_id", F.to_json(ox.lo_outcomes(_doc())).alias("outcomes")
    )


_QUAL_ITEMS = f"""
  SELECT doc_id, i, CASE WHEN i % 3 = 2 THEN '' ELSE x END AS t,
         CASE WHEN i % 2 = 0 THEN 'Note: ' || x ELSE '' END AS n
  FROM ({q.LINES})
  UNION ALL SELECT doc_id, 1000000, '1.', '' FROM documents WHERE doc_id % 9 = 0"""
_QUAL_OUTCOMES = f"""
  SELECT doc_id, to_json(list({{'title': t, 'additionalNotes': n}} ORDER BY i))::VARCHAR AS outcomes
  FROM ({_QUAL_ITEMS}) GROUP BY doc_id"""


@query(
    "qual_outcome_array",
    f"SELECT doc_id, coalesce(outcomes, '[]') AS outcomes FROM documents LEFT JOIN ({_QUAL_OUTCOMES}) USING (doc_id)",
)
def qual_outcome_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.qual_documents(spark, sf_dir)).select(
        "doc_id", F.to_json(ox.qual_outcomes(_doc())).alias("outcomes")
    )


_URI = "CASE WHEN doc_id % 17 <> 0 THEN 'http://data.example/q/' || md5(text) END"


@query("record_uri", f"SELECT doc_id, coalesce({_URI}, '') AS uri FROM documents")
def record_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(ad.multilingual_documents(spark, sf_dir)).select(
        "doc_id", extract.record_uri(_doc()).alias("uri")
    )


@query(
    "item_id",
    """SELECT event_id, CASE event_id % 6 WHEN 5 THEN NULL ELSE event_type || event_id END AS id
       FROM events""",
)
def item_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat(F.col("event_type"), F.col("event_id").cast("string"))
    keys = ["id", "uuid", "identifier", "escoIdentifier", "uri"]
    fields = [
        F.when(F.col("event_id") % 6 == i, value)
        .when(F.col("event_id") % 6 < i, F.lit("later"))
        .alias(k)
        for i, k in enumerate(keys)
    ]
    items = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 6 == 5, "{}").otherwise(F.to_json(F.struct(*fields))).alias("body"),
    )
    return _parsed(items).select("event_id", extract.item_id(_doc()).alias("id"))


# --- result pages -----------------------------------------------------------


def _item_columns() -> list[Column]:
    return [
        F.col("level"),
        F.col("from"),
        F.col("pos").cast("bigint").alias("pos"),
        F.try_variant_get("item", "$.nr", "bigint").alias("nr"),
        vx.text_at(F.col("item"), "$.uri").alias("uri"),
    ]


_LISTED = f"""SELECT level, "from", row_number() OVER (PARTITION BY level, "from" ORDER BY pos) - 1 AS pos,
                     doc_id AS nr, uri FROM ({ad.LIST_ITEMS_SQL})"""


@query("envelope_items", _LISTED)
def envelope_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.unnest_items(ad.result_pages(spark, sf_dir)).select(*_item_columns())


@query(
    "envelope_courses", f"""SELECT * FROM ({_LISTED}) WHERE ("from" // 10 + 1) % 11 <> 0"""
)
def envelope_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = ad.course_pages(spark, sf_dir)
    return extract.unnest_items(pages, courses_only=True).select(*_item_columns())


_CELLS = f"""
  SELECT level, count(*) AS pages, CAST(sum(CASE WHEN nr % 11 = 0 THEN 0 ELSE n END) AS BIGINT) AS items,
         max(nr) * 10 AS next_from, bool_or(nr % 11 <> 0 AND nr >= level + 9) AS completed
  FROM (SELECT level, "from" // 10 + 1 AS nr, count(*) AS n FROM ({ad.LIST_ITEMS_SQL}) GROUP BY ALL)
  GROUP BY level"""


@query("completed_cells", _CELLS)
def completed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = extract.page_facts(ad.course_pages(spark, sf_dir))
    return ledger.completed_cells(facts, ["level"])


@query(
    "crawl_summary",
    f"""SELECT count(*) FILTER (WHERE completed) AS levels_completed, count(*) AS levels_total,
               CAST(sum(items) AS BIGINT) AS items_total FROM ({_CELLS})""",
)
def crawl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.crawl_summary(completed_cells(spark, sf_dir))


@query(
    "crawl_ledger",
    f"""SELECT level, pages, items, completed, next_from, coalesce(new_items, 0) AS new_items
        FROM ({_CELLS})
        LEFT JOIN (
          SELECT level, count(DISTINCT uri) + count(*) FILTER (WHERE uri IS NULL) AS new_items
          FROM ({ad.LIST_ITEMS_SQL}) WHERE ("from" // 10 + 1) % 11 <> 0 GROUP BY level) USING (level)""",
)
def crawl_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.crawl_ledger(ad.course_pages(spark, sf_dir), ["level"])


# --- raw outcome cells --------------------------------------------------------

_WORDS = f"""
  SELECT doc_id, i, t, reverse(t) AS n
  FROM (SELECT doc_id, i, {q.sub('x', '[^\\p{L}]+', ' ')} AS t FROM ({q.LINES}))
  WHERE trim(t, ' ') <> ''"""


def _composed(items: str) -> str:
    """Outcome text per doc_id from rows (doc_id, i, t, n)."""
    line = "CASE WHEN t <> '' AND n <> '' THEN t || ' ' || chr(8212) || ' ' || n ELSE t || n END"
    return f"""
      SELECT doc_id, string_agg(line, chr(10) || chr(10) ORDER BY i) AS outcomes
      FROM (SELECT doc_id, i, {line} AS line
            FROM (SELECT doc_id, i, {q.strip_labels('t')} AS t, {q.strip_labels('n')} AS n FROM ({items})))
      WHERE NOT {q.is_garbage('line')} GROUP BY doc_id"""


@query(
    "lenient_outcomes",
    f"""SELECT d.doc_id, coalesce(titles, '') AS titles, coalesce(notes, '') AS notes
        FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(t, '|' ORDER BY i) AS titles, string_agg(n, '|' ORDER BY i) AS notes
          FROM ({_WORDS}) GROUP BY doc_id) USING (doc_id)""",
)
def lenient_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = ad.broken_outcomes(spark, sf_dir)
    parsed = cells.select("doc_id", ox.parse_outcomes(F.col("cell")).alias("items"))
    return parsed.select(
        "doc_id",
        F.array_join("items.title", "|").alias("titles"),
        F.array_join("items.notes", "|").alias("notes"),
    )


@query(
    "outcome_text",
    f"""SELECT d.doc_id, coalesce(outcomes, '') AS outcomes
        FROM documents d LEFT JOIN ({_composed(_WORDS)}) USING (doc_id)""",
)
def outcome_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = ad.broken_outcomes(spark, sf_dir)
    return cells.select("doc_id", ox.outcomes_text(F.col("cell")).alias("outcomes"))


@query(
    "raw_notes",
    f"""SELECT d.doc_id, coalesce(notes, '') AS notes
        FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(CASE WHEN doc_id % 4 IN (1, 2) THEN {q.trim('x')}
                   ELSE {q.trim('x')} || ' ; n' || i END, ' ; ' ORDER BY i) AS notes
          FROM ({q.LINES}) GROUP BY doc_id) USING (doc_id)""",
)
def raw_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = ad.raw_note_cells(spark, sf_dir)
    return cells.select("doc_id", ox.notes_text(F.col("cell")).alias("notes"))


# --- whole records and jobs -----------------------------------------------------

_LO_FLAT = f"""
  SELECT 'doc' || doc_id || '.json' AS file, coalesce({_FIRST_LINE}, '') AS title,
         CASE WHEN doc_id % 5 <> 0 THEN lang WHEN doc_id % 7 <> 0 THEN source ELSE '' END
           AS "countryCode.prefLabel",
         {_LO_LEVEL} AS "EQFLevel.prefLabel", {q.trim('text')} AS "learningOutcomeSummary.noteLiteral",
         coalesce(outcomes, '[]') AS "learningOutcome", doc_id
  FROM documents LEFT JOIN ({_LO_OUTCOMES}) USING (doc_id)"""


@query("lo_records", f"SELECT * EXCLUDE (doc_id) FROM ({_LO_FLAT})")
def lo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.lo_records(ad.lo_documents(spark, sf_dir))


_QUAL_FLAT = f"""
  SELECT doc_id, coalesce({_FIRST_LINE}, '') AS "qualificationName",
         CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END AS country,
         CASE WHEN doc_id % 13 = 0 THEN '' ELSE 'Level ' || (doc_id % 8 + 1) END AS "qualificationLevel",
         text AS description, coalesce(outcomes, '[]') AS "learningOutcomes",
         CASE WHEN doc_id % 4 = 0 THEN source ELSE '' END AS "entryRequirement",
         'doc' || doc_id || '.json' AS "sourceFile"
  FROM documents LEFT JOIN ({_QUAL_OUTCOMES}) USING (doc_id)"""


@query("qual_records", f"SELECT * EXCLUDE (doc_id) FROM ({_QUAL_FLAT})")
def qual_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.qual_records(ad.qual_documents(spark, sf_dir), with_entry=True)


_MULTI = f"""
  SELECT coalesce({_FIRST_LINE}, '') AS title,
         CASE WHEN doc_id % 4 <> 0 THEN lang ELSE 'folder-' || source END AS country,
         CASE WHEN doc_id % 13 = 0 THEN '' ELSE 'Level ' || (doc_id % 8 + 1) END AS "qualificationLevel",
         CASE WHEN doc_id % 13 = 0 THEN '' ELSE CAST(doc_id % 8 + 1 AS VARCHAR) END AS "qualificationLevelNum",
         text AS description, notes AS "learningOutcome", coalesce({_URI}, '') AS uri
  FROM documents JOIN (
    SELECT doc_id, string_agg(x, ' | ' ORDER BY i) AS notes FROM ({q.LINES})
    WHERE doc_id % 10 <> 3 GROUP BY doc_id) USING (doc_id)"""


@query("multilingual_records", _MULTI)
def multilingual_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.multilingual_records(ad.multilingual_documents(spark, sf_dir))


_LO_KEPT = " AND ".join(
    q.is_filled(f'"{c}"')
    for c in (
        "title",
        "countryCode.prefLabel",
        "EQFLevel.prefLabel",
        "learningOutcomeSummary.noteLiteral",
        "learningOutcome",
    )
)
_LO_DATASET = f"""
  SELECT title, "countryCode.prefLabel", "EQFLevel.prefLabel" AS "EQFLevel_prefLabel",
         regexp_extract("EQFLevel.prefLabel", '(\\d+)', 1) AS "EQFLevel_numeric",
         "learningOutcomeSummary.noteLiteral",
         {q.strip_enumeration('notes')} AS "learningOutcome_additionalNote"
  FROM ({_LO_FLAT}) JOIN (
    SELECT doc_id, string_agg({q.trim("(i + 1) || ') ' || x")}, ' ; ' ORDER BY i) AS notes
    FROM ({q.LINES}) GROUP BY doc_id) USING (doc_id)
  WHERE {_LO_KEPT}"""


@query("lo_dataset", _LO_DATASET)
def lo_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.lo_dataset(ad.lo_documents(spark, sf_dir))


@query("lo_rows", _LO_DATASET)
def lo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.lo_rows(extract.lo_records(ad.lo_documents(spark, sf_dir)))


_QUAL_KEPT = " AND ".join(
    q.is_filled(f'f."{c}"', null_word=True)
    for c in ("qualificationName", "qualificationLevel", "description", "learningOutcomes", "country")
)
_QUAL_DATASET = f"""
  SELECT f."qualificationName", f.country, f."qualificationLevel",
         regexp_extract(f."qualificationLevel", {q.quoted('(?i)' + chr(92) + 'bLevel' + q.WS + '*([0-9]+)')}, 1)
           AS "qualificationLevelNum",
         {q.strip_html('f.description')} AS description,
         coalesce(c.outcomes, '') AS "learningOutcomes"
  FROM ({_QUAL_FLAT}) f LEFT JOIN ({_composed(_QUAL_ITEMS)}) c USING (doc_id)
  WHERE {_QUAL_KEPT}"""


@query("qual_dataset", _QUAL_DATASET)
def qual_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.qual_dataset(ad.qual_documents(spark, sf_dir))


@query("qual_rows", _QUAL_DATASET)
def qual_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.qual_rows(extract.qual_records(ad.qual_documents(spark, sf_dir), with_entry=True))


@query("multilingual_dataset", f"SELECT * FROM ({_MULTI}) WHERE uri <> ''")
def multilingual_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = ad.result_pages(spark, sf_dir)
    return jobs.multilingual_dataset(pages, ad.multilingual_documents(spark, sf_dir), ["level"])


@query(
    "published_union",
    f"""SELECT *, 1 AS part FROM ({_LO_DATASET}) UNION ALL SELECT *, 2 FROM ({_QUAL_DATASET})""",
)
def published_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.published(lo_dataset(spark, sf_dir), qual_dataset(spark, sf_dir), "part")


_BOILERPLATE = """CASE doc_id % 3
  WHEN 0 THEN text || chr(10) || 'For more information' || chr(10) || 'a@example.org' WHEN 1 THEN 'Enrol now'
  ELSE text END"""


def _boilerplate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 3
    description = (
        F.when(kind == 0, F.concat("text", F.lit("\nFor more information\na@example.org")))
        .when(kind == 1, "Enrol now")
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        description.alias("description"),
        F.concat(F.lit("1) "), F.col("text")).alias("learningOutcomes"),
    )


def cleaned_sql(x: str) -> str:
    return q.sub(q.sub(f"({q.strip_filler(x)})", q.CONTACT, ""), q.BULLET, "")


_TODO = f"""SELECT doc_id, {_BOILERPLATE} AS d, '1) ' || text AS lo FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


@query(
    "cleaned_rows",
    f"""SELECT doc_id, {cleaned_sql('d')} AS description, {cleaned_sql('lo')} AS "learningOutcomes"
        FROM ({_TODO})""",
)
def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels")
    return jobs.cleaned_with_audit(_boilerplate_rows(spark, sf_dir), "doc_id", done)[0]


def removed_sql(x: str) -> str:
    filler = f"({q.strip_filler(x)})"
    contacts = q.sub(filler, q.CONTACT, "")
    parts = [q.find_all(x, q.FILLER), q.find_all(filler, q.CONTACT), q.find_all(contacts, q.BULLET)]
    return f"array_to_string({parts[0]} || {parts[1]} || {parts[2]}, '|')"


@query(
    "cleaning_audit",
    f"""SELECT doc_id, length(d) AS original_length, {cleaned_sql('d')} AS cleaned,
               {removed_sql('d')} AS removed, {removed_sql('lo')} AS outcomes_removed
        FROM ({_TODO})""",
)
def cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels")
    audit = jobs.cleaned_with_audit(_boilerplate_rows(spark, sf_dir), "doc_id", done)[1]
    return audit.select(
        "doc_id",
        F.length("original.description").cast("bigint").alias("original_length"),
        F.col("cleaned.description").alias("cleaned"),
        F.array_join("removed.description", "|").alias("removed"),
        F.array_join("removed.learningOutcomes", "|").alias("outcomes_removed"),
    )


@query(
    "cleaning_batches",
    f"""SELECT doc_id, length(d) AS original_length, {cleaned_sql('d')} AS cleaned,
               {removed_sql('d')} AS removed, {removed_sql('lo')} AS outcomes_removed
        FROM (SELECT doc_id, {_BOILERPLATE} AS d, '1) ' || text AS lo FROM documents)""",
)
def cleaning_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one folder, the second over all rows: it cleans what the first did not."""
    out = scratch_path(spark, "batches")
    rows = _boilerplate_rows(spark, sf_dir)
    for todo in (rows.filter(F.col("doc_id") % 2 == 0), rows):
        jobs.clean_in_batches(todo, "doc_id", out, batches=2)
    audit = cleaner.hook_audit(jobs.cleaned_batches(spark, out), "doc_id")
    return audit.select(
        "doc_id",
        F.length("original.description").cast("bigint").alias("original_length"),
        F.col("cleaned.description").alias("cleaned"),
        F.array_join("removed.description", "|").alias("removed"),
        F.array_join("removed.learningOutcomes", "|").alias("outcomes_removed"),
    )


@query(
    "job_accounts",
    f"""SELECT count(*) AS read, count(*) FILTER (WHERE kept AND NOT dead) AS kept,
               count(*) FILTER (WHERE NOT kept AND NOT dead) AS dropped, count(*) FILTER (WHERE dead) AS dead
        FROM (SELECT doc_id % 31 = 0 AS dead, doc_id IN (
                SELECT doc_id FROM ({_QUAL_FLAT}) f LEFT JOIN ({_composed(_QUAL_ITEMS)}) c USING (doc_id)
                WHERE {_QUAL_KEPT}) AS kept FROM documents)""",
)
def job_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job over damaged documents counts while it writes."""
    docs = ad.qual_documents(spark, sf_dir)
    damaged = docs.withColumn(
        "body", F.when(F.col("doc_id") % 31 == 0, F.concat("body", F.lit("}"))).otherwise(F.col("body"))
    )
    out = scratch_path(spark, "accounts")
    counts = jobs.filed(
        damaged,
        lambda seen: jobs.qual_dataset(damaged, watch=seen),
        lambda rows: rows.write.parquet(f"{out}/rows"),
        f"{out}/dead",
    )
    names = ["read", "kept", "dropped", "dead"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query(
    "listed_items",
    f"""SELECT level, min(nr) AS nr, id FROM (SELECT level, doc_id AS nr, uri AS id FROM ({ad.LIST_ITEMS_SQL}))
        WHERE id IS NOT NULL GROUP BY level, id
        UNION ALL SELECT level, doc_id, uri FROM ({ad.LIST_ITEMS_SQL}) WHERE uri IS NULL""",
)
def listed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = jobs.listed_items(ad.result_pages(spark, sf_dir), ["level"])
    return listed.select(
        "level", F.get_json_object("item", "$.nr").cast("bigint").alias("nr"), "id"
    )


@query(
    "markers_per_note",
    f"""SELECT doc_id, coalesce(notes, '') AS notes FROM documents LEFT JOIN (
          SELECT doc_id, string_agg({q.strip_enumeration(q.trim("(i + 1) || ') ' || x"))}, ' ; ' ORDER BY i)
            AS notes FROM ({q.LINES}) GROUP BY doc_id) USING (doc_id)""",
)
def markers_per_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = F.flatten(F.transform(ox.lo_outcomes(_doc()), lambda x: x["additionalNote"]))
    clean = F.transform(notes, lambda t: tx.strip_enumeration(tx.trim_ws(t)))
    return _parsed(ad.lo_documents(spark, sf_dir)).select(
        "doc_id", F.array_join(clean, " ; ").alias("notes")
    )
