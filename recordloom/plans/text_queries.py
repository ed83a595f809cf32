"""Text operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import text as tx
from recordloom.plans import check_sql as q
from recordloom.plans.adapters import lines_of
from recordloom.plans.registry import query, table


@query("html_strip", f"SELECT page_id, {q.strip_html('html')} AS clean FROM pages")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.strip_html(F.col("html")).alias("clean")
    )


@query("entity_decode", f"SELECT page_id, {q.entities('html')} AS decoded FROM pages")
def entity_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.decode_entities(F.col("html")).alias("decoded")
    )


_ENUM = "(doc_id % 9 + 1) || ') ' || replace(text, chr(10), chr(10) || chr(10) || ' 2. ')"


@query(
    "enum_strip",
    f"SELECT doc_id, {q.strip_enumeration('t')} AS clean FROM (SELECT doc_id, {_ENUM} AS t FROM documents)",
)
def enum_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(
        (F.col("doc_id") % 9 + 1).cast("string"),
        F.lit(") "),
        F.replace("text", F.lit("\n"), F.lit("\n\n 2. ")),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.strip_enumeration(marked).alias("clean")
    )


_LABELS = "'Title: ' || replace(text, chr(10), chr(10) || 'Notes - ') || ' learning outcome : end'"


@query(
    "label_prefix_strip",
    f"SELECT doc_id, {q.strip_labels('t')} AS clean FROM (SELECT doc_id, {_LABELS} AS t FROM documents)",
)
def label_prefix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = F.concat(
        F.lit("Title: "),
        F.replace("text", F.lit("\n"), F.lit("\nNotes - ")),
        F.lit(" learning outcome : end"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.strip_labels(labelled).alias("clean")
    )


_BULLETS = "'- ' || replace(text, chr(10), chr(10) || ' (a) ') || chr(10) || '2) end'"


@query(
    "bullet_strip",
    f"""SELECT doc_id, {q.sub('t', q.BULLET, '')} AS clean,
               array_to_string({q.find_all('t', q.BULLET)}, '|') AS removed
        FROM (SELECT doc_id, {_BULLETS} AS t FROM documents)""",
)
def bullet_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(
        F.lit("- "), F.replace("text", F.lit("\n"), F.lit("\n (a) ")), F.lit("\n2) end")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", marked.alias("t"))
    return docs.select(
        "doc_id",
        tx.strip_bullets(F.col("t")).alias("clean"),
        F.array_join(tx.removed_bullets(F.col("t")), "|").alias("removed"),
    )


_FILLED = """CASE doc_id % 4
  WHEN 0 THEN text || ' Please contact the provider for more information. ' || text
  WHEN 1 THEN ' Enrol now '
  WHEN 2 THEN 'National Qualification Framework (NQF) ' || text || ' SUBJECT to change without notice'
  ELSE text END"""


@query(
    "filler_strip_audit",
    f"""SELECT doc_id, {q.strip_filler('t')} AS clean,
               array_to_string({q.find_all('t', q.FILLER)}, '|') AS removed
        FROM (SELECT doc_id, {_FILLED} AS t FROM documents)""",
)
def filler_strip_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 4
    text = F.col("text")
    filled = (
        F.when(
            kind == 0,
            F.concat(text, F.lit(" Please contact the provider for more information. "), text),
        )
        .when(kind == 1, " Enrol now ")
        .when(
            kind == 2,
            F.concat(
                F.lit("National Qualification Framework (NQF) "),
                text,
                F.lit(" SUBJECT to change without notice"),
            ),
        )
        .otherwise(text)
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", filled.alias("t"))
    return docs.select(
        "doc_id",
        tx.strip_filler(F.col("t")).alias("clean"),
        F.array_join(tx.removed_filler(F.col("t")), "|").alias("removed"),
    )


_CONTACTS = """text || chr(10) || ' info' || doc_id || '@example.org' || chr(10)
  || '+49 (0)30 ' || (1000000 + doc_id) || chr(10) || 'call 030 1234567'"""


@query(
    "contact_strip",
    f"""SELECT doc_id, {q.sub('t', q.CONTACT, '')} AS clean,
               array_to_string({q.find_all('t', q.CONTACT)}, '|') AS removed
        FROM (SELECT doc_id, {_CONTACTS} AS t FROM documents)""",
)
def contact_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_contacts = F.concat(
        F.col("text"),
        F.lit("\n info"), F.col("doc_id").cast("string"), F.lit("@example.org\n+49 (0)30 "),
        (F.col("doc_id") + 1000000).cast("string"), F.lit("\ncall 030 1234567"),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", with_contacts.alias("t"))
    return docs.select(
        "doc_id",
        tx.strip_contacts(F.col("t")).alias("clean"),
        F.array_join(tx.removed_contacts(F.col("t")), "|").alias("removed"),
    )


_LEVEL_N = r"(?i)\bLevel" + q.WS + r"*(\d+)"


@query(
    "level_numbers",
    f"""SELECT p_partkey, regexp_extract(a, '(\\d+(?:\\.\\d+)?)', 1) AS first_number,
               regexp_extract(a, '(\\d+)', 1) AS first_integer,
               regexp_extract(a, {q.quoted(_LEVEL_N)}, 1) AS level_n,
               regexp_extract(p_brand, '(\\d+)', 1) AS brand_integer,
               regexp_extract(b, {q.quoted(_LEVEL_N)}, 1) AS joined_level_n
        FROM (SELECT *, 'EQF level ' || p_size || '.' || (p_partkey % 7) AS a,
                     CASE WHEN p_partkey % 2 = 0 THEN 'EQFLevel ' ELSE 'Level' END || p_size AS b
              FROM part)""",
)
def level_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    a = F.concat(F.lit("EQF level "), size, F.lit("."), (F.col("p_partkey") % 7).cast("string"))
    b = F.concat(F.when(F.col("p_partkey") % 2 == 0, "EQFLevel ").otherwise("Level"), size)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        tx.first_number(a).alias("first_number"),
        tx.first_integer(a).alias("first_integer"),
        tx.level_number(a).alias("level_n"),
        tx.first_integer(F.col("p_brand")).alias("brand_integer"),
        tx.level_number(b).alias("joined_level_n"),
    )


_NOISY = """CASE WHEN i % 7 = 3 THEN 'N / A' WHEN i % 7 = 4 THEN i || '.'
  WHEN i % 7 = 5 THEN '--' WHEN i % 7 = 6 THEN ' ' || chr(160) ELSE x END"""


@query(
    "garbage_filter",
    f"""SELECT doc_id, count(*) AS n_lines,
               CAST(sum(CASE WHEN {q.is_garbage('t')} THEN 1 ELSE 0 END) AS BIGINT) AS n_garbage,
               coalesce(string_agg(t, ' | ' ORDER BY i) FILTER (WHERE NOT {q.is_garbage('t')}), '')
                 AS kept
        FROM (SELECT doc_id, i, {_NOISY} AS t FROM ({q.LINES})) GROUP BY doc_id""",
)
def garbage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.transform(
        lines_of(F.col("text")),
        lambda x, i: F.when(i % 7 == 3, "N / A")
        .when(i % 7 == 4, F.concat(i.cast("string"), F.lit(".")))
        .when(i % 7 == 5, "--")
        .when(i % 7 == 6, " \u00A0")
        .otherwise(x),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", noisy.alias("lines"))
    kept = docs.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.filter("lines", lambda x: ~tx.is_garbage(x)).alias("kept"),
    ).filter("n_lines > 0")
    return kept.select(
        "doc_id",
        "n_lines",
        (F.col("n_lines") - F.size("kept")).cast("bigint").alias("n_garbage"),
        F.array_join("kept", " | ").alias("kept"),
    )


_SPACED = "chr(160) || ' ' || text || chr(9) || chr(8195) || chr(10)"


@query(
    "whitespace_trim",
    f"""SELECT conv_id, turn, {q.trim('t')} AS trimmed, {q.collapse('t')} AS collapsed
        FROM (SELECT conv_id, turn, {_SPACED} AS t FROM conversations)""",
)
def whitespace_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.concat(F.lit("\u00A0 "), F.col("text"), F.lit("\t\u2003\n"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", spaced.alias("t"))
    return turns.select(
        "conv_id",
        "turn",
        tx.trim_ws(F.col("t")).alias("trimmed"),
        tx.collapse_ws(F.col("t")).alias("collapsed"),
    )


_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)', 1)"


@query(
    "url_keys",
    f"""SELECT page_id, replace(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')[-1], ' ', '%20')
                 AS path_id,
               string_split(rtrim(url, '/'), '/')[-1] AS last_part,
               {q.sub("string_split(rtrim(url, '/'), '/')[-1]", '[^A-Za-z0-9_.-]', '_')} AS safe_key
        FROM pages""",
)
def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        tx.last_path_segment(url).alias("path_id"),
        tx.last_slash_part(url).alias("last_part"),
        tx.safe_key(tx.last_slash_part(url)).alias("safe_key"),
    )


@query(
    "excerpts",
    r"""SELECT doc_id, substr(text, 1, 500) AS first_500, substr(text, 1, 200) AS first_200,
               replace(replace(t, '\"', '"'), '\\', '\') AS unescaped
        FROM (SELECT *, '\"' || replace(text, ' ', '\\') || '\\"' AS t FROM documents)""",
)
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = F.concat(
        F.lit('\\"'), F.replace("text", F.lit(" "), F.lit("\\\\")), F.lit('\\\\"')
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.excerpt(F.col("text"), 500).alias("first_500"),
        tx.excerpt(F.col("text"), 200).alias("first_200"),
        tx.unescape_basic(escaped).alias("unescaped"),
    )


@query(
    "array_joins",
    f"""SELECT doc_id, string_agg(x, ' | ' ORDER BY i) AS piped, string_agg(x, ' ; ' ORDER BY i) AS listed,
               string_agg(x, chr(10) || chr(10) ORDER BY i) AS paragraphs
        FROM ({q.LINES}) GROUP BY doc_id""",
)
def array_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", lines_of(F.col("text")).alias("ls"))
    return docs.filter(F.size("ls") > 0).select(
        "doc_id",
        F.array_join("ls", " | ").alias("piped"),
        F.array_join("ls", " ; ").alias("listed"),
        F.array_join("ls", "\n\n").alias("paragraphs"),
    )
