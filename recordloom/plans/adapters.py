"""Records in the operators' input shapes, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.constants import PAGE_SIZE
from recordloom.plans.registry import table

NL = "\n"


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, NL), lambda x: x != "")


def document_uri() -> Column:
    return F.when(F.col("doc_id") % 17 != 0, F.concat(F.lit("http://data.example/q/"), F.md5("text")))


def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits: ten per (level, from) page, uri repeated where a text is."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        (doc % 8 + 1).cast("int").alias("level"),
        F.col("lang").alias("country"),
        (F.expr("doc_id div 8 div 10") * PAGE_SIZE).alias("from"),
        (F.expr("doc_id div 8") % PAGE_SIZE).alias("pos"),
        document_uri().alias("uri"),
    )


LIST_ITEMS_SQL = """
  SELECT doc_id, CAST(doc_id % 8 + 1 AS INTEGER) AS level, lang AS country,
         (doc_id // 8) // 10 * 10 AS "from", (doc_id // 8) % 10 AS pos,
         CASE WHEN doc_id % 17 <> 0 THEN 'http://data.example/q/' || md5(text) END AS uri
  FROM documents
"""


def _label(text: Column) -> Column:
    return F.struct(F.struct(text.alias("prefLabel")).alias("countryCode"))


def _located(*labels: Column) -> Column:
    """An organisation with one location and one address per label."""
    addresses = F.array(*[_label(x) for x in labels])
    return F.struct(F.array(F.struct(addresses.alias("address"))).alias("location"))


def _note(text: Column) -> Column:
    return F.struct(text.alias("noteLiteral"))


def qual_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualification documents as JSON text: one outcome per line of the text."""
    doc = F.col("doc_id")
    empty_note = F.array().cast("array<struct<noteLiteral:string>>")

    def outcome(x: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 3 == 2, "").otherwise(x).alias("title"),
            F.when(i % 2 == 0, F.array(_note(F.concat(F.lit("Note: "), x))))
            .otherwise(empty_note)
            .alias("additionalNote"),
        )

    outcomes = F.transform(lines_of(F.col("text")), outcome)
    garbage = F.array(F.struct(F.lit("1.").alias("title"), empty_note.alias("additionalNote")))
    with_garbage = F.concat(outcomes, F.when(doc % 9 == 0, garbage).otherwise(F.slice(garbage, 1, 0)))
    body = F.struct(
        F.get(lines_of(F.col("text")), F.lit(0)).alias("title"),
        _located(F.when(doc % 11 == 0, "").otherwise(F.col("lang"))).alias("publisher"),
        F.when(
            doc % 13 != 0,
            F.struct(F.concat(F.lit("Level "), (doc % 8 + 1).cast("string")).alias("prefLabel")),
        ).alias("EQFLevel"),
        F.struct(F.col("text").alias("noteLiteral")).alias("learningOutcomeSummary"),
        F.when(doc % 4 == 0, F.struct(F.col("source").alias("noteLiteral"))).alias(
            "entryRequirement"
        ),
        with_garbage.alias("learningOutcome"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("doc"), doc.cast("string"), F.lit(".json")).alias("file"),
        "lang",
        F.to_json(body).alias("body"),
    )


def lo_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning-opportunity documents as JSON text."""
    doc = F.col("doc_id")
    level = (doc % 8 + 1).cast("string")

    def outcome(x: Column, i: Column) -> Column:
        marked = F.concat((i + 1).cast("string"), F.lit(") "), x, F.lit(" "))
        return F.struct(x.alias("title"), F.array(_note(marked), _note(F.lit(""))).alias("additionalNote"))

    specification = F.struct(
        F.when(
            (doc % 3 != 0) & (doc % 13 != 0),
            F.struct(F.concat(F.lit("Level "), level).alias("prefLabel")),
        ).alias("EQFLevel"),
        F.struct(F.concat(F.lit("  "), F.col("text"), F.lit("\t\n")).alias("noteLiteral")).alias(
            "learningOutcomeSummary"
        ),
        F.transform(lines_of(F.col("text")), outcome).alias("learningOutcome"),
    )
    body = F.struct(
        F.get(lines_of(F.col("text")), F.lit(0)).alias("title"),
        F.when(doc % 5 != 0, F.array(_located(F.lit(""), F.col("lang")))).alias("providedBy"),
        F.when(doc % 7 != 0, _located(F.lit(None).cast("string"), F.col("source"))).alias(
            "publisher"
        ),
        F.when(doc % 3 == 0, F.struct(F.concat(F.lit("EQF level "), level).alias("prefLabel"))).alias(
            "EQFLevel"
        ),
        specification.alias("learningAchievementSpecification"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("doc"), doc.cast("string"), F.lit(".json")).alias("file"),
        F.to_json(body).alias("body"),
    )


def multilingual_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multilingual qualification documents: labels in five shapes, the country
    in four places, the uri under three keys."""
    doc = F.col("doc_id")
    level = F.concat(F.lit("Level "), (doc % 8 + 1).cast("string"))

    def label(text: Column, shape: Column) -> Column:
        as_map = F.to_json(F.struct(F.lit("andere").alias("de"), text.alias("en")))
        as_list = F.to_json(F.array(F.struct(text.alias("@value"))))
        as_value = F.to_json(F.struct(text.alias("value"), F.lit("x").alias("zz")))
        as_other = F.to_json(F.struct(text.alias("fr"), F.lit("y").alias("it")))
        plain = F.get(F.array(F.to_variant_object(F.array(text))), F.lit(0))
        return (
            F.when(shape == 0, F.try_variant_get(plain, "$[0]", "variant"))
            .when(shape == 1, F.parse_json(as_map))
            .when(shape == 2, F.parse_json(as_list))
            .when(shape == 3, F.parse_json(as_value))
            .otherwise(F.parse_json(as_other))
        )

    country = F.struct(F.struct(label(F.col("lang"), doc % 5).alias("prefLabel")).alias("countryCode"))
    nested = F.struct(F.array(F.struct(F.array(country).alias("address"))).alias("location"))
    deep = F.array(F.struct(F.lit("z").alias("a")), F.struct(F.lit("w").alias("a")))

    def outcome(x: Column, i: Column) -> Column:
        shape = (doc + i) % 5
        return F.struct(
            x.alias("title"),
            F.array(_note_variant(label(x, shape)), _note_variant(label(F.lit(""), F.lit(0)))).alias(
                "additionalNote"
            ),
        )

    has_notes = doc % 10 != 3
    body = F.struct(
        F.get(lines_of(F.col("text")), F.lit(0)).alias("title"),
        F.when(doc % 4 == 1, nested).alias("publisher"),
        F.when(doc % 4 == 2, F.struct(deep.alias("a"), nested.alias("z"))).alias("awarding"),
        F.when(doc % 4 == 3, F.array(F.array(country))).alias("parts"),
        F.when(doc % 13 != 0, F.struct(label(level, doc % 5).alias("prefLabel"))).alias("EQFLevel"),
        F.col("text").alias("description"),
        F.when(has_notes, F.transform(lines_of(F.col("text")), outcome)).alias("learningOutcome"),
        F.when(doc % 3 == 0, document_uri()).alias("uri"),
        F.when(doc % 3 == 1, document_uri()).alias("@id"),
        F.when(doc % 3 == 2, document_uri()).alias("id"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        document_uri().alias("id"),
        F.concat(F.lit("folder-"), F.col("source")).alias("country"),
        F.to_json(body).alias("body"),
    )


def _note_variant(v: Column) -> Column:
    return F.struct(v.alias("noteLiteral"))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured result pages of at most ten items, the list in seven places.

    (level, from) is derived from the document number, so a page cannot have
    more than ten items.
    """
    items = list_items(spark, sf_dir).withColumn(
        "item", F.to_json(F.struct("uri", F.col("doc_id").alias("nr"), "country"))
    )
    pages = items.groupBy("level", "from").agg(
        F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("rows")
    )
    listed = F.concat(F.lit("["), F.array_join(F.col("rows.item"), ","), F.lit("]"))
    form = F.col("from") / PAGE_SIZE % 7
    shapes = [
        ('{"items":', "}"),
        ('{"results":', "}"),
        ('{"hits":{"hits":', "}}"),
        ('{"data":{"items":', "}}"),
        ('{"data":{"results":', "}}"),
        ("", ""),
        ('{"tags":["a"],"none":[],"list":', "}"),
    ]
    payload = F.when(F.lit(False), "")
    for i, (before, after) in enumerate(shapes):
        payload = payload.when(form == i, F.concat(F.lit(before), listed, F.lit(after)))
    return pages.select("level", "from", payload.alias("payload"))


def course_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages in the strict form; every eleventh is an error message."""
    items = list_items(spark, sf_dir).withColumn(
        "item", F.to_json(F.struct("uri", F.col("doc_id").alias("nr")))
    )
    pages = items.groupBy("level", "from").agg(
        F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("rows")
    )
    listed = F.array_join(F.col("rows.item"), ",")
    number = (F.col("from") / PAGE_SIZE + 1).cast("bigint")
    ok = F.concat(
        F.lit('{"courses":['), listed,
        F.lit('],"paginationInfos":{"currentPageNumber":'), number.cast("string"),
        F.lit(',"totalPageCount":'), (F.col("level") + 9).cast("string"), F.lit("}}"),
    )
    broken = F.lit('{"error":"overloaded"}')
    return pages.select(
        "level", "from", F.when(number % 11 == 0, broken).otherwise(ok).alias("payload")
    )


def broken_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome cells: JSON, single-quoted, bare keys, cut short, by doc_id.

    One entry per line of the text, with its letters as title and notes.
    """
    doc = F.col("doc_id")
    words = F.filter(
        F.transform(lines_of(F.col("text")), lambda x: F.regexp_replace(x, r"[^\p{L}]+", " ")),
        lambda x: F.trim(x) != "",
    )

    def joined(head: str, middle: str, tail: str) -> Column:
        items = F.transform(
            words, lambda x: F.concat(F.lit(head), x, F.lit(middle), F.reverse(x), F.lit(tail))
        )
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))

    good = joined('{"title": "', '", "additionalNotes": "', '"}')
    single = joined("{'title': '", "', 'additionalNotes': '", "'}")
    bare = joined('{title: "', '", additionalNotes: "', '"}')
    cut = F.substring(good, F.lit(1), F.length(good) - 1)
    cell = (
        F.when(doc % 7 == 1, single).when(doc % 7 == 2, bare).when(doc % 7 == 3, cut).otherwise(good)
    )
    return table(spark, sf_dir, "documents").select("doc_id", "lang", cell.alias("cell"))


def raw_note_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome cells with note lists: JSON, cut short, or an object."""
    doc = F.col("doc_id")
    items = F.transform(
        lines_of(F.col("text")),
        lambda x, i: F.struct(
            x.alias("title"),
            F.array(F.concat(F.lit(" "), x), F.concat(F.lit("n"), i.cast("string")), F.lit("")).alias(
                "additionalNote"
            ),
        ),
    )
    whole = F.to_json(items)
    cut = F.substring(whole, F.lit(1), F.length(whole) - 1)
    wrapped = F.concat(F.lit('{"list":'), whole, F.lit("}"))
    cell = F.when(doc % 4 == 1, cut).when(doc % 4 == 2, wrapped).otherwise(whole)
    return table(spark, sf_dir, "documents").select("doc_id", cell.alias("cell"))


def outcome_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl outcomes from the event stream."""
    kind = F.col("event_type")
    country = F.concat(F.lit("C"), (F.col("user_id") % 43).cast("string"))
    status = F.when(kind == "error", "failed").when(kind == "view", "skipped").otherwise("saved")
    no_uri = (kind == "error") & (F.col("event_id") % 3 == 0)
    http = F.when(kind == "error", 404).when(kind == "click", 201).otherwise(200)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        country.alias("country"),
        (F.col("user_id") % 8 + 1).cast("int").alias("level"),
        F.when(no_uri, None).otherwise(http).alias("http_status"),
        (kind == "view").alias("stored"),
        status.alias("status"),
        F.when(no_uri, "no uri").when(kind == "error", "status-404").alias("reason"),
    )


OUTCOME_LOG_SQL = """
  SELECT event_id AS seq, ts, 'C' || (user_id % 43) AS country,
         CAST(user_id % 8 + 1 AS INTEGER) AS level, event_type,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL
              WHEN event_type = 'error' THEN 404 WHEN event_type = 'click' THEN 201 ELSE 200 END
           AS http_status,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'saved' END
           AS status,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'no uri'
              WHEN event_type = 'error' THEN 'status-404' END AS reason
  FROM events
"""


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)
